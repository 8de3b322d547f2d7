"""Table store (M4, V1-V3, T8), streaming loader (T1, T5) and bookmarks."""

import datetime as dt
import json
import os

import pytest

from tablestream.loader import stream_records
from tablestream.operators.stamp import stamp
from tablestream.plans.tables import plan_tables
from tablestream.sinks.tables import TableStore
from tablestream.sources import messages as M
from tablestream.streaming import bookmarks as B
from tablestream.streaming.job import LogLoader

from samples import LINES, ORDERS
from helpers import log_df, record_msg, rows, schema_msg

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def _orders(n, version=None, seq=1, start=0):
    """Orders with ``key % 4`` lines each."""
    extra = {"version": version} if version is not None else {}
    return [record_msg("orders", {"o_orderkey": i, "o_orderstatus": "O", "lines": [{"l_partkey": k} for k in range(i % 4)]},
                       sequence=seq, **extra) for i in range(start, start + n)]


def _n_lines(n):
    return sum(i % 4 for i in range(n))


def _recs(spark, msgs):
    return stamp(stream_records(log_df(spark, msgs), "orders"), T0)


def test_versions_stage_skip_and_activate(spark, scratch):
    store = TableStore(spark, scratch, buckets=4)
    plans = plan_tables("orders", ORDERS, ["o_orderkey"])
    store.write_batch("orders", plans, _recs(spark, _orders(110, version=1)), batch_id=0, version=1)
    assert store.read("orders").count() == 110
    assert store.read("orders", LINES).count() == _n_lines(110)
    store.write_batch("orders", plans, _recs(spark, _orders(100, version=2)), batch_id=1, version=2)
    assert store.read("orders").count() == 110            # staged, not visible
    assert {p: df.count() for p, df in store.read_tables("orders").items()} == {
        ("orders",): 110, LINES: _n_lines(110)}
    assert store.read("orders", version=2).count() == 100
    out = store.write_batch("orders", plans, _recs(spark, _orders(5, version=0)), batch_id=2, version=0)
    assert "skipped" in out                               # outdated load ignored
    assert store.activate_version("orders", 2) is True
    assert store.read("orders").count() == 100
    assert store.activate_version("orders", 2) is False    # already active
    store.write_batch("orders", plans, _recs(spark, _orders(120, version=2, seq=2)), batch_id=3, version=2)
    assert store.read("orders").count() == 120


def test_retry_of_committed_batch_is_noop_and_batches_are_appended(spark, scratch):
    store = TableStore(spark, scratch, buckets=8)
    plans = plan_tables("orders", ORDERS, ["o_orderkey"])
    store.write_batch("orders", plans, _recs(spark, _orders(50)), batch_id=0)
    before = json.dumps(store.pointer("orders"), sort_keys=True)
    assert "skipped" in store.write_batch("orders", plans, _recs(spark, _orders(50, seq=9)), batch_id=0)
    assert json.dumps(store.pointer("orders"), sort_keys=True) == before
    store.write_batch("orders", plans, _recs(spark, _orders(1, seq=5, start=7)), batch_id=1)
    assert [n for *_, n in store.pointer("orders")["tables"]["orders"]["commits"]] == [50, 1]   # one row appended
    assert store.read("orders").count() == 50


def test_schema_change_splits_stored_column(spark, scratch):
    store = TableStore(spark, scratch, buckets=4)
    s1 = {"type": "object", "properties": {"id": {"type": "integer"}, "v": {"type": ["integer", "null"]}}}
    s2 = {"type": "object", "properties": {"id": {"type": "integer"}, "v": {"type": ["string", "null"]}}}
    m1 = [record_msg("t", {"id": i, "v": i}, sequence=1) for i in range(10)]
    m2 = [record_msg("t", {"id": i, "v": f"s{i}"}, sequence=2) for i in range(5, 15)]
    rec = lambda msgs: stamp(stream_records(log_df(spark, msgs), "t"), T0)
    store.write_batch("t", plan_tables("t", s1, ["id"]), rec(m1), batch_id=0)
    report = store.write_batch("t", plan_tables("t", s2, ["id"]), rec(m2), batch_id=1)
    assert report["t"] == ["split"]
    got = rows(store.read("t"), "id", "v__i", "v__s")
    assert got[:6] == [(i, i, None) for i in range(5)] + [(5, None, "s5")]
    assert len(got) == 15


def _write_log(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for ln in lines:
            f.write(json.dumps(ln) + "\n")


def test_streaming_equals_batch_and_bookmarks(spark, scratch):
    head = schema_msg("orders", ORDERS, ["o_orderkey"])
    batch1 = [dict(head, pos=0)] + [dict(m, pos=10 + i) for i, m in enumerate(_orders(30))]
    batch1.append({"type": "STATE", "value": {"bookmark": 1}, "pos": 100})
    batch2 = [dict(m, pos=200 + i) for i, m in enumerate(_orders(20, seq=2, start=20))]
    batch2.append({"type": "STATE", "value": {"bookmark": 2}, "pos": 300})
    _write_log(f"{scratch}/in/f1.jsonl", batch1)
    _write_log(f"{scratch}/in/f2.jsonl", batch2)
    store = TableStore(spark, f"{scratch}/tables", buckets=4)
    loader = LogLoader(spark, store, bookmark_path=f"{scratch}/bookmarks", clock=lambda: T0)
    loader.run(f"{scratch}/in/*.jsonl", checkpoint=f"{scratch}/ckpt")
    streamed = rows(store.read("orders"), "o_orderkey", "_sdc_sequence")
    assert streamed == [(i, 1) for i in range(20)] + [(i, 2) for i in range(20, 40)]
    marks = sorted(os.listdir(f"{scratch}/bookmarks"))
    assert len([m for m in marks if m.endswith(".json")]) == 2
    # rerun on the same checkpoint: nothing new, same tables
    loader.run(f"{scratch}/in/*.jsonl", checkpoint=f"{scratch}/ckpt")
    assert rows(store.read("orders"), "o_orderkey", "_sdc_sequence") == streamed


def test_invalid_threshold_raises(spark, scratch):
    schema = {"type": "object", "properties": {"id": {"type": "integer"}, "name": {"type": "string"}}}
    bad = [schema_msg("s", schema, ["id"])] + [record_msg("s", {"id": i, "name": 5}) for i in range(3)]
    for i, m in enumerate(bad):
        m["pos"] = i
    _write_log(f"{scratch}/bad/f.jsonl", bad)
    store = TableStore(spark, f"{scratch}/tables2", buckets=2)
    loader = LogLoader(spark, store, invalid_threshold=3, clock=lambda: T0)
    with pytest.raises(Exception) as err:
        loader.run(f"{scratch}/bad/*.jsonl", checkpoint=f"{scratch}/ck2")
    assert "threshold" in str(err.value)


def test_safe_bookmarks_small(spark):
    # three commits: a (from 0), b (from 10), a (from 40); STATEs after the third, the sixth and the last record
    commits = spark.createDataFrame([(1, "a", 0), (2, "b", 10), (3, "a", 40)], "n long, stream string, first_pos long")
    states = spark.createDataFrame([(25,), (60,), (80,)], "pos long")
    got = rows(B.safe_bookmarks(commits, states, bucket=7))
    assert got == [(1, "a", 10, None), (2, "b", 40, 25), (3, "a", None, 80)]
    values = spark.sql("select pos, parse_json(v) as value from values (1L, '1'), (2L, '1'), (3L, '2') as t(pos, v)")
    assert rows(B.bookmark_changes(values), "pos", "value") == [(1, "1"), (3, "2")]
    assert B.newest_safe_state(values, 3).first()["pos"] == 2 and B.newest_safe_state(values, 1).isEmpty()


def test_streams_that_flush_apart_release_what_is_safe(spark, scratch):
    os.makedirs(f"{scratch}/in")
    state = lambda n: {"type": "STATE", "value": {"n": n}}
    lines = [_schema("s"), _schema("t"), _rec(1), state(1), {**_rec(2), "stream": "t"}, state(2), _rec(3), state(3)]
    _lines(f"{scratch}/in/a.jsonl", *[dict(m, pos=i) for i, m in enumerate(lines)])
    store = TableStore(spark, f"{scratch}/t", buckets=2)
    write, broken = store.write_batch, []

    def lost(stream, *a, **k):
        if stream == "t" and not broken:
            broken.append(stream)
            raise RuntimeError("lost")
        return write(stream, *a, **k)
    store.write_batch = lost
    make = lambda: LogLoader(spark, store, bookmark_path=f"{scratch}/marks")
    with pytest.raises(Exception, match="lost"):
        make().run(f"{scratch}/in", checkpoint=f"{scratch}/ck")
    marks = lambda: [json.load(open(f"{scratch}/marks/{n}"))["n"] for n in sorted(os.listdir(f"{scratch}/marks")) if n.endswith(".json") and n[0] != "."]
    assert marks() == [1]           # the record of t at position 4 is not stored
    make().run(f"{scratch}/in", checkpoint=f"{scratch}/ck")
    assert marks() == [1, 3] and store.read("t").count() == 1
    _lines(f"{scratch}/in/b.jsonl", dict(state(3), pos=20))
    make().run(f"{scratch}/in", checkpoint=f"{scratch}/ck")
    assert marks() == [1, 3]        # the same value is not written again after a restart


def test_a_batch_reads_no_stored_file(spark, scratch):
    import shutil
    store = TableStore(spark, f"{scratch}/t", buckets=4)
    plans, first = _plain_batch(spark, range(20))
    store.write_batch("s", plans, first, 0)
    shutil.move(f"{scratch}/t/s/data", f"{scratch}/away")     # stored files are out of reach
    store.write_batch("s", plans, _plain_batch(spark, range(10, 30))[1], 1)
    shutil.move(f"{scratch}/t/s/data/s/layout=0/{os.listdir(f'{scratch}/t/s/data/s/layout=0')[0]}", f"{scratch}/away/s/layout=0")
    shutil.rmtree(f"{scratch}/t/s/data")
    shutil.move(f"{scratch}/away", f"{scratch}/t/s/data")
    assert _ids(store) == list(range(30))
    assert [c["records"] for c in store.commit_log("s")] == [20, 20]


def test_reads_for_keys_prune_buckets(spark, scratch):
    store = TableStore(spark, f"{scratch}/t", buckets=8)
    store.write_batch("s", *_plain_batch(spark, range(200)), 0)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    few = store.read("s", keys=[5, 9, 1000], columns=["id"])
    assert rows(few, "id") == [(5,), (9,)]
    scan = [x for x in plan(few).split("\n") if "FileScan" in x]
    assert scan and all("_bucket" in x.split("PartitionFilters: [")[1].split("PushedFilters")[0] and "In(id, [" in x for x in scan)
    assert all("v#" not in x for x in scan)                      # unread columns stay unread
    wanted = spark.createDataFrame([(7,), (None,), (11,)], "id int").filter("id > 6 or id is null")
    some = store.read("s", keys=wanted)
    assert rows(some, "id") == [(7,), (11,)]
    assert "dynamicpruning" in plan(some)


def test_resolve_follows_the_upsert_rules_commit_by_commit(spark):
    import random

    from tablestream.operators import merge
    r = random.Random(3)
    made = [(r.choice([1, 2, 3, None]), f"{c:03d}", r.choice([None, 1, 2, 3])) for c in range(60) for _ in range(2)]
    made = list({(k, c): (k, c, s) for k, c, s in made}.values())
    want, loose = {}, []
    for k, c, s in sorted(made, key=lambda x: x[1]):
        if k is None:
            loose.append((k, c, s))
        elif k not in want or (s is not None and want[k][2] is not None and s >= want[k][2]):
            want[k] = (k, c, s)
    df = spark.createDataFrame(made, "id long, _commit string, _sdc_sequence long")
    got = sorted(map(tuple, merge.resolve(df, ["id"], null_keys=True).collect()), key=str)
    assert got == sorted([*want.values(), *loose], key=str)


def test_hot_parents_are_split(spark):
    from pyspark.sql import functions as F

    from tablestream.operators import merge
    kids = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    parents = kids.select("k").distinct()
    left, right = merge.split_hot(kids, parents, ["k"])
    joined = left.join(right.hint("shuffle_merge"), ["k", merge.SALT], "left_semi")
    sizes = sorted(r[0] for r in left.repartition(8, "k", merge.SALT).groupBy(F.spark_partition_id()).count().select("count").collect())
    assert joined.count() == 30_000 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    assert kids.join(parents, "k", "left_anti").count() == left.join(right, ["k", merge.SALT], "left_anti").count() == 0


def test_values_that_fit_no_column_are_set_aside_or_refused(spark, scratch):
    from tablestream.sinks.tables import UnplacedValues
    plans, _ = _plain_batch(spark, [0])
    lines = [json.dumps({**_rec(i), "record": {"id": i, "v": 5 if i % 2 else "x"}}) for i in range(6)]
    log = spark.createDataFrame(list(enumerate(lines)), "pos long, line string")
    recs = stamp(M.route(M.parse(log))["records"], T0)
    store = TableStore(spark, f"{scratch}/a", buckets=2)
    assert store.write_batch("s", plans, recs, 0)["_unplaced"] == 3
    assert _ids(store) == [0, 2, 4]
    assert sorted(map(tuple, store.unplaced("s").collect())) == [(i, i, ["v"]) for i in (1, 3, 5)]
    strict = TableStore(spark, f"{scratch}/b", buckets=2, refuse_unplaced=True)
    with pytest.raises(UnplacedValues):
        strict.write_batch("s", plans, recs, 0)
    assert strict.table_names("s") == {}


def test_target_hears_of_activations_and_jobs_do_not_share_schemas(spark, scratch):
    class Target:
        heard = []

        def __call__(self, stream, tables):
            self.heard.append((stream, tables[(stream,)].count()))

        def activate_version(self, stream, version):
            self.heard.append((stream, "version", version))
    target = Target()
    os.makedirs(f"{scratch}/in")
    _lines(f"{scratch}/in/a.jsonl", _schema(), _rec(1, 4), {"type": "ACTIVATE_VERSION", "stream": "s", "version": 4})
    LogLoader(spark, None, target=target, job=f"one-{scratch}").run(f"{scratch}/in", checkpoint=f"{scratch}/ck")
    assert [h for h in target.heard if h != ("s", 0)] == [("s", 1), ("s", "version", 4)]
    os.makedirs(f"{scratch}/in2")
    _lines(f"{scratch}/in2/a.jsonl", _rec(2))          # no SCHEMA of this job's own
    with pytest.raises(Exception, match="before SCHEMA"):
        LogLoader(spark, None, target=target, job=f"two-{scratch}").run(f"{scratch}/in2", checkpoint=f"{scratch}/ck2")


def test_pluggable_target_and_hooks(spark, scratch):
    seen = {}
    head = dict(schema_msg("orders", ORDERS, ["o_orderkey"]), pos=0)
    _write_log(f"{scratch}/t/f.jsonl", [head] + [dict(m, pos=1 + i) for i, m in enumerate(_orders(6))])
    spark.sql("DROP VIEW IF EXISTS ts_hook_after")
    loader = LogLoader(spark, None, target=lambda s, tabs: seen.update({p: df.count() for p, df in tabs.items()}),
                       after_sql=["CREATE OR REPLACE TEMP VIEW ts_hook_after AS SELECT 1 AS x"],
                       clock=lambda: T0)
    loader.run(f"{scratch}/t/*.jsonl", checkpoint=f"{scratch}/ck3")
    assert seen[("orders",)] == 6 and seen[LINES] == _n_lines(6)
    assert spark.sql("SELECT x FROM ts_hook_after").count() == 1


def test_jdbc_writer_options(spark):
    from tablestream.sinks.jdbc import jdbc_options, staging_writer
    opts = jdbc_options("jdbc:postgresql://db/x", "stg_orders", user="u", batch_size=500)
    assert opts["dbtable"] == "stg_orders" and opts["batchsize"] == "500" and opts["user"] == "u"
    w = staging_writer(spark.range(3), opts, partitions=2)
    assert w is not None   # not saved: no database in tests


def test_quarantine_keeps_invalid_records(spark, scratch):
    schema = {"type": "object", "properties": {"id": {"type": "integer"}, "name": {"type": "string"}}}
    msgs = [schema_msg("q", schema, ["id"])] + [record_msg("q", {"id": i, "name": 5 if i == 2 else "n"})
                                               for i in range(4)]
    _write_log(f"{scratch}/q/f.jsonl", [dict(m, pos=i) for i, m in enumerate(msgs)])
    store = TableStore(spark, f"{scratch}/qt", buckets=2)
    LogLoader(spark, store, invalid_threshold=5, clock=lambda: T0).run(f"{scratch}/q/*.jsonl",
                                                                       checkpoint=f"{scratch}/qck")
    assert rows(store.read("q"), "id") == [(0,), (1,), (3,)]
    bad = spark.read.parquet(f"{scratch}/qt/q/_quarantine").collect()
    assert len(bad) == 1 and list(bad[0]["_reasons"]) == ["name: type is not string"]


def _one_order(status, parts, seq):
    return record_msg("orders", {"o_orderkey": 7, "o_orderstatus": status, "lines": [{"l_partkey": p} for p in parts]}, sequence=seq)


def test_equal_sequence_ties_go_to_later_record_and_its_children(spark, scratch):
    store = TableStore(spark, scratch, buckets=2)
    plans = plan_tables("orders", ORDERS, ["o_orderkey"])
    early, late = _one_order("O", [31, 32, 33], 4), _one_order("F", [90], 4)
    store.write_batch("orders", plans, _recs(spark, [early, late] * 2), batch_id=0)
    assert rows(store.read("orders"), "o_orderkey", "o_orderstatus") == [(7, "F")]
    assert rows(store.read("orders", LINES), "_sdc_level_0_id", "l_partkey") == [(0, 90)]


def test_bookmarks_disabled_and_byte_bounded_batches(spark, scratch):
    head = dict(schema_msg("orders", ORDERS, ["o_orderkey"]), pos=0)
    _write_log(f"{scratch}/b/f1.jsonl", [head] + [dict(m, pos=1 + i) for i, m in enumerate(_orders(5))]
               + [{"type": "STATE", "value": {"b": 1}, "pos": 50}])
    _write_log(f"{scratch}/b/f2.jsonl", [dict(m, pos=60 + i) for i, m in enumerate(_orders(5, start=5))])
    store = TableStore(spark, f"{scratch}/bt", buckets=2)
    loader = LogLoader(spark, store, emit_states=False, bookmark_path=f"{scratch}/marks", clock=lambda: T0)
    q = loader.run(f"{scratch}/b/*.jsonl", checkpoint=f"{scratch}/bck", max_files_per_trigger=None,
                   max_bytes_per_trigger=1)
    assert store.read("orders").count() == 10
    assert not os.path.exists(f"{scratch}/marks")
    assert q.lastProgress is not None


def test_crash_between_data_write_and_publish(spark, scratch, monkeypatch):
    store = TableStore(spark, scratch, buckets=4)
    plans = plan_tables("orders", ORDERS, ["o_orderkey"])
    store.write_batch("orders", plans, _recs(spark, _orders(20)), batch_id=0)
    before = rows(store.read("orders"), "o_orderkey", "_sdc_sequence")

    def boom(*a, **k):
        raise OSError("lost the driver right before publishing")
    monkeypatch.setattr(store, "_publish", boom)
    with pytest.raises(OSError):
        store.write_batch("orders", plans, _recs(spark, _orders(30, seq=5)), batch_id=1)
    assert rows(store.read("orders"), "o_orderkey", "_sdc_sequence") == before      # old state still readable
    monkeypatch.undo()
    store.write_batch("orders", plans, _recs(spark, _orders(30, seq=5)), batch_id=1)
    assert rows(store.read("orders"), "o_orderkey", "_sdc_sequence") == [(i, 5) for i in range(30)]


def test_vacuum_keeps_live_snapshots(spark, scratch, monkeypatch):
    store = TableStore(spark, scratch, buckets=2)
    monkeypatch.setattr(TableStore, "KEEP_POINTERS", 1)
    plans = plan_tables("orders", ORDERS, ["o_orderkey"])
    for b in range(3):
        store.write_batch("orders", plans, _recs(spark, _orders(10, seq=b + 1)), batch_id=b)
    assert store.vacuum("orders") == []                  # every commit is in force
    store.compact("orders")
    before = rows(store.read("orders"), "o_orderkey", "_sdc_sequence")
    gone = store.vacuum("orders")
    assert gone                                        # earlier snapshots removed
    assert rows(store.read("orders"), "o_orderkey", "_sdc_sequence") == before
    assert store.vacuum("orders") == []


def test_sql_hooks_inline_and_from_file(tmp_path):
    from tablestream.streaming.job import _statements
    assert _statements("SELECT 1; SELECT 2 ;") == ["SELECT 1", "SELECT 2"]
    f = tmp_path / "after.sql"
    f.write_text("CREATE TEMP VIEW a AS SELECT 1;\nSELECT 3")
    assert _statements(f"file:{f}") == ["CREATE TEMP VIEW a AS SELECT 1", "SELECT 3"]
    assert _statements(None) == [] and _statements(["SELECT 4"]) == ["SELECT 4"]


def test_reference_style_config(spark, scratch):
    from tablestream.config import jdbc_url, loader_from_config
    head = dict(schema_msg("orders", ORDERS, ["o_orderkey"]), pos=0)
    _write_log(f"{scratch}/cfg/f.jsonl", [head] + [dict(m, pos=1 + i) for i, m in enumerate(_orders(4))])
    loader, run = loader_from_config(spark, {"postgres_database": "db", "postgres_schema": "tap",
                                             "invalid_records_threshold": 2, "state_support": False,
                                             "after_run_sql": "SELECT 1;"}, f"{scratch}/wh")
    assert loader.invalid_threshold == 2 and not loader.emit_states and loader.after_sql == ["SELECT 1"]
    loader.run(f"{scratch}/cfg/*.jsonl", checkpoint=f"{scratch}/cfgck", **run)
    assert TableStore(spark, f"{scratch}/wh/tap").read("orders").count() == 4
    assert jdbc_url({"postgres_database": "db"}) == "jdbc:postgresql://localhost:5432/db"


def test_parallel_streams_give_the_same_tables(spark, scratch):
    schema = {"type": "object", "properties": {"id": {"type": "integer"}, "v": {"type": "string"}}}
    msgs = []
    for s in ("a", "b", "c"):
        msgs.append(schema_msg(s, schema, ["id"]))
        msgs += [record_msg(s, {"id": i, "v": s}, sequence=1) for i in range(5)]
    _write_log(f"{scratch}/ps/f.jsonl", [dict(m, pos=i) for i, m in enumerate(msgs)])
    store = TableStore(spark, f"{scratch}/pst", buckets=2)
    LogLoader(spark, store, parallel_streams=3, clock=lambda: T0).run(f"{scratch}/ps/*.jsonl",
                                                                      checkpoint=f"{scratch}/psck")
    for s in ("a", "b", "c"):
        assert rows(store.read(s), "id", "v") == [(i, s) for i in range(5)]


def test_compaction_leaves_one_commit_and_the_same_rows(spark, scratch):
    store = TableStore(spark, scratch, buckets=8)
    plans = plan_tables("orders", ORDERS, ["o_orderkey"])
    store.write_batch("orders", plans, _recs(spark, _orders(40)), batch_id=0)
    for b in range(1, 5):
        store.write_batch("orders", plans, _recs(spark, _orders(1, seq=b + 1, start=b)), batch_id=b)
    before = rows(store.read("orders"), "o_orderkey", "_sdc_sequence"), rows(store.read("orders", LINES), "_sdc_source_key_o_orderkey", "_sdc_level_0_id")
    store.compact("orders")
    assert len(store.pointer("orders")["tables"]["orders"]["commits"]) == 1
    assert before == (rows(store.read("orders"), "o_orderkey", "_sdc_sequence"),
                      rows(store.read("orders", LINES), "_sdc_source_key_o_orderkey", "_sdc_level_0_id"))
    assert [dict(before[0])[i] for i in range(1, 5)] == [2, 3, 4, 5]
    store.write_batch("orders", plans, _recs(spark, _orders(1, seq=9, start=3)), batch_id=9)
    assert dict(rows(store.read("orders"), "o_orderkey", "_sdc_sequence"))[3] == 9


def test_legacy_children_mode_keeps_children_that_are_not_sent_again(spark, scratch):
    plans = plan_tables("orders", ORDERS, ["o_orderkey"])
    for mode, want in (("sync", [(0, 5), (1, 6)]), ("legacy", [(0, 5), (1, 6), (2, 3)])):
        store = TableStore(spark, f"{scratch}/{mode}", buckets=2, children=mode)
        store.write_batch("orders", plans, _recs(spark, [_one_order("O", [1, 2, 3], 1)]), batch_id=0)
        store.write_batch("orders", plans, _recs(spark, [_one_order("O", [5, 6], 2)]), batch_id=1)
        assert rows(store.read("orders", LINES), "_sdc_level_0_id", "l_partkey") == want, mode


def test_null_in_not_null_column_aborts_the_batch(spark, scratch):
    from tablestream.sinks.tables import NotNullViolation
    store = TableStore(spark, scratch, buckets=2)
    plans = plan_tables("orders", ORDERS, ["o_orderkey"])
    store.write_batch("orders", plans, _recs(spark, _orders(3)), batch_id=0)
    no_status = [record_msg("orders", {"o_orderkey": 9, "lines": []}, sequence=5)]
    with pytest.raises(NotNullViolation):
        store.write_batch("orders", plans, _recs(spark, no_status), batch_id=1)
    assert rows(store.read("orders"), "o_orderkey") == [(0,), (1,), (2,)]     # nothing published


def _lines(path, *messages):
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(json.dumps(m) + "\n" for m in messages)


def _schema(stream="s"):
    return {"type": "SCHEMA", "stream": stream, "key_properties": ["id"],
            "schema": {"type": "object", "properties": {"id": {"type": "integer"}, "v": {"type": ["null", "string"]}}}}


def _rec(i, version=None, v="x"):
    m = {"type": "RECORD", "stream": "s", "record": {"id": i, "v": v}}
    return m if version is None else {**m, "version": version}


def _ids(store):
    return sorted(r["id"] for r in store.read("s").collect())


def test_two_loads_into_one_store_hide_nothing(spark, scratch):
    store = TableStore(spark, f"{scratch}/t", buckets=4)
    for n in (1, 2):
        os.makedirs(f"{scratch}/in{n}")
        _lines(f"{scratch}/in{n}/a.jsonl", _schema(), _rec(n))
        LogLoader(spark, store).run(f"{scratch}/in{n}", checkpoint=f"{scratch}/ck{n}")
    assert _ids(store) == [1, 2]


def test_segment_numbers_do_not_reach_into_the_next_batch(spark, scratch):
    store, plans, recs = TableStore(spark, f"{scratch}/t", buckets=2), *_plain_batch(spark, [1])
    assert "skipped" not in store.write_batch("s", plans, recs, 0, segment=10_001)
    assert "skipped" not in store.write_batch("s", plans, _plain_batch(spark, [2])[1], 1)
    assert store.write_batch("s", plans, recs, 0, segment=10_001) == {"skipped": "already committed"}
    assert _ids(store) == [1, 2]


def test_reopened_store_keeps_its_bucket_count(spark, scratch):
    plans, recs = _plain_batch(spark, range(100))
    TableStore(spark, f"{scratch}/t", buckets=4).write_batch("s", plans, recs, 0)
    again = TableStore(spark, f"{scratch}/t", buckets=16)
    again.write_batch("s", plans, _plain_batch(spark, range(50, 150))[1], 1)
    assert _ids(again) == list(range(150))


def test_versions_apply_in_log_order_and_last(spark, scratch):
    os.makedirs(f"{scratch}/in")
    _lines(f"{scratch}/in/a.jsonl", _schema(), _rec(1, 1), {"type": "ACTIVATE_VERSION", "stream": "s", "version": 1},
           _rec(2, 2))
    store = TableStore(spark, f"{scratch}/t", buckets=2)
    LogLoader(spark, store).run(f"{scratch}/in", checkpoint=f"{scratch}/ck")
    assert _ids(store) == [1] and [r["id"] for r in store.read("s", version=2).collect()] == [2]
    _lines(f"{scratch}/in/b.jsonl", _schema(), _rec(3), _rec(4, 1), {"type": "ACTIVATE_VERSION", "stream": "s", "version": 2})
    LogLoader(spark, store).run(f"{scratch}/in", checkpoint=f"{scratch}/ck")
    assert _ids(store) == [2]   # an unversioned and an older row came after version 2


def test_activating_what_was_never_staged_changes_nothing(spark, scratch):
    plans, recs = _plain_batch(spark, [1])
    store = TableStore(spark, f"{scratch}/t", buckets=2)
    store.write_batch("s", plans, recs, 0, version=1)
    assert store.activate_version("s", 5) is False and store.version("s") == 1


def test_repeated_schema_cuts_nothing_and_hooks_run_once(spark, scratch):
    os.makedirs(f"{scratch}/in")
    for n in range(3):
        _lines(f"{scratch}/in/{n}.jsonl", *[m for i in range(4) for m in (_schema(), _rec(10 * n + i))])
    store = TableStore(spark, f"{scratch}/t", buckets=2)
    spark.sql("create or replace temp view hook_rows as select 1 as x")
    ran = []
    loader = LogLoader(spark, store, before_sql=["select 1"], after_sql=["select 2"])
    write = store.write_batch
    store.write_batch = lambda *a, **k: ran.append(a[3]) or write(*a, **k)
    loader.run(f"{scratch}/in", checkpoint=f"{scratch}/ck")
    assert len(ran) == 3 and len(_ids(store)) == 12   # one write per file


def test_retry_after_a_schema_change_loses_nothing(spark, scratch):
    wider = _schema()
    wider["schema"]["properties"]["w"] = {"type": ["null", "integer"]}
    first, second = [_schema(), _rec(1)], [_rec(2), wider, _rec(3), _schema(), _rec(4)]
    for failing in (1, 2):
        os.makedirs(f"{scratch}/in{failing}")
        _lines(f"{scratch}/in{failing}/a.jsonl", *first)
        store = TableStore(spark, f"{scratch}/t{failing}", buckets=2)
        loader, write, failed = LogLoader(spark, store), store.write_batch, []
        where = dict(path=f"{scratch}/in{failing}", checkpoint=f"{scratch}/ck{failing}")
        loader.run(**where)
        _lines(f"{scratch}/in{failing}/b.jsonl", *second)

        def lost(*a, **k):
            if k["segment"] == failing and not failed:
                failed.append(k["segment"])
                raise RuntimeError("lost")
            return write(*a, **k)
        store.write_batch = lost
        with pytest.raises(Exception, match="lost"):
            loader.run(**where)
        assert failed and 4 not in _ids(store)
        LogLoader(spark, store).run(**where)
        assert _ids(store) == [1, 2, 3, 4] and "w" in store.read("s").columns


def test_schema_only_stream_gets_an_empty_table(spark, scratch):
    os.makedirs(f"{scratch}/in")
    _lines(f"{scratch}/in/a.jsonl", _schema(), _rec(1), _schema("t"))
    store = TableStore(spark, f"{scratch}/t", buckets=2, persist_empty=True)
    LogLoader(spark, store).run(f"{scratch}/in", checkpoint=f"{scratch}/ck")
    assert store.read("t").count() == 0 and "id" in store.read("t").columns


def _plain_batch(spark, ids):
    """Plans and stamped records of the plain stream above."""
    import datetime as dt

    from tablestream.operators import stamp as st
    from tablestream.sources import messages as M
    lines = [json.dumps(_rec(i)) for i in ids]
    log = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "pos long, line string")
    recs = st.stamp(M.route(M.parse(log))["records"], dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc), keyless=False)
    return plan_tables("s", _schema()["schema"], ["id"]), recs
