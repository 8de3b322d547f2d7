"""Message log source (S1-S4) and the flush-before-activate rule (T5)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tablestream.sinks.tables import TableStore
from tablestream.sources import messages as M
from tablestream.streaming.job import LogLoader

from helpers import log_df, record_msg, rows, schema_msg

SCHEMA = {"type": "object", "properties": {"id": {"type": "integer"}, "v": {"type": ["string", "null"]}}}


def test_parse_and_route_bad_lines(spark):
    lines = [schema_msg("s", SCHEMA, ["id"]), record_msg("s", {"id": 1}), "{not json", {"stream": "s"},
             {"type": "NOPE"}, {"type": "RECORD", "stream": "s"}, {"type": "ACTIVATE_VERSION", "stream": "s"},
             {"type": "STATE", "value": {"b": 1}}, {"type": "ACTIVATE_VERSION", "stream": "s", "version": 3}]
    p = M.parse(log_df(spark, lines))
    reasons = [r.bad_reason for r in p.orderBy("pos").collect()]
    assert reasons == [None, None, "unparsable", "missing type", "unknown type NOPE", "RECORD without record",
                       "ACTIVATE_VERSION without version", None, None]
    r = M.route(p)
    assert r["records"].count() == 1 and r["schemas"].count() == 1 and r["states"].count() == 1
    assert r["activations"].collect()[0].version == 3 and r["bad"].count() == 5
    with pytest.raises(M.MessageError):
        M.require_clean(p)


def test_duplicate_keys_last_wins(spark):
    p = M.parse(log_df(spark, ['{"type":"RECORD","stream":"s","record":{"id":1,"id":2}}']))
    rec = M.route(p)["records"].select(F.try_variant_get("record", "$.id", "bigint")).collect()[0][0]
    assert rec == 2


def test_read_log_from_files(spark, scratch):
    os.makedirs(f"{scratch}/logs")
    with open(f"{scratch}/logs/a.jsonl", "w") as f:
        for i in range(5):
            f.write(json.dumps({"type": "RECORD", "stream": "s", "record": {"id": i}, "pos": 100 - i}) + "\n")
    log = M.read_log(spark, f"{scratch}/logs")
    assert sorted(r.pos for r in log.collect()) == [0, 1, 2, 3, 4]              # line order in the file
    assert sorted(r.pos for r in M.parse(log).collect()) == [96, 97, 98, 99, 100]  # own "pos" wins


def test_lines_of_a_file_are_not_sent_to_one_task(spark, scratch):
    os.makedirs(f"{scratch}/wide")
    for name in "ab":
        with open(f"{scratch}/wide/{name}.jsonl", "w") as f:
            f.writelines(f"{name}{i:05d}\n" for i in range(4000))
    # as in a micro-batch of large files: no adaptive plan, and nothing small enough to broadcast unasked
    large = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.adaptive.enabled": "false",
             "spark.sql.autoBroadcastJoinThreshold": "-1"}
    kept = {k: spark.conf.get(k) for k in large}
    for k, v in large.items():
        spark.conf.set(k, v)
    try:
        log = M.read_log(spark, f"{scratch}/wide").withColumn("task", F.spark_partition_id())
        got = sorted(log.collect(), key=lambda r: r.pos)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert [r.line for r in got] == [f"{n}{i:05d}" for n in "ab" for i in range(4000)]   # file, then line order
    sizes = {}
    for r in got:
        sizes[r.task] = sizes.get(r.task, 0) + 1
    assert len(sizes) >= 8 and max(sizes.values()) <= 1000   # split by split, however large a file is


def test_orphans_and_schema_in_force(spark):
    msgs = [record_msg("a", {"id": 0}), schema_msg("a", SCHEMA, ["id"]), record_msg("a", {"id": 1}),
            record_msg("b", {"id": 2}), schema_msg("a", SCHEMA, ["id"]), record_msg("a", {"id": 3})]
    r = M.route(M.parse(log_df(spark, msgs)))
    assert rows(M.orphan_records(r["records"], r["schemas"]), "pos") == [(0,), (30,)]
    sch = r["schemas"].select("stream", "pos", F.col("pos").alias("sid"))
    got = rows(M.schema_in_force(r["records"], sch, "sid"), "pos", "sid")
    assert got == [(0, None), (20, 10), (30, None), (50, 40)]
    for bucket in (7, 25, 1000):
        one = M.records_with_schema(M.parse(log_df(spark, msgs)), bucket=bucket)
        assert rows(one, "pos", "schema_pos") == got
        assert one.columns == [*r["records"].columns, "schema_pos"]
        assert one.filter("line is null or record is null").count() == 0


def test_records_with_schema_of_a_log_without_either(spark):
    only = [record_msg("a", {"id": 0}), "{broken", {"type": "STATE", "value": {"b": 1}}]
    assert rows(M.records_with_schema(M.parse(log_df(spark, only))), "pos", "schema_pos") == [(0, None)]
    assert M.records_with_schema(M.parse(log_df(spark, [schema_msg("a", SCHEMA, ["id"])]))).count() == 0


def _write(path, msgs):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for i, m in enumerate(msgs):
            f.write(json.dumps({**m, "pos": i}) + "\n")


def test_flush_before_activate_in_one_micro_batch(spark, scratch):
    msgs = [schema_msg("s", SCHEMA, ["id"])]
    msgs += [record_msg("s", {"id": i, "v": "old"}, version=1, sequence=1) for i in range(4)]
    msgs += [record_msg("s", {"id": i, "v": "new"}, version=2, sequence=2) for i in range(2)]
    msgs += [{"type": "ACTIVATE_VERSION", "stream": "s", "version": 2}]
    msgs += [record_msg("s", {"id": 9, "v": "after"}, version=2, sequence=3)]
    _write(f"{scratch}/in/f.jsonl", msgs)
    store = TableStore(spark, f"{scratch}/t", buckets=2)
    LogLoader(spark, store).run(f"{scratch}/in/*.jsonl", checkpoint=f"{scratch}/ck")
    assert store.version("s") == 2
    assert rows(store.read("s"), "id", "v") == [(0, "new"), (1, "new"), (9, "after")]


def test_record_before_schema_is_an_error(spark, scratch):
    _write(f"{scratch}/o/f.jsonl", [record_msg("z", {"id": 1})])
    loader = LogLoader(spark, TableStore(spark, f"{scratch}/t2", buckets=2))
    with pytest.raises(Exception) as err:
        loader.run(f"{scratch}/o/*.jsonl", checkpoint=f"{scratch}/ck2")
    assert "before SCHEMA" in str(err.value)


def test_persist_empty_tables(spark, scratch):
    from tablestream.plans.tables import plan_tables
    nested = {"type": "object", "properties": {"id": {"type": "integer"},
                                               "kids": {"type": "array", "items": {"type": "integer"}}}}
    empty = spark.createDataFrame([], "pos bigint, stream string, record variant, version bigint, "
                                      "sequence bigint, time_extracted string, line string")
    off = TableStore(spark, f"{scratch}/e1", buckets=2)
    assert "skipped" in off.write_batch("e", plan_tables("e", nested, ["id"]), empty, batch_id=0)
    assert off.is_empty("e")
    on = TableStore(spark, f"{scratch}/e2", buckets=2, persist_empty=True)
    from tablestream.operators.stamp import stamp
    import datetime as dt
    on.write_batch("e", plan_tables("e", nested, ["id"]), stamp(empty, dt.datetime(2024, 1, 1)), batch_id=0)
    assert set(on.table_names("e")) == {("e",), ("e", "kids")}
    assert on.read("e", ("e", "kids")).columns[:2] == ["_sdc_source_key_id", "_sdc_sequence"] or \
        "_sdc_value" in on.read("e", ("e", "kids")).columns


def test_schema_change_inside_one_micro_batch(spark, scratch):
    s_int = {"type": "object", "properties": {"id": {"type": "integer"}, "v": {"type": ["integer", "null"]}}}
    s_str = {"type": "object", "properties": {"id": {"type": "integer"}, "v": {"type": ["string", "null"]}}}
    msgs = [schema_msg("s", s_int, ["id"])] + [record_msg("s", {"id": i, "v": i}, sequence=1) for i in range(3)]
    msgs += [schema_msg("s", s_str, ["id"])] + [record_msg("s", {"id": i, "v": f"x{i}"}, sequence=2)
                                               for i in range(2, 5)]
    _write(f"{scratch}/sc/f.jsonl", msgs)
    store = TableStore(spark, f"{scratch}/sct", buckets=2)
    LogLoader(spark, store).run(f"{scratch}/sc/*.jsonl", checkpoint=f"{scratch}/scck")
    assert rows(store.read("s"), "id", "v__i", "v__s") == [
        (0, 0, None), (1, 1, None), (2, None, "x2"), (3, None, "x3"), (4, None, "x4")]


def test_schema_line_without_position_applies_first(spark, scratch):
    os.makedirs(f"{scratch}/np")
    with open(f"{scratch}/np/f.jsonl", "w") as f:
        f.write(json.dumps(schema_msg("s", SCHEMA, ["id"])) + "\n")
        for i in range(3):
            f.write(json.dumps({**record_msg("s", {"id": i}), "pos": 10 + i}) + "\n")
    store = TableStore(spark, f"{scratch}/npt", buckets=2)
    LogLoader(spark, store).run(f"{scratch}/np/*.jsonl", checkpoint=f"{scratch}/npck")
    assert store.read("s").count() == 3


def test_positions_follow_file_and_line_order_without_pos_fields(spark, scratch):
    os.makedirs(f"{scratch}/plain")
    expected = []
    for name, n in (("f2.jsonl", 40), ("f1.jsonl", 25), ("f3.jsonl", 7)):
        with open(f"{scratch}/plain/{name}", "w") as f:
            for i in range(n):
                f.write(json.dumps({"type": "STATE", "value": {"f": name, "i": i}}) + "\n")
    for name, n in (("f1.jsonl", 25), ("f2.jsonl", 40), ("f3.jsonl", 7)):
        expected += [(name, i) for i in range(n)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")     # many splits per file
    try:
        log = M.read_log(spark, f"{scratch}/plain")
        got = [(r.value["f"], r.value["i"]) for r in
               M.route(M.parse(log))["states"].select("pos", F.from_json(F.to_json("value"), "f string, i int")
                                                      .alias("value")).orderBy("pos").collect()]
        assert log.rdd.getNumPartitions() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == expected


def test_streaming_plain_files_without_positions(spark, scratch):
    keyless = {"type": "object", "properties": {"v": {"type": "integer"}}}
    os.makedirs(f"{scratch}/pl")
    with open(f"{scratch}/pl/a.jsonl", "w") as f:
        f.write(json.dumps(schema_msg("k", keyless, [])) + "\n")
        for i in range(5):
            f.write(json.dumps(record_msg("k", {"v": i})) + "\n")
    with open(f"{scratch}/pl/b.jsonl", "w") as f:
        for i in range(5, 9):
            f.write(json.dumps(record_msg("k", {"v": i})) + "\n")
    store = TableStore(spark, f"{scratch}/plt", buckets=2)
    LogLoader(spark, store).run(f"{scratch}/pl/*.jsonl", checkpoint=f"{scratch}/plck", max_files_per_trigger=1)
    t = store.read("k")
    assert rows(t, "v") == [(i,) for i in range(9)]
    assert t.select("_sdc_primary_key").distinct().count() == 9
