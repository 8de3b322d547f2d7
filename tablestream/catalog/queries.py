"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query derives its input from the driver tables in Spark (see
:mod:`.inputs`), runs it through the library, and returns a small, named,
typed result.  Timestamps come back as ``timestamp_ntz`` (UTC wall clock).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..functions.scalars import canonical_name, fit_name, iso_utc, to_naive
from ..loader import load_counts as loader_load_counts
from ..loader import stream_records, table_counts, tables_from_log, tables_from_records
from ..operators import checks, merge, stamp as st
from ..operators.evolve import project
from ..operators.flatten import apply_schema, default_layouts
from ..plans.evolve import evolve
from ..plans.naming import MAX_IDENTIFIER
from ..plans.tables import plan_tables
from ..sinks.tables import TableStore
from ..sources import messages as M
from ..streaming import bookmarks as B
from . import inputs as I
from . import schemas as S

BATCHED_AT = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: to_naive(F.col(c)) for c in cols})


def _scratch(spark: SparkSession, tag: str) -> str:
    return f"{session.checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex[:10]}"


# ------------------------------------------------------------------ sources

def read_messages(spark, d):
    p = M.parse(I.event_log(spark, d, broken=True, schemas=None))
    return p.select("pos", F.col("type").alias("msg_type"), "stream", "bad_reason")


def route_messages(spark, d):
    parsed = M.parse(I.event_log(spark, d, states=True))
    return parsed.filter(F.col("bad_reason").isNull()) \
        .groupBy(F.col("type").alias("msg_type"), "stream").agg(F.count("*").alias("n"))


def orphan_records(spark, d):
    r = M.route(M.parse(I.event_log(spark, d, schemas="late")))
    return M.orphan_records(r["records"], r["schemas"]).select("pos", "stream")


def schema_in_force(spark, d):
    parsed = M.parse(I.event_log(spark, d, schemas="blocks"))
    return M.records_with_schema(parsed).select("pos", "stream", "schema_pos")


# ------------------------------------------------------------------ checks / stamping

def _validated(spark, d):
    recs = M.route(M.parse(I.event_log(spark, d)))["records"]
    return checks.validate(recs, S.EVENT_RULES)


def validate_records(spark, d):
    v = _validated(spark, d)
    return v.select("pos", "stream", (F.size(checks.REASONS) == 0).alias("is_valid"),
                    F.array_join(checks.REASONS, "; ").alias("reasons"))


def invalid_by_stream(spark, d):
    return checks.invalid_counts(_validated(spark, d))


def latest_version_rows(spark, d):
    log = I.event_log(spark, d, version=(F.col("event_id") / 4000).cast("bigint"))
    recs = M.route(M.parse(log))["records"]
    return st.latest_version_rows(recs).select("pos", "stream", "version")


def _metadata_log(spark, d):
    ev = I.table(spark, d, "events")
    eid = F.col("event_id")
    rec = I.event_record({"_sdc_received_at": F.when(eid % 5 == 0, F.lit("2024-03-01T00:00:00Z"))})
    line = I.record_line(F.col("event_type"), rec,
                         sequence=F.when(eid % 3 != 0, I.event_sequence(eid)),
                         version=F.when(eid % 4 == 0, (eid / 1000).cast("bigint")),
                         time_extracted=F.when(eid % 2 == 0, iso_utc(F.col("ts"))))
    return I.log_of(ev, eid * 10, line)


def load_metadata(spark, d):
    recs = M.route(M.parse(_metadata_log(spark, d)))["records"]
    out = st.stamp(recs, BATCHED_AT)
    return _ntz(out.select("pos", "_sdc_sequence", "_sdc_table_version", "_sdc_received_at",
                           "_sdc_batched_at"), "_sdc_received_at", "_sdc_batched_at")


def _documents_log(spark, d):
    docs = I.table(spark, d, "documents")
    rec = F.struct("doc_id", "lang", "source",
                   F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("pk-"), F.col("doc_id").cast("string")))
                   .alias("_sdc_primary_key"))
    return I.log_of(docs, F.col("doc_id"), I.record_line("documents", rec))


def surrogate_key(spark, d):
    tabs = tables_from_log(_documents_log(spark, d), "documents", S.DOCUMENTS, [], batched_at=BATCHED_AT)
    return tabs[("documents",)].select("doc_id", "_sdc_primary_key")


def load_documents(spark, d):
    """Whole document texts as records, with their labels as a nested object."""
    docs = I.table(spark, d, "documents")
    labels = I.table(spark, d, "labels")
    j = docs.join(labels, "doc_id", "left")
    rec = F.struct("doc_id", "text", "lang", "source", "n_chars",
                   F.when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(),
                          F.struct("quality", "toxic")).alias("labels"))
    log = I.log_of(j, F.col("doc_id") * 10, I.record_line("documents", rec, sequence=F.lit(1)), derived=True)
    root = tables_from_log(log, "documents", S.DOCUMENT_TEXTS, ["doc_id"], batched_at=BATCHED_AT)[("documents",)]
    return root.select("doc_id", "text", "lang", "source", "n_chars", "labels__quality", "labels__toxic")


# ------------------------------------------------------------------ flatten / type split

def _orders(spark, d, materialize: bool = False):
    return tables_from_log(I.order_log(spark, d), "orders", batched_at=BATCHED_AT, materialize=materialize)


def flatten_objects(spark, d):
    root = _orders(spark, d)[("orders",)]
    return _ntz(root.select("o_orderkey", "o_totalprice", "o_orderdate", "customer__c_name",
                            "customer__c_mktsegment", "customer__c_nationkey"), "o_orderdate")


def unnest_lines(spark, d):
    child = _orders(spark, d)[("orders", "lines")]
    return _ntz(child.select("_sdc_source_key_o_orderkey", "_sdc_level_0_id", *LINE_COLS, "l_shipdate"),
                "l_shipdate")


def _mixed_log(spark, d, v: F.Column, schema_name: str = "mixed"):
    """Records ``{"event_id": .., "v": <v>}`` with ``v`` given as JSON text (NULL = absent)."""
    ev = I.table(spark, d, "events")
    rec = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"),
                   F.when(v.isNotNull(), F.concat(F.lit(',"v":'), v)).otherwise(F.lit("")), F.lit("}"))
    return I.log_of(ev, F.col("event_id") * 10, I.record_line_raw(schema_name, rec))


def _mixed_tables(spark, d, v, schema):
    log = _mixed_log(spark, d, v)
    return tables_from_log(log, "mixed", schema, ["event_id"], batched_at=BATCHED_AT)[("mixed",)]


def type_split(spark, d):
    v = I.mixed_json(["v_int", "v_num", "v_str", "v_bool", "v_ts"])
    root = _mixed_tables(spark, d, v, S.MIXED)
    return _ntz(root.select("event_id", "v__i", "v__f", "v__b", "v__s", "v__t"), "v__t")


def int_to_number(spark, d):
    et = F.col("event_type")
    v = F.when(et == "click", F.floor("value").cast("bigint").cast("string")) \
         .otherwise(I.json_scalar(F.col("value")))
    return _mixed_tables(spark, d, v, S.NUMBER_ONLY).select("event_id", "v")


def default_fill(spark, d):
    eid = F.col("event_id")
    v = F.when(eid % 2 == 1, F.lit(None)) \
         .when(eid % 4 == 2, F.lit("null")) \
         .otherwise(F.floor("value").cast("bigint").cast("string"))
    return _mixed_tables(spark, d, v, S.WITH_DEFAULT).select("event_id", "v")


def datetime_norm(spark, d):
    ev = I.table(spark, d, "events")
    eid, ts = F.col("event_id"), F.col("ts")
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    text = F.when(eid % 3 == 0, F.concat(F.date_format(ts + F.expr("INTERVAL 90 MINUTES"), fmt), F.lit("+01:30"))) \
            .when(eid % 3 == 1, F.concat(F.date_format(ts, fmt), F.lit("Z"))) \
            .otherwise(F.concat(F.date_format(ts - F.expr("INTERVAL 5 HOURS"), fmt), F.lit("-05:00")))
    log = I.log_of(ev, eid * 10, I.record_line("times", F.struct(eid, text.alias("ts"))))
    root = tables_from_log(log, "times", S.DATETIME, ["event_id"], batched_at=BATCHED_AT)[("times",)]
    return _ntz(root.select("event_id", "ts"), "ts")


def null_literal(spark, d):
    ev = I.table(spark, d, "events")
    et = F.when(F.col("event_type") == "error", F.lit("NULL")).otherwise(F.col("event_type"))
    log = I.log_of(ev, F.col("event_id") * 10,
                   I.record_line("texts", F.struct("event_id", et.alias("event_type"))))
    root = tables_from_log(log, "texts", S.TEXT, ["event_id"], batched_at=BATCHED_AT)[("texts",)]
    return root.select("event_id", "event_type")


def not_null_check(spark, d):
    eid, et = F.col("event_id"), F.col("event_type")
    v = F.when((et == "signup") & (eid % 2 == 1), F.lit("null")) \
         .otherwise(F.floor("value").cast("bigint").cast("string"))
    log = _mixed_log(spark, d, v)
    plans = plan_tables("mixed", S.REQUIRED_V, ["event_id"])
    layouts = default_layouts(plans)
    root = tables_from_records(stream_records(log, "mixed"), "mixed", S.REQUIRED_V, ["event_id"],
                               BATCHED_AT, layouts)[0][("mixed",)]
    required = [n for n, _, nullable in layouts[("mixed",)].columns() if not nullable]
    return checks.not_null_violations(root, required).select("event_id")


# ------------------------------------------------------------------ generators

def _embeddings_log(spark, d):
    emb = I.table(spark, d, "embeddings")
    rec = F.struct("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    return I.log_of(emb, F.col("vec_id") * 10, I.record_line("embeddings", rec))


def unnest_scalars(spark, d):
    tabs = tables_from_log(_embeddings_log(spark, d), "embeddings", S.EMBEDDINGS, ["vec_id"],
                           batched_at=BATCHED_AT)
    return tabs[("embeddings", "embedding")].select("_sdc_source_key_vec_id", "_sdc_level_0_id", "_sdc_value")


def _conversations(spark, d, materialize: bool = False):
    return tables_from_log(I.conversation_log(spark, d), "conversations", S.CONVERSATIONS, ["conv_id"],
                           batched_at=BATCHED_AT, materialize=materialize)


def unnest_nested(spark, d):
    t = _conversations(spark, d)[("conversations", "turns", "_sdc_value")]
    return t.select("_sdc_source_key_conv_id", "_sdc_level_0_id", "_sdc_level_1_id", "_sdc_value")


def flatten_all_counts(spark, d):
    orders, convs = table_counts(_orders(spark, d, True)), table_counts(_conversations(spark, d, True))
    return orders.unionByName(convs)


def load_counts(spark, d):
    return loader_load_counts(_orders(spark, d, True))


# ------------------------------------------------------------------ windows / joins / merge

def latest_per_key(spark, d):
    recs = M.route(M.parse(I.event_log(spark, d)))["records"]
    tabs, plans, _ = tables_from_records(recs, "events", S.EVENTS, ["user_id"], BATCHED_AT,
                                         keep=("pos",))
    root = tabs[("events",)]
    return merge.latest_per_key(root, ["user_id"], pos="pos").select("user_id", "event_id", "_sdc_sequence")


def latest_child_rows(spark, d):
    base = I.order_docs(spark, d)
    first = I.log_of(base, F.col("o_orderkey") * 10, I.record_line("orders", F.col("record"), sequence=F.lit(1)),
                     derived=True)
    again = base.filter(F.col("o_orderstatus") == "F").withColumn(
        "record", F.col("record").withField("lines", F.reverse(F.col("record.lines"))))
    second = I.log_of(again, F.col("o_orderkey") * 10 + 1,
                      I.record_line("orders", F.col("record"), sequence=F.lit(2)), derived=True)
    tabs = tables_from_log(I.materialized(first.unionByName(second)), "orders", S.ORDERS, ["o_orderkey"],
                           batched_at=BATCHED_AT)
    kids = tabs[("orders", "lines")]
    out = merge.latest_per_key(kids, ["_sdc_source_key_o_orderkey", "_sdc_level_0_id"])
    return out.select("_sdc_source_key_o_orderkey", "_sdc_level_0_id", "l_partkey", "l_suppkey",
                      "l_linenumber", "_sdc_sequence")


def _split_load(spark, d):
    cur = merge.latest_per_key(I.event_rows(I.stored_events(spark, d)), ["user_id"], pos="_pos")
    inc = I.event_rows(I.incoming_events(spark, d))
    return cur, inc


def replaceable_keys(spark, d):
    cur, inc = _split_load(spark, d)
    return merge.replaceable_keys(cur, merge.latest_per_key(inc, ["user_id"], pos="_pos"), ["user_id"])


def insert_new_keys(spark, d):
    cur, inc = _split_load(spark, d)
    ins = merge.insert_new_keys(cur, merge.latest_per_key(inc, ["user_id"], pos="_pos"), ["user_id"])
    return ins.select("user_id", "event_id", "_sdc_sequence")


def upsert_latest(spark, d):
    cur, inc = _split_load(spark, d)
    out = merge.upsert(cur.drop("_pos"), inc, ["user_id"], pos="_pos")
    return out.select("user_id", "event_id", "event_type", "value", "_sdc_sequence")


def upsert_stats(spark, d):
    cur, inc = _split_load(spark, d)
    return merge.upsert_stats(merge.upsert(cur.drop("_pos"), inc, ["user_id"], pos="_pos", with_action=True))


def late_rows(spark, d):
    cur, inc = _split_load(spark, d)
    late = merge.late_rows(cur, merge.latest_per_key(inc, ["user_id"], pos="_pos"), ["user_id"])
    return late.select("user_id", "event_id", "_sdc_sequence")


def upsert_children(spark, d):
    keys = ["o_orderkey"]
    pk = ["_sdc_source_key_o_orderkey"]
    base = tables_from_log(I.order_log(spark, d, sequence=1), "orders", S.ORDERS, keys, batched_at=BATCHED_AT,
                           materialize=True)
    docs = I.order_docs(spark, d, lines_filter=F.col("l_linestatus") == "O")
    resend = docs.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).withColumn(
        "record", F.when(F.col("o_orderpriority") == "2-HIGH",
                         F.col("record").withField("lines", F.slice(F.col("record.lines"), 1, 0)))
        .otherwise(F.col("record")))
    log = I.materialized(I.log_of(resend, F.col("o_orderkey") * 10 + 1,
                                  I.record_line("orders", F.col("record"), sequence=F.lit(2)), derived=True))
    inc = tables_from_log(log, "orders", S.ORDERS, keys, batched_at=BATCHED_AT, materialize=True)
    dec = merge.parent_decisions(base[("orders",)], inc[("orders",)], keys)
    kids = merge.upsert_children(base[("orders", "lines")], inc[("orders", "lines")], pk,
                                 ["_sdc_level_0_id"], dec)
    return kids.select("_sdc_source_key_o_orderkey", "_sdc_level_0_id", "l_partkey", "l_linenumber",
                       "l_linestatus", "_sdc_sequence")


# ------------------------------------------------------------------ versions (table store)

def stale_version_skip(spark, d):
    ev = I.table(spark, d, "events")
    base = _scratch(spark, "stale")
    store = TableStore(spark, base, buckets=16)
    plans = plan_tables("events", S.EVENTS_KEYED, ["user_id"])

    def batch(version):
        log = I.log_of(ev, F.col("event_id") * 10, I.record_line(
            "events", F.struct("event_id", "user_id", "event_type", "value"),
            sequence=I.event_sequence(F.col("event_id")), version=F.lit(version)))
        return st.stamp(stream_records(log, "events"), BATCHED_AT)

    store.write_batch("events", plans, batch(2), batch_id=0, version=2)
    store.write_batch("events", plans, batch(1), batch_id=1, version=1)
    return store.read("events").select("user_id", "event_id", "_sdc_table_version")


def activate_version(spark, d):
    orders = I.table(spark, d, "orders")
    store = TableStore(spark, _scratch(spark, "activate"), buckets=16)
    plans = plan_tables("orders", S.ORDERS_VERSIONED, ["o_orderkey"])

    def batch(df, version):
        log = I.log_of(df, F.col("o_orderkey") * 10, I.record_line(
            "orders", F.struct("o_orderkey", "o_orderstatus"), sequence=F.lit(1), version=F.lit(version)))
        return st.stamp(stream_records(log, "orders"), BATCHED_AT)

    store.write_batch("orders", plans, batch(orders, 1), batch_id=0, version=1)
    store.write_batch("orders", plans, batch(orders.filter(F.col("o_orderstatus") == "O"), 2),
                      batch_id=1, version=2)
    store.activate_version("orders", 2)
    return store.read("orders").select("o_orderkey", "o_orderstatus", "_sdc_table_version")


# ------------------------------------------------------------------ evolution

def _customer_batch(spark, d, schema, cond):
    cust = I.table(spark, d, "customer").filter(cond)
    fields = list(schema["properties"])
    log = I.log_of(cust, F.col("c_custkey") * 10,
                   I.record_line("customer", F.struct(*fields), sequence=F.lit(1)))
    return tables_from_log(log, "customer", schema, ["c_custkey"], batched_at=BATCHED_AT)[("customer",)]


def evolve_union(spark, d):
    seg = F.col("c_mktsegment") == "BUILDING"
    old_plan = plan_tables("customer", S.CUSTOMER_V1, ["c_custkey"])[0]
    new_plan = plan_tables("customer", S.CUSTOMER_V2, ["c_custkey"])[0]
    old_layout = evolve(None, old_plan, "customer")[0]
    new_layout, changes = evolve(old_layout, new_plan, "customer", table_empty=False)
    cur = project(_customer_batch(spark, d, S.CUSTOMER_V1, seg), new_layout, changes)
    inc = project(_customer_batch(spark, d, S.CUSTOMER_V2, ~seg), new_layout, [])
    return merge.upsert(cur, inc, ["c_custkey"]).select("c_custkey", "c_name", "c_nationkey", "c_acctbal")


def _split_batches(spark, d, steps):
    """Run typed batches through layout evolution; return the final table."""
    layout, table = None, None
    for schema, cond, v in steps:
        ev = I.table(spark, d, "events").filter(cond)
        log = I.log_of(ev, F.col("event_id") * 10, I.record_line(
            "events", F.struct("event_id", v.alias("v")), sequence=F.lit(1)))
        plans = plan_tables("events", schema, ["event_id"])
        new_layout, changes = evolve(layout, plans[0], "events", table_empty=layout is None)
        recs = st.stamp(stream_records(log, "events"), BATCHED_AT)
        inc = apply_schema(recs, plans, {plans[0].path: new_layout})[plans[0].path]
        table = inc if table is None else merge.upsert(project(table, new_layout, changes), inc, ["event_id"])
        layout = new_layout
    return table


def split_column(spark, d):
    et = F.col("event_type")
    t = _split_batches(spark, d, [
        (S.SPLIT_INT, et != "purchase", F.floor("value").cast("bigint")),
        (S.SPLIT_STR, et == "purchase", F.concat(F.lit("u"), F.col("user_id").cast("string"))),
    ])
    return t.select("event_id", "v__i", "v__s")


def split_column_third(spark, d):
    et = F.col("event_type")
    t = _split_batches(spark, d, [
        (S.SPLIT_INT, ~et.isin("purchase", "error"), F.floor("value").cast("bigint")),
        (S.SPLIT_STR, et == "purchase", F.concat(F.lit("u"), F.col("user_id").cast("string"))),
        (S.SPLIT_BOOL, et == "error", F.col("value") > 25),
    ])
    return t.select("event_id", "v__i", "v__s", "v__b")


# ------------------------------------------------------------------ names

def canonical_names(spark, d):
    part = I.table(spark, d, "part").select(F.lit("part").alias("source"), F.col("p_partkey").alias("id"),
                                            F.col("p_name").alias("raw"))
    pages = I.table(spark, d, "pages").select(F.lit("pages").alias("source"), F.col("page_id").alias("id"),
                                              F.col("url").alias("raw"))
    names = part.unionByName(pages)
    return names.withColumn("name", fit_name(canonical_name(F.col("raw")), limit=MAX_IDENTIFIER))


def name_collisions(spark, d):
    from ..plans.naming import collision_names
    part = I.table(spark, d, "part")
    raw = part.select(F.col("p_brand").alias("raw"), (F.col("p_partkey") * 2).alias("arrival")) \
        .unionByName(part.select(F.upper("p_brand").alias("raw"), (F.col("p_partkey") * 2 + 1).alias("arrival")))
    first = raw.groupBy("raw").agg(F.min("arrival").alias("arrival"))
    return collision_names(first, "raw", "arrival").select("raw", "name")


def name_collisions_hot(spark, d):
    """Names that nearly all fold onto a few canonical ones: every line's numbers with marks between
    them, of which only the first mark's kind tells the groups apart."""
    from ..plans.naming import collision_names
    mark = F.when(F.col("l_orderkey") % 3 == 0, F.lit("-")).otherwise(F.lit("a"))
    raw = F.concat(mark, F.translate(F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "0123456789", "+,-.:;=!?*"))
    names = I.table(spark, d, "lineitem").select(raw.alias("raw"), (F.col("l_orderkey") * 1000 + F.col("l_partkey") % 1000).alias("arrival"))
    first = names.groupBy("raw").agg(F.min("arrival").alias("arrival"))
    return collision_names(first, "raw", "arrival", bucket=1 << 18).select("raw", "name")


# ------------------------------------------------------------------ table store

def _append(store: TableStore, schema: dict, key: list[str], df: DataFrame, record: F.Column, batch: int,
            stream: str, sequence: F.Column, pos: F.Column, version: int | None = None) -> dict:
    """One batch of records made from ``df`` through the store."""
    extra = {"sequence": sequence} | ({} if version is None else {"version": F.lit(version)})
    log = I.log_of(df, pos, I.record_line(stream, record, **extra))
    recs = st.stamp(stream_records(log, stream), BATCHED_AT)
    return store.write_batch(stream, plan_tables(stream, schema, key), recs, batch_id=batch, version=version)


def _stored_orders(spark, d) -> TableStore:
    """Orders in three appended batches: all (sequence 2), those that are done again with a new total
    (sequence 3), and late copies of every third one (sequence 1)."""
    orders, key = I.table(spark, d, "orders"), F.col("o_orderkey")
    store = TableStore(spark, _scratch(spark, "orders"), buckets=16)
    steps = [(orders, F.col("o_totalprice"), 2), (orders.filter("o_orderstatus = 'F'"), F.col("o_totalprice") * 2, 3),
             (orders.filter(key % 3 == 0), F.lit(-1.0), 1)]
    for batch, (rows, total, sequence) in enumerate(steps):
        _append(store, S.ORDERS_TOTAL, ["o_orderkey"], rows, F.struct("o_orderkey", "o_orderstatus", total.alias("o_totalprice")),
                batch, "orders", F.lit(sequence), key * 10 + batch)
    return store


def scan_stored(spark, d):
    """A stored table read by columns, over several appended batches."""
    return _stored_orders(spark, d).read("orders", columns=["o_orderkey", "o_totalprice", "_sdc_sequence"])


def lookup_keys(spark, d):
    """Stored rows of the keys of another table: only their buckets are read."""
    wanted = I.table(spark, d, "lineitem").filter("l_returnflag = 'R' and l_quantity >= 49").select("l_orderkey").distinct()
    return _stored_orders(spark, d).read("orders", keys=wanted).select("o_orderkey", "o_orderstatus", "o_totalprice", "_sdc_sequence")


def split_stored(spark, d):
    """A field that is an integer, then a text, then a boolean, in three stored batches: every batch keeps
    the layout it was written with."""
    et, ev = F.col("event_type"), I.table(spark, d, "events")
    store = TableStore(spark, _scratch(spark, "split"), buckets=8)
    steps = [(S.SPLIT_INT, ~et.isin("purchase", "error"), F.floor("value").cast("bigint")),
             (S.SPLIT_STR, et == "purchase", F.concat(F.lit("u"), F.col("user_id").cast("string"))),
             (S.SPLIT_BOOL, et == "error", F.col("value") > 25)]
    for batch, (schema, cond, v) in enumerate(steps):
        _append(store, schema, ["event_id"], ev.filter(cond), F.struct("event_id", v.alias("v")), batch, "events",
                F.lit(1), F.col("event_id") * 10)
    return store.read("events").select("event_id", "v__i", "v__s", "v__b")


def upsert_odd_keys(spark, d):
    """Keys ``ID`` and ``account-id``, stored as ``id`` and ``account_id``, with a child table."""
    cust, key = I.table(spark, d, "customer"), F.col("c_custkey")
    store = TableStore(spark, _scratch(spark, "odd"), buckets=8)

    def batch(rows, n, words, sequence):
        rec = F.struct(key.alias("ID"), F.concat(F.lit("a"), (key % 7).cast("string")).alias("account-id"),
                       F.col("c_name").alias("Name"), words.alias("Words"))
        _append(store, S.ODD_KEYS, ["ID", "account-id"], rows, rec, n, "accounts", F.lit(sequence), key * 10 + n)

    batch(cust, 0, F.array("c_mktsegment", "c_name"), 1)
    batch(cust.filter(key % 2 == 0), 1, F.array(F.upper("c_name")), 2)
    kids = store.read("accounts", ("accounts", "Words"))
    return kids.select(F.col("_sdc_source_key_id").alias("id"), F.col("_sdc_source_key_account_id").alias("account_id"),
                       F.col("_sdc_level_0_id").alias("level"), F.col("_sdc_value").alias("word"), "_sdc_sequence")


def unplaced_values(spark, d):
    """Rows whose value fits no column, set aside by the store itself (no validation ran)."""
    ev, et = I.table(spark, d, "events"), F.col("event_type")
    v = F.when(et == "error", F.lit('"text"')).when(et == "signup", F.lit("null")) \
         .otherwise(F.floor("value").cast("bigint").cast("string"))
    rec = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"v":'), v, F.lit("}"))
    log = I.log_of(ev, F.col("event_id") * 10, I.record_line_raw("mixed", rec))
    store = TableStore(spark, _scratch(spark, "unplaced"), buckets=8)
    store.write_batch("mixed", plan_tables("mixed", S.SPLIT_INT, ["event_id"]),
                      st.stamp(stream_records(log, "mixed"), BATCHED_AT), batch_id=0)
    aside = store.unplaced("mixed").select("event_id", "pos", F.array_join("paths", ",").alias("path"), F.lit(None).cast("long").alias("v"))
    return aside.unionByName(store.read("mixed").select("event_id", F.lit(None).cast("long").alias("pos"),
                                                        F.lit(None).cast("string").alias("path"), "v"))


def upsert_children_hot(spark, d):
    """Children of which a third belong to one parent, replaced where the parent was sent again."""
    li = I.table(spark, d, "lineitem")
    parent = F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")).cast("bigint")
    base = li.select(parent.alias("_sdc_source_key_k"), F.col("l_orderkey").cast("bigint").alias("_sdc_level_0_id"),
                     F.col("l_linenumber").cast("bigint").alias("_sdc_level_1_id"), "l_partkey", F.lit(1).cast("bigint").alias("_sdc_sequence"))
    levels = ["_sdc_level_0_id", "_sdc_level_1_id"]
    base = base.dropDuplicates(["_sdc_source_key_k", *levels]).select("_sdc_source_key_k", *levels, F.lit(1).cast("bigint").alias("_sdc_sequence"))
    inc = base.filter("_sdc_level_1_id = 1 and (_sdc_source_key_k = 0 or _sdc_source_key_k % 5 = 1)") \
        .withColumn("_sdc_sequence", F.lit(2).cast("bigint"))
    won = inc.select("_sdc_source_key_k", F.col("_sdc_sequence").alias("__win_seq")).distinct()
    return merge.upsert_children(base, inc, ["_sdc_source_key_k"], levels, won, hot=True)


# ------------------------------------------------------------------ bookmarks / streaming

def _with_pos(log: DataFrame) -> DataFrame:
    """Lines that carry their position themselves."""
    return log.select(F.concat(F.expr("substring(line, 1, length(line) - 1)"), F.lit(',"pos":'),
                               F.col("pos").cast("string"), F.lit("}")).alias("line"), "pos")


class _Feed:
    """A folder of message files, loaded as they are added; every batch is many files."""

    def __init__(self, spark, tag: str, **options):
        from ..streaming.job import LogLoader
        self.spark, self.base = spark, _scratch(spark, tag)
        self.store = TableStore(spark, f"{self.base}/tables", buckets=16)
        self.loader = LogLoader(spark, self.store, clock=lambda: BATCHED_AT, **{"emit_states": False} | options)
        self.batches = 0

    def load(self, log: DataFrame, job: str = "a") -> None:
        _with_pos(log).select("line").write.text(f"{self.base}/in-{job}/b{self.batches}")
        self.batches += 1
        self.loader.run(f"{self.base}/in-{job}/*", checkpoint=f"{self.base}/ckpt-{job}", max_files_per_trigger=None)

    def commits(self, streams: list[str]) -> DataFrame:
        """The commits of the streams, in the order they were made."""
        rows = sorted((c["batch"], c["segment"], c["stream"], c["first_pos"], c["last_pos"], name, n)
                      for s in streams for c in self.store.commit_log(s) for name, n in c["rows"].items())
        return self.spark.createDataFrame(rows, "batch long, segment long, stream string, first_pos long, last_pos long, "
                                                "table_name string, n long")


def _event_batches(spark, d, parts: int = 2, **options):
    """The event log with SCHEMA and STATE lines, cut into batches by event id, and its streams."""
    top = I.table(spark, d, "events").agg(F.max("event_id")).first()[0]
    log = I.event_log(spark, d, **options)
    part = F.least(F.floor(F.col("pos") * parts / (10 * (top + 1))), F.lit(parts - 1))
    streams = sorted(r[0] for r in I.table(spark, d, "events").select("event_type").distinct().collect())
    return [log.filter(part == b) if b else log.filter(part <= 0) for b in range(parts)], streams


def safe_bookmarks(spark, d):
    """After each commit of a load, the newest STATE that is safe."""
    feed = _Feed(spark, "bookmarks", parallel_streams=5)
    batches, streams = _event_batches(spark, d, states=True)
    for log in batches:
        feed.load(log)
    made = feed.commits(streams)
    order = [r.asDict() for r in made.collect()]   # one small row per commit
    numbered = spark.createDataFrame([(i, c["stream"], c["first_pos"]) for i, c in enumerate(order, 1)],
                                     "n long, stream string, first_pos long")
    states = M.route(M.parse(I.event_log(spark, d, states=True)))["states"]
    return B.safe_bookmarks(numbered, states.select("pos"))


def load_metrics(spark, d):
    """Rows per batch, segment and table that a load reports."""
    feed = _Feed(spark, "metrics", parallel_streams=5)
    batches, streams = _event_batches(spark, d)
    for log in batches:
        feed.load(log)
    return feed.commits(streams).select("batch", "segment", "table_name", F.col("n").alias("rows"), "first_pos", "last_pos")


def bookmark_changes(spark, d):
    r = M.route(M.parse(I.event_log(spark, d, states=True)))
    return B.bookmark_changes(r["states"])


def _keyed_log(spark, rows: DataFrame, pos: F.Column, first_pos: int, schema: dict | None = None, **extra) -> DataFrame:
    """A SCHEMA line and one RECORD of stream ``events`` per row."""
    rec = F.struct("event_id", "user_id", "event_type", "value")
    recs = I.log_of(rows, pos, I.record_line("events", rec, sequence=I.event_sequence(F.col("event_id")), **extra))
    head = spark.range(1).select(F.lit(first_pos).cast("bigint").alias("pos"),
                                 I.schema_line("events", schema or S.EVENTS_KEYED, ["user_id"]).alias("line"))
    return head.unionByName(recs)


def stream_upsert(spark, d):
    """D6 as log files, loaded by the Structured Streaming job (availableNow)."""
    feed = _Feed(spark, "stream")
    pos = F.col("event_id") * 10
    feed.load(_keyed_log(spark, I.stored_events(spark, d), pos, -1))
    feed.load(_keyed_log(spark, I.incoming_events(spark, d), pos + 1_000_000_000_000, 999_999_999_999))
    return feed.store.read("events").select("user_id", "event_id", "event_type", "value", "_sdc_sequence")


def stream_two_loads(spark, d):
    """Two jobs with their own checkpoints load into one store; neither hides the other's batches."""
    feed = _Feed(spark, "two")
    pos = F.col("event_id") * 10
    feed.load(_keyed_log(spark, I.stored_events(spark, d), pos, -1), job="a")
    feed.load(_keyed_log(spark, I.incoming_events(spark, d), pos, -1), job="b")
    return feed.store.read("events").select("user_id", "event_id", "_sdc_sequence")


def stream_versions(spark, d):
    """Version 1, then version 2 staged and activated, then rows of version 1 that come too late."""
    feed = _Feed(spark, "versions")
    ev, pos = I.table(spark, d, "events"), F.col("event_id") * 10
    shift = 1_000_000_000_000
    activate = spark.range(1).select(F.lit(2 * shift).cast("bigint").alias("pos"),
                                     F.lit('{"type":"ACTIVATE_VERSION","stream":"events","version":2}').alias("line"))
    feed.load(_keyed_log(spark, ev, pos, -1, version=F.lit(1)))
    feed.load(_keyed_log(spark, ev.filter("event_type <> 'view'"), pos + shift, shift - 1, version=F.lit(2)).unionByName(activate))
    feed.load(_keyed_log(spark, ev.filter("event_type = 'view'"), pos + 3 * shift, 3 * shift - 1, version=F.lit(1)))
    return feed.store.read("events").select("user_id", "event_id", "event_type", "_sdc_table_version")


def stream_schema_repeats(spark, d):
    """The same SCHEMA again and again cuts nothing; a wider one cuts its batch in two.  Rows per commit."""
    feed = _Feed(spark, "repeats")
    ev, pos = I.table(spark, d, "events"), F.col("event_id") * 10
    again = [spark.range(1).select(F.lit(p).cast("bigint").alias("pos"), I.schema_line("events", schema, ["user_id"]).alias("line"))
             for p, schema in ((1005, S.EVENTS_KEYED), (2005, S.EVENTS_KEYED), (3005, S.EVENTS_WIDER), (4005, S.EVENTS_WIDER))]
    log = _keyed_log(spark, ev, pos, -1)
    for line in again:
        log = log.unionByName(line)
    feed.load(log)
    return feed.commits(["events"]).select("segment", "first_pos", "last_pos", F.col("n").alias("rows"))


def validate_keywords(spark, d):
    """Every rule of a schema with all keywords, on order documents."""
    recs = stream_records(I.order_log(spark, d), "orders")
    v = checks.validate(recs, S.ORDER_RULES)
    return v.select(F.expr("try_variant_get(record, '$.o_orderkey', 'bigint')").alias("o_orderkey"),
                    (F.size(checks.REASONS) == 0).alias("is_valid"))


QUERIES = {
    "read_messages": read_messages,
    "route_messages": route_messages,
    "orphan_records": orphan_records,
    "schema_in_force": schema_in_force,
    "validate_records": validate_records,
    "invalid_by_stream": invalid_by_stream,
    "latest_version_rows": latest_version_rows,
    "load_metadata": load_metadata,
    "surrogate_key": surrogate_key,
    "flatten_objects": flatten_objects,
    "load_documents": load_documents,
    "type_split": type_split,
    "int_to_number": int_to_number,
    "default_fill": default_fill,
    "datetime_norm": datetime_norm,
    "null_literal": null_literal,
    "not_null_check": not_null_check,
    "unnest_lines": unnest_lines,
    "unnest_scalars": unnest_scalars,
    "unnest_nested": unnest_nested,
    "flatten_all_counts": flatten_all_counts,
    "latest_per_key": latest_per_key,
    "latest_child_rows": latest_child_rows,
    "replaceable_keys": replaceable_keys,
    "insert_new_keys": insert_new_keys,
    "upsert_latest": upsert_latest,
    "upsert_stats": upsert_stats,
    "upsert_children": upsert_children,
    "late_rows": late_rows,
    "stale_version_skip": stale_version_skip,
    "activate_version": activate_version,
    "evolve_union": evolve_union,
    "split_column": split_column,
    "split_column_third": split_column_third,
    "canonical_names": canonical_names,
    "name_collisions": name_collisions,
    "name_collisions_hot": name_collisions_hot,
    "load_counts": load_counts,
    "safe_bookmarks": safe_bookmarks,
    "bookmark_changes": bookmark_changes,
    "stream_upsert": stream_upsert,
    "scan_stored": scan_stored,
    "lookup_keys": lookup_keys,
    "split_stored": split_stored,
    "upsert_odd_keys": upsert_odd_keys,
    "unplaced_values": unplaced_values,
    "upsert_children_hot": upsert_children_hot,
    "load_metrics": load_metrics,
    "stream_two_loads": stream_two_loads,
    "stream_versions": stream_versions,
    "stream_schema_repeats": stream_schema_repeats,
    "validate_keywords": validate_keywords,
}
