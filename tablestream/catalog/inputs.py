"""Derived message logs built in Spark from the driver tables.

Every log is a DataFrame ``(pos bigint, line string)`` of JSON messages, so
its size grows with the tables it is derived from.  Record positions are
``10 * id``; SCHEMA / STATE messages sit at ``10 * id - 5`` / ``+ 5`` so the
order against records is exact.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import iso_utc
from ..session import stored
from . import schemas as S


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _message(kind: str, stream: Column | str, payload: dict[str, Column]) -> Column:
    s = F.lit(stream) if isinstance(stream, str) else stream
    fields = [F.lit(kind).alias("type"), s.alias("stream")]
    fields += [c.alias(k) for k, c in payload.items()]
    return F.to_json(F.struct(*fields))


def record_line(stream, record: Column, **extra: Column) -> Column:
    return _message("RECORD", stream, {"record": record, **extra})


def record_line_raw(stream, record_json: Column, **extra: Column) -> Column:
    """RECORD message around a record given as JSON *text* (kept verbatim, so
    ``122.0`` stays a number; a VARIANT round trip would print ``122``)."""
    s = F.lit(stream) if isinstance(stream, str) else stream
    parts = [F.lit('{"type":"RECORD","stream":'), json_scalar(s), F.lit(',"record":'), record_json]
    for k, c in extra.items():
        parts.append(F.when(c.isNotNull(), F.concat(F.lit(f',"{k}":'), json_scalar(c))).otherwise(F.lit("")))
    parts.append(F.lit("}"))
    return F.concat(*parts)


def schema_line(stream, schema: dict, keys: list[str]) -> Column:
    # The schema is a fixed text; it is spliced in as raw JSON.
    body = json.dumps({"type": "SCHEMA", "stream": "__S__", "schema": schema, "key_properties": keys})
    head, tail = body.split('"__S__"')
    s = F.lit(stream) if isinstance(stream, str) else stream
    return F.concat(F.lit(head), json_scalar(s), F.lit(tail))


def json_scalar(c: Column) -> Column:
    """JSON text of one scalar column (``to_json`` of a one-item array, brackets cut)."""
    arr = F.to_json(F.array(c))
    return arr.substr(F.lit(2), F.length(arr) - 2)


def log_of(df: DataFrame, pos: Column, line: Column, derived: bool = False) -> DataFrame:
    """``(pos, line)`` of the rows.  ``derived`` rows come out of a join or an aggregate: they lie in the
    partitions of its shuffle, and asking for their number would run it once more."""
    rows = df if derived else spread(df)
    return rows.select(pos.cast("bigint").alias("pos"), line.alias("line"))


def spread(df: DataFrame) -> DataFrame:
    """Give a source with fewer partitions than cores one partition per core.

    The driver tables are single small files (one task); a real log arrives
    in many files and is left alone.  Only for rows read as they are (see :func:`log_of`).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


# ----------------------------------------------------------------- D1 orders

def _line_structs(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    s = F.struct("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 iso_utc(F.col("l_shipdate")).alias("l_shipdate"))
    return li.select("l_orderkey", "l_linestatus", s.alias("line"))


def order_docs(spark: SparkSession, sf_dir: str, lines_filter: Column | None = None) -> DataFrame:
    """One document per order: order fields, customer object, sorted ``lines`` array.

    Orders meet their customer before their lines, so the arrays are shuffled once, by order.
    """
    ls = _line_structs(spark, sf_dir)
    if lines_filter is not None:
        ls = ls.filter(lines_filter)
    lines = ls.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    orders = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer")
    j = orders.join(cust, orders.o_custkey == cust.c_custkey, "left") \
              .join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    rec = F.struct(
        F.col("o_orderkey"), F.col("o_totalprice"), iso_utc(F.col("o_orderdate")).alias("o_orderdate"),
        F.when(F.col("c_custkey").isNotNull(),
               F.struct("c_name", "c_mktsegment", "c_nationkey")).alias("customer"),
        F.coalesce(F.col("lines"), F.array().cast(T.ArrayType(ls.schema["line"].dataType))).alias("lines"))
    return j.select("o_orderkey", "o_orderstatus", "o_orderpriority", rec.alias("record"))


def materialized(df: DataFrame) -> DataFrame:
    """Write a derived log once to the shared checkpoint folder and read it back.

    Logs that need an aggregation to build (D1, D5) are read by several jobs
    (schema lookup, version scan, load); in production they arrive as files,
    so they are materialised once here instead of being re-derived per job: as
    compressed Parquet, of which a job reads the columns it needs.
    """
    return stored(df, "log")


def order_log(spark: SparkSession, sf_dir: str, sequence: int = 1) -> DataFrame:
    """SCHEMA + one RECORD per order (materialised once)."""
    docs = order_docs(spark, sf_dir)
    recs = log_of(docs, F.col("o_orderkey") * 10,
                  record_line("orders", F.col("record"), sequence=F.lit(sequence)), derived=True)
    head = spark.range(1).select(F.lit(-5).cast("bigint").alias("pos"),
                                 schema_line("orders", S.ORDERS, ["o_orderkey"]).alias("line"))
    return materialized(head.unionByName(recs))


# ----------------------------------------------------------------- D2 events

def event_sequence(event_id: Column) -> Column:
    return (event_id * 7919) % 10007


def event_record(extra: dict[str, Column] | None = None) -> Column:
    base = {"event_id": F.col("event_id"), "user_id": F.col("user_id"),
            "event_type": F.col("event_type"), "ts": iso_utc(F.col("ts")),
            "value": F.col("value"), "props": F.col("props")}
    base.update(extra or {})
    return F.struct(*[c.alias(k) for k, c in base.items()])


def event_log(spark: SparkSession, sf_dir: str, broken: bool = False, states: bool = False,
              schemas: str | None = "first", record: Column | None = None,
              **extra: Column) -> DataFrame:
    """D2 (+D4 states) as a log.

    ``schemas``: ``first`` = one SCHEMA per stream before its first record;
    ``late`` = one SCHEMA per stream 50 ids after its first record;
    ``blocks`` = a SCHEMA per stream at its first record of every 1000 ids.
    """
    ev = table(spark, sf_dir, "events")
    rec = record if record is not None else event_record()
    line = record_line(F.col("event_type"), rec, sequence=event_sequence(F.col("event_id")), **extra)
    if broken:  # every 97th line loses its closing brace
        line = F.when(F.col("event_id") % 97 == 0, F.expr("substring(line_, 1, length(line_) - 1)")) \
                .otherwise(F.col("line_"))
        log = ev.withColumn("line_", record_line(F.col("event_type"), rec,
                                                 sequence=event_sequence(F.col("event_id")), **extra))
        recs = log_of(log, F.col("event_id") * 10, line)
    else:
        recs = log_of(ev, F.col("event_id") * 10, line)
    parts = [recs]
    if schemas == "first":
        first = ev.groupBy("event_type").agg(F.min("event_id").alias("m"))
        parts.append(log_of(first, F.col("m") * 10 - 5,
                            schema_line(F.col("event_type"), S.EVENTS, ["user_id"]), derived=True))
    elif schemas == "late":
        first = ev.groupBy("event_type").agg(F.min("event_id").alias("m"))
        parts.append(log_of(first, (F.col("m") + 50) * 10 - 5,
                            schema_line(F.col("event_type"), S.EVENTS, ["user_id"]), derived=True))
    elif schemas == "blocks":
        first = ev.groupBy("event_type", (F.col("event_id") / 1000).cast("bigint").alias("b")) \
                  .agg(F.min("event_id").alias("m"))
        parts.append(log_of(first, F.col("m") * 10 - 5,
                            schema_line(F.col("event_type"), S.EVENTS, ["user_id"]), derived=True))
    if states:
        st = ev.filter(F.col("event_id") % 100 == 99)
        parts.append(log_of(st, F.col("event_id") * 10 + 5, state_line(F.col("event_id"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def state_line(event_id: Column) -> Column:
    """Bookmark value changes every 300 ids, so consecutive states repeat."""
    value = F.struct((event_id / 300).cast("bigint").alias("bookmark"))
    return F.to_json(F.struct(F.lit("STATE").alias("type"), value.alias("value")))


# ----------------------------------------------------------------- D3 mixed field

def mixed_value() -> dict[str, Column]:
    """D3: ``v`` typed by event type."""
    et = F.col("event_type")
    return {
        "v_int": F.when(et == "click", F.floor("value").cast("bigint")),
        "v_num": F.when(et == "view", F.col("value")),
        "v_str": F.when(et == "purchase", F.concat(F.lit("u"), F.col("user_id").cast("string"))),
        "v_bool": F.when(et == "error", F.col("value") > 25),
        "v_ts": F.when((et == "signup") & (F.col("event_id") % 2 == 0), iso_utc(F.col("ts"))),
    }


def mixed_json(which: list[str]) -> Column:
    """JSON text of the D3 value restricted to ``which`` kinds (else JSON null)."""
    parts = mixed_value()
    out = F.lit("null")
    for k in which:
        out = F.when(parts[k].isNotNull(), json_scalar(parts[k])).otherwise(out)
    return out


# ----------------------------------------------------------------- D5 conversations

def conversation_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cv = table(spark, sf_dir, "conversations")
    turns = cv.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", F.split("text", " ", -1).alias("words")))).alias("t"))
    rec = F.struct(F.col("conv_id"), F.transform("t", lambda x: x["words"]).alias("turns"))
    return turns.select("conv_id", rec.alias("record"))


def conversation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = conversation_docs(spark, sf_dir)
    return materialized(log_of(docs, F.col("conv_id") * 10, record_line("conversations", F.col("record"),
                                                                        sequence=F.lit(1)), derived=True))


# ----------------------------------------------------------------- D6 split load

def _first_load(ev: DataFrame) -> Column:
    return (F.col("event_id") % 3 != 0) & (F.col("user_id") % 5 != 0)


def stored_events(spark, sf_dir) -> DataFrame:
    """D6 first load.  Together with :func:`incoming_events` it covers every
    event exactly once; users with ``user_id % 5 == 0`` only arrive later."""
    ev = table(spark, sf_dir, "events")
    return ev.filter(_first_load(ev))


def incoming_events(spark, sf_dir) -> DataFrame:
    """D6 second load: every event not in the first one."""
    ev = table(spark, sf_dir, "events")
    return ev.filter(~_first_load(ev))


def event_rows(ev: DataFrame, version: Column | None = None) -> DataFrame:
    """Typed rows as the flatten step gives them (key ``user_id``)."""
    cols = [F.col("user_id"), F.col("event_id"), F.col("event_type"), F.col("value"),
            event_sequence(F.col("event_id")).cast("bigint").alias("_sdc_sequence"),
            (F.col("event_id") * 10).alias("_pos")]
    if version is not None:
        cols.append(version.cast("bigint").alias("_sdc_table_version"))
    return ev.select(*cols)
