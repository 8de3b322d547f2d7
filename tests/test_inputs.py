"""Derived logs: rows are derived once, and arrays are not shuffled by customer."""

import datetime as dt

from pyspark.sql import functions as F

from tablestream.catalog import inputs as I


def _tables(spark, d):
    day = dt.datetime(2024, 1, 2)
    spark.createDataFrame([(k, k % 3, "O", float(k), day, "5-LOW") for k in range(6)] + [(6, None, "F", 1.0, day, None)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(0, "a", 1, 0.5, "X"), (1, "b", 2, 0.5, "Y")],
                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string") \
        .write.parquet(f"{d}/customer.parquet")
    spark.createDataFrame([(k, 1, 1, n, 1.0, 1.0, 0.1, 0.1, "N", "O", day) for k in range(4) for n in (2, 1)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                          "l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{d}/lineitem.parquet")


def test_order_docs(spark, scratch):
    _tables(spark, scratch)
    got = {r.o_orderkey: r.record for r in I.order_docs(spark, scratch).collect()}
    assert {k: [x.l_linenumber for x in r.lines] for k, r in got.items()} == \
        {**{k: [1, 2] for k in range(4)}, 4: [], 5: [], 6: []}
    assert {k: r.customer and r.customer.c_name for k, r in got.items()} == \
        {0: "a", 1: "b", 2: None, 3: "a", 4: "b", 5: None, 6: None}


def test_lines_join_last_and_are_not_shuffled_by_customer(spark, scratch):
    _tables(spark, scratch)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = I.order_docs(spark, scratch)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    joins = [ln for ln in plan.split("\n") if "SortMergeJoin" in ln]
    assert len(joins) == 2 and "o_orderkey" in joins[0] and "o_custkey" in joins[1]


def test_derived_logs_run_no_job_before_they_are_read(spark, scratch):
    _tables(spark, scratch)
    spark.sparkContext.setJobGroup("derived-log", "log_of")
    try:
        docs = I.order_docs(spark, scratch)
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("derived-log"))
        I.log_of(docs, F.col("o_orderkey") * 10, I.record_line("orders", F.col("record")), derived=True)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("derived-log")) == before
        log = I.order_log(spark, scratch)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(r.pos for r in log.collect()) == [-5, 0, 10, 20, 30, 40, 50, 60]
    assert log.inputFiles()   # stored once, read as files
