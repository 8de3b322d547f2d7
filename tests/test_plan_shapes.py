"""Physical-plan guards for the scale properties the design relies on."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from tablestream.catalog import schemas as S
from tablestream.loader import stream_records, tables_from_log
from tablestream.operators import checks, merge, stamp
from tablestream.sources import messages as M

from samples import DOCUMENT, ORDERS, document
from helpers import log_df, record_msg, schema_msg


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _log(spark):
    msgs = [schema_msg("orders", ORDERS, ["o_orderkey"])] + [
        record_msg("orders", {"o_orderkey": i, "o_orderstatus": "O"}, version=1) for i in range(20)]
    return log_df(spark, msgs)


def test_each_line_is_parsed_once_when_routed(spark):
    plan = _plan(M.route(M.parse(_log(spark)))["records"])
    assert plan.count("parseJson") == 1


def test_version_filter_does_not_join_or_shuffle_records(spark):
    recs = M.route(M.parse(_log(spark)))["records"]
    plan = _plan(stamp.latest_version_rows(recs))
    assert "Join" not in plan and "Exchange" not in plan


def test_runtime_type_computed_once_per_leaf(spark):
    msgs = [record_msg("docs", document(i)) for i in range(3)]
    tabs = tables_from_log(log_df(spark, msgs), "docs", DOCUMENT, ["doc_id"])
    root = tabs[("docs",)]
    leaves = [c for c in root.columns if not c.startswith("_sdc_")]
    assert _plan(root).count("schemaOfVariant") == len(leaves)


def test_upsert_is_one_full_outer_join_without_windows(spark):
    cur = spark.createDataFrame([(1, "a", 1)], "id bigint, v string, _sdc_sequence bigint")
    inc = spark.createDataFrame([(1, "b", 2, 0)], "id bigint, v string, _sdc_sequence bigint, _pos bigint")
    plan = _plan(merge.upsert(cur, inc, ["id"], pos="_pos"))
    assert plan.count("FullOuter") == 1 and "Window" not in plan


def test_asof_windows_are_partitioned_by_group_and_bucket(spark):
    from tablestream.operators.asof import asof_last
    rows = spark.createDataFrame([("hot", i) for i in range(50)], "g string, pos bigint")
    marks = spark.createDataFrame([("hot", 7, 1)], "g string, pos bigint, v bigint")
    plan = _plan(asof_last(rows, marks, ["g"], "pos", "v", "out", bucket=8))
    # the record-level window (over __mv) must partition by the bucket too
    record_level = [ln for ln in plan.split("\n") if "Window [" in ln and "__mv" in ln]
    assert record_level
    for ln in record_level:
        partition_spec = ln.split("windowspecdefinition(")[1]
        assert "g#" in partition_spec and "__b#" in partition_spec


def test_schema_in_force_parses_and_shuffles_the_log_once(spark):
    out = M.records_with_schema(M.parse(_log(spark)))
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("parseJson") == 1 and "ReusedExchange" in final
    # records once; the bucket-level table for its window and for the join
    assert sum("Exchange hashpartitioning" in ln for ln in final.split("\n")) <= 3


def _method_sizes(df) -> list[int]:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]


def _order_log(spark):
    lines = [{c: 1 for c in S.ORDERS["properties"]["lines"]["items"]["properties"]}]
    record = {"o_orderkey": 5, "o_totalprice": 2000.0, "customer": {"c_name": "Customer5"}, "lines": lines}
    return log_df(spark, [schema_msg("orders", S.ORDERS, ["o_orderkey"]), record_msg("orders", record, sequence=1)])


def test_generated_methods_of_order_tables_are_small_enough_to_be_compiled(spark):
    """The JVM interprets methods above 8000 bytes for good."""
    log = _order_log(spark)
    for df in tables_from_log(log, "orders").values():
        assert 0 < max(_method_sizes(df)) < 8000
    checked = checks.validate(stream_records(log, "orders"), S.ORDER_RULES)
    assert 0 < max(_method_sizes(checked)) < 8000


def test_rules_read_items_entries_and_nested_types_from_columns(spark):
    recs = stream_records(_order_log(spark), "orders")
    _, staged = checks._stage(recs, S.ORDER_RULES, F.col("record"))
    rules = str(checks.reasons(S.ORDER_RULES, staged.value, staged))
    for work in ("schema_of_variant", "map_entries", "array<variant>", '["c_name"]'):
        assert work not in rules
    assert [r[0] for r in checks.validate(recs, S.ORDER_RULES).select(checks.REASONS).collect()] == [
        ["customer: c_name needs c_mktsegment"]]


def test_materialized_records_are_read_by_column(spark):
    tabs = tables_from_log(_order_log(spark), "orders", materialize=True)
    plan = tabs[("orders", "lines")]._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" not in plan and "line_bytes" not in plan.split("ReadSchema")[-1]
    assert tabs[("orders", "lines")].count() == 1
