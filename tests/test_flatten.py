"""apply_schema / unnesting (P7-P15, G1-G7) on nested conversations, documents and orders."""

import datetime as dt

from tablestream.loader import stream_records, tables_from_log
from tablestream.operators.flatten import UNPLACED, apply_schema, default_layouts
from tablestream.operators.stamp import stamp
from tablestream.plans.tables import plan_tables

from helpers import log_df, record_msg, rows, schema_msg
from samples import CONVERSATION, DEEP, DOCUMENT, MANY, ORDERS, document, order_rows


def _tables(spark, stream, schema, keys, records):
    msgs = [schema_msg(stream, schema, keys)] + [record_msg(stream, r, sequence=i) for i, r in enumerate(records)]
    return tables_from_log(log_df(spark, msgs), stream)


def test_orders_of_the_driver_tables_keep_every_line(spark):
    sent = order_rows(40)
    tabs = _tables(spark, "orders", ORDERS, ["o_orderkey"], [
        {"o_orderkey": k, "o_orderstatus": status, "lines": [{"l_partkey": int(p), "l_returnflag": f} for p, f in lines]}
        for k, status, lines in sent])
    assert rows(tabs[("orders",)], "o_orderkey", "o_orderstatus") == sorted((k, s) for k, s, _ in sent)
    got = rows(tabs[("orders", "lines")], "_sdc_source_key_o_orderkey", "_sdc_level_0_id", "l_partkey", "l_returnflag")
    assert got == sorted((k, i, int(p), f) for k, _, lines in sent for i, (p, f) in enumerate(lines))


def test_lists_of_lists(spark):
    tabs = _tables(spark, "docs", DOCUMENT, ["doc_id"], [document(i) for i in range(12)])
    outer = [(i, k) for i in range(12) for k in range(i % 4)]
    assert rows(tabs[("docs", "grid")], "_sdc_source_key_doc_id", "_sdc_level_0_id") == outer
    inner = rows(tabs[("docs", "grid", "_sdc_value")], "_sdc_source_key_doc_id", "_sdc_level_0_id", "_sdc_level_1_id", "_sdc_value")
    assert inner == [(i, k, j, j) for i, k in outer for j in range(k)]        # an empty list gives no row
    assert rows(tabs[("docs", *DEEP)], "_sdc_source_key_doc_id", "_sdc_value") == [(i, h) for i in range(1, 12, 2) for h in "ab"]
    assert rows(tabs[("docs",)], f"{DEEP[0]}__{DEEP[1]}__status") == [(200 + i,) for i in range(12)]


def test_defaults_nulls_dates_and_children(spark):
    tabs = _tables(spark, "conv", CONVERSATION, ["conv_id"], [
        {"conv_id": 1, "opened": "2021-03-04T05:06:07.654321-02:30",
         "ended": {"at": "2021-03-05T00:00:00Z", "solved": True, "tags": ["late", "NULL"]},
         "turns": [{"role": "user", "scores": [0.5, 2]}, None, {"role": None, "scores": []}, {}]},
        {"conv_id": 2, "channel": None, "n_turns": 9, "opened": "2021-03-04T00:00:00Z", "ended": None, "turns": None, "extra": 1},
        {"conv_id": 3, "channel": "NULL", "opened": "2021-03-04T00:00:00Z", "ended": {"tags": []}, "turns": []},
    ])
    root = {r["conv_id"]: r for r in tabs[("conv",)].collect()}
    assert [root[i]["channel"] for i in (1, 2, 3)] == ["web", "web", None]      # missing, null, the literal NULL
    assert [root[i]["n_turns"] for i in (1, 2, 3)] == [1, 9, 1]
    assert root[1]["opened"] == dt.datetime(2021, 3, 4, 7, 36, 7, 654300)
    assert [root[i]["ended__solved"] for i in (1, 2, 3)] == [True, None, None]
    assert "extra" not in tabs[("conv",)].columns
    assert rows(tabs[("conv", "ended", "tags")], "_sdc_source_key_conv_id", "_sdc_level_0_id", "_sdc_value") == [(1, 0, "late"), (1, 1, None)]
    turns = rows(tabs[("conv", "turns")], "_sdc_source_key_conv_id", "_sdc_level_0_id", "role", "_sdc_sequence")
    assert turns == [(1, 0, "user", 0), (1, 1, None, 0), (1, 2, None, 0), (1, 3, None, 0)]
    assert rows(tabs[("conv", "turns", "scores")], "_sdc_level_0_id", "_sdc_level_1_id", "_sdc_value") == [(0, 0, 0.5), (0, 1, 2.0)]


def test_values_of_many_types_and_what_fits_nowhere(spark):
    sent = [None, 41, 2.5, False, "2020-06-01T12:00:00+01:00", "soon", ["x", "y", "z"], {"b": "text", "n": 6}]
    plans = plan_tables("many", MANY, [])
    layouts = default_layouts(plans)
    log = log_df(spark, [record_msg("many", {"value": v, "price": 3}, sequence=1) for v in sent])
    out = apply_schema(stamp(stream_records(log, "many"), dt.datetime(2024, 1, 1), keyless=True), plans, layouts,
                       with_unplaced=True, keep=("pos",))
    typed = sorted(m["to"] for m in layouts[("many",)].mappings if m["from"][0] == "value")
    got = {r["pos"]: ({c: r[c] for c in typed if r[c] is not None}, r[UNPLACED]) for r in out[("many",)].collect()}
    by_value = [got[p] for p in sorted(got)]
    flag = next(c for c in typed if dict(out[("many",)].dtypes)[c] == "boolean")
    text = next(c for c in typed if dict(out[("many",)].dtypes)[c] == "string")
    assert by_value == [({}, []), ({"value__i": 41}, []), ({}, ["value"]), ({flag: False}, []),
                        ({"value__t": dt.datetime(2020, 6, 1, 11)}, []), ({}, ["value"]), ({}, []),
                        ({text: "text", "value__n": 6}, [])]
    assert {r["price"] for r in out[("many",)].collect()} == {3.0}
    assert rows(out[("many", "value")], "_sdc_value") == [("x",), ("y",), ("z",)]


def test_fields_that_are_only_null_and_numbers_or_texts(spark):
    pages = {"type": ["object", "null"], "properties": {
        "page_id": {"type": ["null", "integer"]}, "frames": {"type": "null"},
        "links": {"type": ["null", "object"], "properties": {"rank": {"type": ["null", "number", "string"]}}}}}
    sent = [{}, {"page_id": 4}, {"links": {}}, {"links": {"rank": 8}}, {"links": {"rank": 0.25}}, {"links": {"rank": "top"}, "frames": None}]
    root = _tables(spark, "pages", pages, [], sent)[("pages",)]
    assert "frames" not in root.columns and root.select("_sdc_primary_key").distinct().count() == len(sent)
    got = {(r[0], r[1]) for r in root.select("links__rank__f", "links__rank__s").collect()} - {(None, None)}
    assert got == {(8.0, None), (0.25, None), (None, "top")}
