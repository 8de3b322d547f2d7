"""Schema -> table tree (C8) and layout evolution (E1-E9), golden shapes."""

import pytest

from tablestream.plans import jsonschema as js
from tablestream.plans.evolve import LayoutError, check_keys, column_for, evolve
from tablestream.plans.tables import plan_tables

from samples import CONVERSATION, DEEP, DOCUMENT, MANY

META = {"_sdc_received_at", "_sdc_batched_at", "_sdc_sequence", "_sdc_table_version"}


def _cols(layout):
    return {n: (t, nul) for n, t, nul in layout.columns()}


def test_conversation_tables_and_nullability():
    plans = plan_tables("conv", CONVERSATION, ["conv_id"])
    assert [p.path for p in plans] == [("conv",), ("conv", "ended", "tags"), ("conv", "turns"), ("conv", "turns", "scores")]
    root = _cols(evolve(None, plans[0], "conv")[0])
    assert {c for c, (_, null) in root.items() if not null} == {"conv_id", "channel", "n_turns", "opened"}
    assert {c for c, (_, null) in root.items() if null} == {"ended__at", "ended__solved"} | META   # in a nullable object
    assert root["opened"][0] == root["ended__at"][0] == "timestamp"
    tags, turns, scores = (_cols(evolve(None, p, "x")[0]) for p in plans[1:])
    assert tags == {"_sdc_source_key_conv_id": ("bigint", False), "_sdc_sequence": ("bigint", True),
                    "_sdc_level_0_id": ("bigint", False), "_sdc_value": ("string", False)}
    assert turns["role"] == ("string", True) and "scores" not in turns
    assert scores["_sdc_level_1_id"] == ("bigint", False) and scores["_sdc_value"] == ("double", False)
    assert plans[3].arrays == [("turns",), ("scores",)] and plans[3].level == 1


def test_lists_of_lists_and_long_names():
    from tablestream.operators.flatten import default_layouts
    plans = plan_tables("docs", DOCUMENT, ["doc_id"])
    assert [p.path for p in plans] == [("docs",), ("docs", "grid"), ("docs", "grid", "_sdc_value"), ("docs", *DEEP)]
    assert plans[2].level_columns() == ["_sdc_level_0_id", "_sdc_level_1_id"]
    layouts = default_layouts(plans)
    whole = "__".join(("docs", *DEEP))
    assert len(whole) > 63 and layouts[("docs", *DEEP)].name == whole[:63]
    assert f"{DEEP[0]}__{DEEP[1]}__status" in _cols(layouts[("docs",)])


def test_columns_of_a_field_of_many_types():
    plans = plan_tables("many", MANY, [])
    cols = _cols(evolve(None, plans[0], "many")[0])
    assert [p.path for p in plans] == [("many",), ("many", "value")]
    typed = {c: t for c, (t, _) in cols.items() if c.startswith("value")}
    # the object's own field b comes after the boolean column of that name, or before it
    assert sorted(typed.values()) == ["bigint", "bigint", "boolean", "string", "timestamp"]
    assert {"value__i", "value__t", "value__n", "value__b", "value__b__1"} == set(typed)
    assert all(cols[c][1] for c in typed) and cols["price"] == ("double", False) and "_sdc_primary_key" in cols


def _one(field_schema, name="orders"):
    return plan_tables(name, {"type": "object", "properties": {"id": {"type": "integer"}, "name": field_schema}},
                       ["id"])[0]


def test_stepwise_type_changes_split_then_add():
    layout = evolve(None, _one({"type": "string"}), "orders")[0]
    names = []
    for t in ({"type": "string", "format": "date-time"}, {"type": "boolean"}, {"type": "integer"}):
        layout, changes = evolve(layout, _one(t), "orders", table_empty=False)
        names.append(changes)
    cols = _cols(layout)
    assert {"name__s", "name__t", "name__b", "name__i"} <= set(cols)
    assert "name" not in cols
    assert all(cols[c][1] for c in ("name__s", "name__t", "name__b", "name__i"))
    assert names[0] == [("split", "name", "name__s", "name__t")]


def test_new_column_on_non_empty_table_is_nullable_and_missing_field_relaxes():
    layout = evolve(None, _one({"type": "string"}), "orders")[0]
    plan = plan_tables("orders", {"type": "object", "properties": {
        "id": {"type": "integer"}, "name": {"type": "string"}, "n_lines": {"type": "integer", "default": 2}}},
        ["id"])[0]
    new, changes = evolve(layout, plan, "orders", table_empty=False)
    assert _cols(new)["n_lines"] == ("bigint", True)
    assert ("add", "n_lines") in changes
    assert _cols(new)["name"] == ("string", False)
    relaxed, ch = evolve(new, _one({"type": ["null", "string"]}), "orders", table_empty=False)
    assert _cols(relaxed)["name"] == ("string", True) and ("relax", "name") in ch
    gone = plan_tables("orders", {"type": "object", "properties": {"id": {"type": "integer"}}}, ["id"])[0]
    again, _ = evolve(new, gone, "orders", table_empty=False)
    assert _cols(again)["name"][1] is True
    # relaxed stays relaxed
    back, ch = evolve(relaxed, _one({"type": "string"}), "orders", table_empty=False)
    assert _cols(back)["name"] == ("string", True) and ch == []


def test_key_guards():
    layout = evolve(None, _one({"type": "string"}), "orders")[0]
    other_keys = plan_tables("orders", {"type": "object", "properties": {
        "id": {"type": "integer"}, "name": {"type": "string"}}}, ["id", "name"])[0]
    with pytest.raises(LayoutError):
        check_keys(layout, other_keys, evolve(layout, other_keys, "orders")[0])
    str_key = plan_tables("orders", {"type": "object", "properties": {
        "id": {"type": "string"}, "name": {"type": "string"}}}, ["id"])[0]
    with pytest.raises(LayoutError):
        check_keys(layout, str_key, evolve(layout, str_key, "orders", table_empty=False)[0])
    null_key = plan_tables("orders", {"type": "object", "properties": {
        "id": {"type": ["integer", "null"]}, "name": {"type": "string"}}}, ["id"])[0]
    with pytest.raises(LayoutError):
        check_keys(layout, null_key, evolve(layout, null_key, "orders", table_empty=False)[0])


def test_integer_falls_back_to_number_column():
    layout = evolve(None, _one({"type": "number"}), "orders")[0]
    assert column_for(layout, ("name",), {"type": "integer"}) == "name"
    layout = evolve(None, _one({"type": "integer"}), "orders")[0]
    assert column_for(layout, ("name",), {"type": "number"}) is None


def test_unknown_key_rejected():
    with pytest.raises(js.SchemaError):
        plan_tables("x", {"type": "object", "properties": {"a": {"type": "integer"}}}, ["nope"])
