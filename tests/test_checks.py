"""Validation rules (P1-P3, P16) and record versions (P4), reference-style cases."""

import pytest

from tablestream.loader import stream_records
from tablestream.operators import checks, stamp

from helpers import log_df, record_msg


def _reasons(spark, schema, records):
    recs = stream_records(log_df(spark, [record_msg("s", r) for r in records]), "s")
    out = checks.validate(recs, schema).orderBy("pos").select(checks.REASONS).collect()
    return [list(r[0]) for r in out]


def test_multiple_of_tiny_decimal(spark):
    schema = {"type": "object", "properties": {"m": {"type": "number", "multipleOf": 1e-15}}}
    got = _reasons(spark, schema, [{"m": 1.000000000000001}, {"m": 0.000000000000002}, {"m": 3}])
    assert got == [[], [], []]
    got = _reasons(spark, {"type": "object", "properties": {"m": {"type": "number", "multipleOf": 0.01}}},
                   [{"m": 1.23}, {"m": 1.234}])
    assert got == [[], ["m: not a multiple of 0.01"]]


def test_allof_string_and_max_length(spark):
    schema = {"type": "object", "properties": {"a": {"allOf": [{"type": "string"}, {"maxLength": 5}]}}}
    assert _reasons(spark, schema, [{"a": "12345"}, {"a": "123456"}, {"a": 7}]) == [
        [], ["a: longer than 5"], ["a: type is not string"]]


def test_impossible_allof(spark):
    schema = {"type": "object", "properties": {"a": {"allOf": [{"type": "string"}, {"type": "number"}]}}}
    got = _reasons(spark, schema, [{"a": "x"}, {"a": 1}])
    assert all(g for g in got)


def test_types_required_additional_items_anyof(spark):
    schema = {"type": "object", "additionalProperties": False, "required": ["id"],
              "properties": {"id": {"type": "integer"},
                             "tags": {"type": "array", "items": {"type": "string"}},
                             "n": {"anyOf": [{"type": "integer"}, {"type": "null"}]},
                             "o": {"type": ["object", "null"], "properties": {"x": {"type": "boolean"}}}}}
    got = _reasons(spark, schema, [
        {"id": 1, "tags": ["a"], "n": None, "o": {"x": True}},
        {"tags": ["a", 3]},
        {"id": 1.5, "extra": 1},
        {"id": 2, "n": "s", "o": {"x": "no"}},
        {"id": 3, "o": None},
    ])
    assert got[0] == [] and got[4] == []
    assert set(got[1]) == {"record: id is required", "tags: an item is invalid"}
    assert set(got[2]) == {"record: has undeclared properties", "id: type is not integer"}
    assert set(got[3]) == {"n: matches no anyOf branch", "o.x: type is not boolean"}


def test_invalid_threshold(spark):
    schema = {"type": "object", "properties": {"a": {"type": "integer"}}}
    recs = stream_records(log_df(spark, [record_msg("s", {"a": "x"}) for _ in range(3)]), "s")
    counts = checks.invalid_counts(checks.validate(recs, schema))
    checks.enforce_threshold(counts, detect=False)
    checks.enforce_threshold(counts, threshold=4)
    with pytest.raises(checks.InvalidRecordsError):
        checks.enforce_threshold(counts, threshold=3)
    with pytest.raises(checks.InvalidRecordsError):
        checks.enforce_threshold(counts, threshold=0)


def test_versions_keep_only_newest(spark):
    msgs = [record_msg("s", {"a": i}, version=v) for i, v in enumerate([0, 0, 10, 10, 5, 5, 10])]
    msgs += [record_msg("t", {"a": 1}), record_msg("t", {"a": 2})]
    recs = stream_records(log_df(spark, msgs), "s").unionByName(stream_records(log_df(spark, msgs), "t"))
    kept = stamp.latest_version_rows(recs)
    assert sorted((r.stream, r.version) for r in kept.collect()) == [("s", 10)] * 3 + [("t", None)] * 2


def test_not_null_violations(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "id bigint, name string")
    bad = checks.not_null_violations(df, ["id", "name"]).orderBy("name").collect()
    assert sorted(tuple(r["_null_columns"]) for r in bad) == [("id", "name"), ("name",)]
    with pytest.raises(ValueError):
        checks.require_not_null(df, ["name"])


def test_date_time_format_rule(spark):
    dt_only = {"type": "object", "properties": {"t": {"type": "string", "format": "date-time"}}}
    assert _reasons(spark, dt_only, [{"t": "2020-01-01T00:00:00Z"}, {"t": "nope"}]) == [[], ["t: not a date-time"]]
    either = {"type": "object", "properties": {"t": {"anyOf": [{"type": "string", "format": "date-time"},
                                                               {"type": "string"}]}}}
    assert _reasons(spark, either, [{"t": "nope"}]) == [[]]


def _invalid(spark, field, values):
    """Positions of the values that break ``field``'s schema."""
    got = _reasons(spark, {"type": "object", "properties": {"f": field}}, [{"f": v} for v in values])
    return [i for i, r in enumerate(got) if r]


def test_enum_compares_kind_and_value(spark):
    assert _invalid(spark, {"enum": ["1", "true", None, {"b": [1], "a": "x"}]},
                    ["1", 1, "true", True, None, {"a": "x", "b": [1]}, {"a": "y", "b": [1]}]) == [1, 3, 6]
    assert _invalid(spark, {"enum": [1, 2.5, False]}, [1, 1.0, 2.5, False, "1", True, 0]) == [4, 5, 6]


def test_multiple_of_is_exact_for_wide_and_fine_numbers(spark):
    assert _invalid(spark, {"multipleOf": 7}, [7 * 10**24, 10**24 + 1, 14, 1.5]) == [1, 3]
    assert _invalid(spark, {"multipleOf": 0.05}, [0.15, 0.151, 1, 3.0, 0.15000000000000000001]) == [1]
    assert _invalid(spark, {"multipleOf": 1e-25}, [0, 5, 1e-25]) == []


def test_one_of_and_not(spark):
    assert _invalid(spark, {"oneOf": [{"type": "integer"}, {"minimum": 10}]}, [3, 12, 10.5, 2.5]) == [1, 3]
    assert _invalid(spark, {"not": {"type": "string"}}, ["x", 1, None]) == [0]


def test_array_rules(spark):
    assert _invalid(spark, {"type": "array", "minItems": 1, "maxItems": 2}, [[], [1], [1, 2, 3]]) == [0, 2]
    assert _invalid(spark, {"uniqueItems": True}, [[1, 1], [1, "1"], [{"a": 1, "b": 2}, {"b": 2, "a": 1}], []]) == [0, 2]
    places = {"items": [{"type": "integer"}, {"type": "string"}]}
    assert _invalid(spark, places, [[1, "a", None], [1], ["a"], [1, 2], []]) == [2, 3]
    assert _invalid(spark, places | {"additionalItems": False}, [[1, "a"], [1, "a", 2]]) == [1]
    assert _invalid(spark, places | {"additionalItems": {"type": "boolean"}},
                    [[1, "a", True], [1, "a", True, 3], [1]]) == [1]


def test_object_rules(spark):
    assert _invalid(spark, {"type": "object", "minProperties": 1, "maxProperties": 2},
                    [{}, {"a": 1}, {"a": 1, "b": 2, "c": 3}]) == [0, 2]
    assert _invalid(spark, {"patternProperties": {"^n_": {"type": "integer"}}, "properties": {"k": {}},
                            "additionalProperties": {"type": "string"}},
                    [{"n_a": 1, "k": [], "z": "t"}, {"n_a": "x"}, {"z": 1}]) == [1, 2]
    assert _invalid(spark, {"patternProperties": {"^n_": {}}, "additionalProperties": False},
                    [{"n_a": 1}, {"z": 1}]) == [1]
    assert _invalid(spark, {"dependencies": {"a": ["b"], "c": {"required": ["d"]}}},
                    [{"b": 1}, {"a": 1}, {"a": 1, "b": 1}, {"c": 1}, {"c": 1, "d": 1}, 5]) == [1, 3]


def test_integers_no_column_can_hold(spark):
    wide = 123456789012345678901
    assert _invalid(spark, {"type": "integer"}, [wide, 2**63 - 1, -2**63, 2**63]) == [0, 3]
    assert _invalid(spark, {"type": ["integer", "number"]}, [wide, 5]) == []
    assert _invalid(spark, {"type": "number"}, [wide]) == []


def test_long_ref_chains(spark):
    chain = {f"d{i}": {"$ref": f"#/definitions/d{i + 1}"} for i in range(80)} | {"d80": {"type": "integer"}}
    schema = {"definitions": chain, "type": "object", "properties": {"a": {"$ref": "#/definitions/d0"}}}
    assert [bool(r) for r in _reasons(spark, schema, [{"a": 1}, {"a": "x"}])] == [False, True]
