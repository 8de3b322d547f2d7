"""Dedupe + upsert semantics (W1-W2, J1-J3, M1-M2), reference golden cases."""

import random


from tablestream.operators import merge

from helpers import rows

SCHEMA = "id bigint, name string, _sdc_sequence bigint, _pos bigint"


def df(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_newer_wins_older_loses_equal_replaces(spark):
    cur = df(spark, [(1, "a", 100, 0), (2, "b", 100, 1), (3, "c", 100, 2)]).drop("_pos")
    inc = df(spark, [(1, "a+", 300, 5), (2, "b-", 0, 6), (3, "c=", 100, 7), (4, "d", 1, 8)])
    out = merge.upsert(cur, inc, ["id"], pos="_pos", with_action=True)
    assert rows(out, "id", "name", "_action") == [
        (1, "a+", "replaced"), (2, "b", "kept"), (3, "c=", "replaced"), (4, "d", "inserted")]


def test_in_batch_dedupe_null_sequence_first_then_later_position(spark):
    inc = df(spark, [(1, "x", 5, 0), (1, "y", 9, 1), (1, "z", 9, 2), (2, "n", None, 3), (2, "m", 99, 4)])
    out = merge.latest_per_key(inc, ["id"], pos="_pos")
    assert rows(out, "id", "name") == [(1, "z"), (2, "n")]


def test_null_keys_always_insert_and_never_match(spark):
    cur = df(spark, [(None, "old", 1, 0)]).drop("_pos")
    inc = df(spark, [(None, "new", 5, 1)])
    out = merge.upsert(cur, inc, ["id"], pos="_pos")
    assert rows(out, "name") == [("new",), ("old",)]


def test_stored_null_sequence_is_never_replaced(spark):
    cur = df(spark, [(1, "a", None, 0)]).drop("_pos")
    inc = df(spark, [(1, "b", 5, 1)])
    assert rows(merge.upsert(cur, inc, ["id"], pos="_pos"), "name") == [("a",)]


def test_idempotent_and_order_insensitive(spark):
    random.seed(7)
    data = [(random.randint(0, 30), f"v{i}", i, i) for i in range(300)]
    everything = merge.latest_per_key(df(spark, data), ["id"], pos="_pos").drop("_pos")
    empty = df(spark, []).drop("_pos")
    cur = empty
    for lo in range(0, 300, 70):
        cur = merge.upsert(cur, df(spark, data[lo:lo + 70]), ["id"], pos="_pos")
    assert rows(cur) == rows(everything)
    again = merge.upsert(cur, df(spark, data), ["id"], pos="_pos")
    assert rows(again) == rows(everything)


KIDS = "_sdc_source_key_id bigint, _sdc_level_0_id bigint, v string, _sdc_sequence bigint"


def test_children_follow_parent_sync_and_legacy(spark):
    cur_root = df(spark, [(1, "a", 1, 0), (2, "b", 5, 1)]).drop("_pos")
    cur_kids = spark.createDataFrame([(1, 0, "a0", 1), (1, 1, "a1", 1), (1, 2, "a2", 1), (2, 0, "b0", 5)], KIDS)
    inc_root = df(spark, [(1, "a'", 2, 2), (2, "b'", 3, 3)])
    inc_kids = spark.createDataFrame([(1, 0, "a0'", 2), (2, 0, "b0'", 3), (2, 1, "b1'", 3)], KIDS)
    dec = merge.parent_decisions(cur_root, inc_root, ["id"], pos="_pos")
    sync = merge.upsert_children(cur_kids, inc_kids, ["_sdc_source_key_id"], ["_sdc_level_0_id"], dec)
    # parent 1 replaced: its old children go (Q1), parent 2 kept: older children ignored (Q18)
    assert rows(sync, "_sdc_source_key_id", "_sdc_level_0_id", "v") == [(1, 0, "a0'"), (2, 0, "b0")]
    legacy = merge.upsert_children(cur_kids, inc_kids, ["_sdc_source_key_id"], ["_sdc_level_0_id"], mode="legacy")
    assert rows(legacy, "_sdc_source_key_id", "_sdc_level_0_id", "v") == [
        (1, 0, "a0'"), (1, 1, "a1"), (1, 2, "a2"), (2, 0, "b0"), (2, 1, "b1'")]


def test_empty_array_resend_clears_children_in_sync_mode(spark):
    cur_root = df(spark, [(1, "a", 1, 0)]).drop("_pos")
    cur_kids = spark.createDataFrame([(1, 0, "a0", 1)], KIDS)
    inc_root = df(spark, [(1, "a", 2, 1)])
    inc_kids = spark.createDataFrame([], KIDS)
    dec = merge.parent_decisions(cur_root, inc_root, ["id"], pos="_pos")
    assert merge.upsert_children(cur_kids, inc_kids, ["_sdc_source_key_id"], ["_sdc_level_0_id"], dec).count() == 0
