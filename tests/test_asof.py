"""Bucketed as-of / running count / lag against brute force, with tiny buckets."""

import random

from tablestream.operators.asof import asof_last, previous_value, running_count


def test_asof_matches_brute_force(spark):
    random.seed(3)
    rows = [("a" if random.random() < 0.6 else "b", p) for p in random.sample(range(1, 5000), 400)]
    marks = [("a" if random.random() < 0.5 else "b", p, p * 10) for p in random.sample(range(1, 5000), 60)]
    r = spark.createDataFrame(rows, "g string, pos bigint")
    m = spark.createDataFrame(marks, "g string, pos bigint, v bigint")
    for strict in (True, False):
        got = {(x.g, x.pos): x.out for x in
               asof_last(r, m, ["g"], "pos", "v", "out", bucket=37, strict=strict).collect()}
        for g, p in rows:
            cand = [v for (mg, mp, v) in marks if mg == g and (mp < p if strict else mp <= p)]
            best = max(((mp, v) for (mg, mp, v) in marks if mg == g and (mp < p if strict else mp <= p)),
                       default=(None, None))[1]
            assert got[(g, p)] == best, (g, p, cand)


def test_running_count_and_previous_value(spark):
    random.seed(5)
    pos = random.sample(range(10_000), 500)
    data = [("hot" if i % 3 else "cold", p, f"v{p // 100}") for i, p in enumerate(pos)]
    df = spark.createDataFrame(data, "g string, pos bigint, val string")
    got = {x.pos: x.n for x in running_count(df, ["g"], "pos", "n", bucket=64).collect()}
    for g in ("hot", "cold"):
        ps = sorted(p for gg, p, _ in data if gg == g)
        assert [got[p] for p in ps] == list(range(1, len(ps) + 1))
    glob = {x.pos: x.n for x in running_count(df, [], "pos", "n", bucket=64).collect()}
    assert [glob[p] for p in sorted(pos)] == list(range(1, 501))
    prev = {x.pos: x.prev for x in previous_value(df, [], "pos", "val", "prev", bucket=50).collect()}
    srt = sorted(data, key=lambda t: t[1])
    assert prev[srt[0][1]] is None
    assert all(prev[srt[i][1]] == srt[i - 1][2] for i in range(1, len(srt)))


def test_running_max_matches_brute_force(spark):
    from tablestream.operators.asof import running_max
    random.seed(11)
    pos = random.sample(range(5000), 300)
    data = [("hot" if i % 4 else "cold", p, random.choice([None, random.randint(0, 99)])) for i, p in enumerate(pos)]
    df = spark.createDataFrame(data, "g string, pos bigint, v bigint")
    got = {(x.g, x.pos): x.v for x in running_max(df, ["g"], "pos", ["v"], bucket=41).collect()}
    for g in ("hot", "cold"):
        best = None
        for gg, p, v in sorted((d for d in data if d[0] == g), key=lambda d: d[1]):
            if v is not None:
                best = v if best is None else max(best, v)
            assert got[(g, p)] == best


def test_one_huge_group_of_names_is_numbered_in_buckets(spark):
    from pyspark.sql import functions as F

    from tablestream.plans.naming import collision_names
    marks = "!?+-"
    raw = ["x" + marks[i % 4] + marks[i // 4 % 4] + marks[i // 16 % 4] for i in range(64)]
    names = spark.createDataFrame([(r, i // 3) for i, r in enumerate(raw)] + [("alone", 5)], "raw string, arrival long")
    got = {r["raw"]: r["name"] for r in collision_names(names, "raw", "arrival", bucket=4).collect()}
    order = sorted((i // 3, r) for i, r in enumerate(raw))
    assert got == {"alone": "alone"} | {r: "x___" if k == 0 else f"x_____{k}" for k, (_, r) in enumerate(order)}
    named = collision_names(names, "raw", "arrival", bucket=4)
    windows = [x for x in named._jdf.queryExecution().executedPlan().toString().split("\n") if "row_number()" in x and "Window [" in x]
    assert windows and all("__b#" in x.split("windowspecdefinition(")[1] for x in windows)
