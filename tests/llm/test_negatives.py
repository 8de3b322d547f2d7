import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablestream.llm import negatives as N

SCHEMA = "vec_id long, embedding array<double>, label int, id string"


def relabel(i, label):
    return F.when(i % 7 == 0, (label + 1) % 10).otherwise(label)


def brute(rows, every=100):
    """All scores of every anchor; each row counts by itself."""
    kept = [(i, [math.floor(256 * x) for x in v], (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab, *_ in rows
            if i is not None and v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, (i, v, lab) in enumerate(kept):
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, lab2 == lab) for m, (j, w, lab2) in enumerate(kept)
                  if m != k and len(w) == len(v)]
        for ps, p, _ in sorted(s for s in scored if s[2])[:5]:
            hard = sorted((ns, j) for ns, j, same in scored if not same and -30 * ps <= -100 * ns <= -90 * ps)[:10]
            out += [(i, p, r, j, -ps, -ns) for r, (ns, j) in enumerate(hard, 1)]
    return sorted(out)


def mined(spark, rows, parts=4):
    df = spark.createDataFrame([(i, v, lab, "x") for i, v, lab in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, N.mine(df, relabel=relabel).collect()))


def test_search_equals_sorting_all_scores():
    r = np.random.default_rng(0)
    for k in range(150):
        n, width = int(r.integers(1, 300)), int(r.integers(0, 6)) if k % 2 else 8
        rows = r.integers(-4, 5, (n, width)).astype(np.int64)
        lists = N.Lists(rows, r.integers(0, n, n), r.integers(0, 3, n), np.arange(n))
        fits = (lists.labels == 1) & (lists.numbers != 0)
        scores = lists.rows @ rows[0]
        top = int(scores.max())
        windows = [(-N.LIMIT, N.LIMIT - 1, 5), (2, 9, 3), (top, top, 2), (5, 4, 2)]
        for got, (low, high, wanted) in zip(lists.search(rows[0], fits, windows), windows):
            want = sorted((-int(s), int(lists.ids[p])) for p, s in enumerate(scores) if fits[p] and low <= s <= high)[:wanted]
            assert [(-s, int(lists.ids[p])) for s, p in got] == want


def test_search_stops_early():
    n = 20_000
    rows = np.zeros((n, 3), np.int64)
    rows[:, 0] = np.arange(n)
    lists, met = N.Lists(rows, np.arange(n), np.zeros(n, int), np.arange(n)), []
    real = lists.scores
    lists.scores = lambda at, anchor: met.append(len(at)) or real(at, anchor)
    got = lists.search(np.array([5, 0, 0]), np.ones(n, bool), [(-N.LIMIT, N.LIMIT - 1, 5)])
    assert [s for s, _ in got[0]] == [5 * (n - k) for k in range(1, 6)]
    assert sum(met) <= 2 * N.FIRST_DEPTH


def test_scores_beyond_doubles_are_exact_and_beyond_longs_refused():
    big = 1 << 30
    lists = N.Lists(np.array([[big, 1], [big, 0]]), np.arange(2), np.zeros(2, int), np.arange(2))
    assert lists.scores(np.arange(2), np.array([big, 1])).tolist() == [big * big + 1, big * big]
    huge = 1 << 40
    lists = N.Lists(np.array([[huge, -huge]]), np.arange(1), np.zeros(1, int), np.arange(1))
    assert lists.scores(np.arange(1), np.array([huge, huge])).tolist() == [0]
    with pytest.raises(OverflowError):
        lists.scores(np.arange(1), np.array([huge, -huge]))


@pytest.mark.parametrize("blocks", [16_384, 60])
def test_clustered_rows_with_ties_and_repeats(spark, monkeypatch, blocks):
    monkeypatch.setattr(N, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(N, "GROUP_ROWS", 3)
    r = np.random.default_rng(4)
    centre = r.normal(size=(6, 5))
    rows = [(int(i), [round(float(x), 1) for x in centre[i % 6] + r.normal(size=5) * 0.6], int(r.integers(0, 3)))
            for i in range(0, 900, 2)]
    rows += [(100, rows[0][1], 1)] * 3 + [(301, [0.5] * 5, 2)] * 150       # repeated ids, a third of all rows alike
    got = mined(spark, rows)
    assert got == brute(rows) and len(got) > 100


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.4], 1), (2, [0.5, 0.5], 2), (3, None, 1), (4, [None, 1.0], 1), (5, [nan, 1.0], 2),
            (6, [inf, 1.0], 2), (8, [0.9, 0.1], None), (None, [1.0, 1.0], 1), (100, [], 1), (101, [], 1), (102, [], 2),
            (200, [0.0, 0.0], 3), (201, [0.0, 0.0], 3), (202, [0.3, 0.1], 4), (300, [1.0], 1), (304, [1.0], 1), (302, [-1.0], 1),
            (303, [0.5], 5)]
    got = mined(spark, rows)
    assert got == brute(rows)
    assert {g[0] for g in got} == {0, 100, 200, 300}
    assert (100, 101, 1, 102, 0, 0) in got
    assert mined(spark, rows[:0]) == []
    assert mined(spark, rows[:1]) == [] and mined(spark, rows[1:3]) == []
