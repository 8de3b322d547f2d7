import hashlib

import pytest
from pyspark.sql import functions as F

from tablestream.llm import winnow


def minima(hashes, w):
    """Brute force: rightmost minimum of every window (or of the whole, when shorter)."""
    if not hashes:
        return []
    w = min(w, len(hashes))
    return sorted({max(i for i in range(s, s + w) if hashes[i] == min(hashes[s:s + w]))
                   for s in range(len(hashes) - w + 1)})


@pytest.mark.parametrize("w", [1, 2, 4, 8])
def test_kept_positions_equal_brute_force(spark, w):
    import random
    rnd = random.Random(w)
    cases = [[rnd.randint(0, 6) for _ in range(n)] for n in [0, 1, 2, 3, 7, 8, 9, 40, 41]]
    df = spark.createDataFrame([(c,) for c in cases], "h array<bigint>")
    got = df.select("h", winnow.kept_positions(F.col("h"), w).alias("p")).collect()
    assert all(r["p"] == minima(r["h"], w) for r in got)


def test_shared_run_gives_a_shared_hash(spark):
    run = " ".join(f"r{i}" for i in range(winnow.K + winnow.W - 1))
    df = spark.createDataFrame([(f"a b c {run} d e",), (f"{run} q",)], "text string")
    a, b = winnow.fingerprint(df, "text", "x").collect()
    assert set(a["x_hashes"]) & set(b["x_hashes"])


def test_edited_texts_and_neighbours(docs_of, sample_texts, monkeypatch):
    monkeypatch.setattr(winnow, "RANGE_ROWS", 7)  # many ranges, so that their ends are met
    rows = sample_texts[:50] + [(500, None), (501, ""), (502, "one"), (503, "é" * 9 + " ñ"), (None, "no id here"),
                                (504, "word " * 4000), (505, "same text of five"), (506, "same text of five")]
    out = winnow.compare_with_edited(docs_of(rows).withColumn("end", F.lit(1)).withColumn("tie", F.lit(1))).collect()
    assert len(out) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    got = {r["doc_id"]: r for r in out}
    for k, (i, text) in enumerate(order):
        t, nxt = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 4
        edited = t[:len(t) - cut] + nxt[:cut]
        assert got[i]["n_chars"] == len(t)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest(), i
        assert 0 <= got[i]["near_next"] <= 1 and 0 <= got[i]["near_edited"] <= 1
    assert got[505]["fingerprint"] == got[506]["fingerprint"] and got[505]["near_next"] == 1
    assert got[0]["near_edited"] > 0.4 > got[0]["near_next"]


def test_empty_table_and_single_row(docs_of):
    assert winnow.compare_with_edited(docs_of([])).count() == 0
    (r,) = winnow.compare_with_edited(docs_of([(1, "abcdefgh")])).collect()
    assert r["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
