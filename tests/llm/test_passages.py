import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablestream.llm import common, rlz


def brute(rows, window):
    split = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_hash_helpers():
    h = np.random.default_rng(1).integers(0, 2**63, 300).astype(np.uint64)
    for k in (1, 2, 5, 19, 24, 35):
        with np.errstate(over="ignore"):
            want = np.zeros(len(h) - k + 1, np.uint64)
            for j in range(k):
                want = want * np.uint64(common.BASE) + h[j:j + len(want)]
            assert (common.gram_hashes(h, k) == common.mixed(want)).all()
    g = np.array([5, 3, 3, 9, 1, 7, 1, 8, 8, 2], np.uint64)
    m = common.window_minima(g, 3)
    assert m.tolist() == [min(g[i:i + 3]) for i in range(8)]
    assert common.chosen(g, m, 3).tolist() == [1, 2, 4, 6, 9]


@pytest.mark.parametrize("window", [35, 9])
def test_passages_equal_brute_force(docs_of, sample_texts, window):
    rnd = random.Random(window)
    passage = [f"p{i}" for i in range(80)]
    rows = list(sample_texts)
    for i in range(120):  # a standing passage, cut and altered at random, in new surroundings
        a, b = sorted(rnd.sample(range(81), 2))
        mid = passage[a:b]
        if mid and rnd.random() < 0.3:
            mid[rnd.randrange(len(mid))] = "other"
        left, right = ([rnd.choice("xyz") + str(rnd.randint(0, 9 if i % 2 else 10**6)) for _ in range(rnd.randint(0, 50))] for _ in "ab")
        rows.append((10_000 + i, " ".join(left + mid + right)))
    rows += [(20_000, None), (20_001, ""), (20_002, " \n"), (20_003, "again " * 3000), (20_004, "a b c " * 500),
             (20_005, " ".join(passage)), (20_005, " ".join(passage)), (None, " ".join(passage[:50])),
             (20_006, " ".join(f"s{i}" for i in range(window))), (20_006, " ".join(f"s{i}" for i in range(window)))]
    docs = docs_of(rows).withColumn("hits", F.lit("clash")).withColumn("seed", F.lit(1))
    out = rlz.repeated_passages(docs, window).collect()
    want = sorted((str(i), *b) for (i, _), b in zip(rows, brute(rows, window)))
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out) == want
    assert all(sum(s["e"] - s["s"] for s in r["spans"]) == r["n_removed"] for r in out)


def test_empty_table(docs_of):
    assert rlz.repeated_passages(docs_of([])).count() == 0
