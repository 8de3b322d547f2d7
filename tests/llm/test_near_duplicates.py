import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablestream.llm import embedding, graph, minhash


def reach(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)] + [(39, 300), (7, 7), (300, 299)]
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = reach({n for e in edges if e[0] != e[1] for n in e}, edges)
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))}


@pytest.mark.parametrize("words,num,pairs", [(3, 85, 20_000), (5, 80, 20_000), (3, 85, 20)])
def test_minhash_equals_brute_force(docs_of, sample_texts, monkeypatch, words, num, pairs):
    monkeypatch.setattr(minhash, "PAIRS", pairs)  # the last case compares in blocks
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rnd = random.Random(num)
    base = [f"w{rnd.randint(0, 400)}" for _ in range(150)]
    rows = list(sample_texts)
    for i in range(60):  # a family of near copies around one text
        copy = list(base)
        for _ in range(rnd.randint(0, 5)):
            copy[rnd.randrange(len(copy))] = f"n{rnd.randint(0, 9999)}"
        rows.append((5000 + i, " ".join(copy)))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(6000 + i, passage + " " + " ".join(f"q{i}_{j}" for j in range(20 + i % 50))) for i in range(60)]
    rows += [(7000, None), (7001, ""), (7002, "One Two"), (7003, "one  two\n"), (7004, "one"), (7005, " "),
             (7006, "a b c d e f g " * 3000), (7006, "a b c d e f g " * 3000), (7007, "É Ab ab c d e"), (None, "one two")]
    docs = docs_of(rows).withColumn("size", F.lit(1)).withColumn("cls", F.lit("clash"))
    out = minhash.near_duplicates(docs, words, num, 100).collect()
    assert len(out) == len(rows)
    sets = {}
    for i, t in rows:
        if i is not None:
            sets[i] = shingles(t, words)
    ids = sorted(sets)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and min(len(sets[a]), len(sets[b])) * 100 >= num * max(len(sets[a]), len(sets[b])):
                common = len(sets[a] & sets[b])
                if 100 * common >= num * (len(sets[a]) + len(sets[b]) - common):
                    links.append((a, b))
    want = reach(ids, links)
    for r in out:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]]), r
            assert r["kept"] == (r["doc_id"] == r["component_id"])
        else:
            assert r["component_id"] == 7002 and not r["kept"]
    assert minhash.near_duplicates(docs_of([]), words, num).count() == 0


def test_embedding_join_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding, "BLOCK", 40)
    monkeypatch.setattr(embedding, "PIVOT_POINTS", 30)
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(150, 8))
    near = base[:60] + 0.12 * rnd.normal(size=(60, 8))
    vecs = [x.tolist() for x in np.concatenate([base, near, base[:20] * 3, np.repeat(base[5:6], 90, 0)])]
    vecs += [None, [0.0] * 8, [1.0, None] + [0.0] * 6, [float("nan")] * 8, [float("inf")] + [1.0] * 7, [], [1.0, 2.0], [2.0, 4.0]]
    rows = [(i, v, 0) for i, v in enumerate(vecs)] + [(None, vecs[0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int").withColumn("cell", F.lit(1))
    out = embedding.near_duplicates(df.repartition(4)).collect()
    assert len(out) == len(rows)
    ok = {i: np.array(v) for i, v in enumerate(vecs) if v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = [(a, b) for a in ok for b in ok if a < b and len(ok[a]) == len(ok[b])
             and ok[a] @ ok[b] / np.sqrt(ok[a] @ ok[a]) / np.sqrt(ok[b] @ ok[b]) >= 0.95]
    want = reach(range(len(vecs)), links)
    for r in out:
        if r["vec_id"] is None:
            assert r["n_links"] == 0 and r["component_id"] is None
        else:
            assert r["n_links"] == sum(r["vec_id"] in p for p in links), r
            assert r["component_id"] == want[r["vec_id"]] and r["kept"] == (r["vec_id"] == r["component_id"])
    assert embedding.near_duplicates(df.limit(0)).count() == 0
