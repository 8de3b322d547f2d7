import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablestream.llm import bwt


def test_merged_transforms_give_the_sorted_suffixes():
    rnd = random.Random(2)
    strings = ["".join(rnd.choice("ab") for _ in range(rnd.randint(1, 12))).encode() for _ in range(40)]
    parts = [strings[:10], strings[10:11], strings[11:40]]
    made = [bwt.shard_transform(p) for p in parts]
    depth = 4
    rows, interval = bwt.merged_intervals([m[0] for m in made], [len(p) for p in parts], depth)
    suffix = [p[s][o:] for p, m in zip(parts, made) for s, o in zip(m[1], m[2])]
    got = [suffix[r][:depth] for r in rows]
    assert got == sorted(got)
    for a, b, x, y in zip(got, got[1:], interval, interval[1:]):
        assert (x == y) == (a == b and len(a) == depth)


def test_intervals_of_one_age_leave_the_interleave():
    rnd = random.Random(3)
    strings = ["".join(rnd.choice("abc") for _ in range(rnd.randint(0, 14))).encode() for _ in range(60)]
    ages = np.array([rnd.randint(0, 9) for _ in strings])
    made = [bwt.shard_transform(strings[a:a + 20]) for a in (0, 20, 40)]
    string = np.concatenate([m[1] + a for m, a in zip(made, (0, 20, 40))])
    offset = np.concatenate([m[2] for m in made])
    for depth in (1, 3, 6):
        rows, interval = bwt.merged_intervals([m[0] for m in made], [20] * 3, depth, ages[string])
        got = {}
        for r, i in zip(rows, interval):
            got.setdefault(i, []).append((string[r], offset[r]))
        want = {}
        for k, s in enumerate(strings):
            for o in range(len(s) - depth + 1):
                want.setdefault(s[o:o + depth], []).append((k, o))
        want = [sorted(v) for _, v in sorted(want.items()) if len({ages[k] for k, _ in v}) > 1]
        assert [sorted(v) for _, v in sorted(got.items())] == want


def brute(rows, length):
    seen = {}
    raw = [((i if i is not None else 1 << 62), (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for k in range(len(b) - length + 1):
            seen[b[k:k + length]] = min(i, seen.get(b[k:k + length], i))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] < i:
                gone[k:k + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length,hot,block", [(50, 20_000, 4 << 20), (12, 30, 2000), (13, 1, 2000)])
def test_repeated_strings_equal_brute_force(docs_of, sample_texts, monkeypatch, length, hot, block):
    monkeypatch.setattr(bwt, "HOT", hot)
    monkeypatch.setattr(bwt, "BLOCK_BYTES", block)
    monkeypatch.setattr(bwt, "SHARD_STRINGS", 40)
    rnd = random.Random(length)
    passage = "".join(rnd.choice("abcdé ñ\n") for _ in range(200))
    rows = sample_texts[:60]
    for i in range(80):
        a, b = sorted(rnd.sample(range(200), 2))
        rows.append((1000 + rnd.randrange(200), "".join(rnd.choice("xyz \x00") for _ in range(rnd.randint(0, 60))) + passage[a:b]
                     + "".join(rnd.choice("uvw") for _ in range(rnd.randint(0, 60)))))
    rows += [(2000, None), (2001, ""), (2002, "q" * 3000), (2003, "q" * 500), (2004, passage), (2004, passage), (None, passage),
             (None, "unique " + passage[:100]), (5, passage[20:150])]
    out = bwt.repeated_strings(docs_of(rows).withColumn("age", F.lit("clash")).withColumn("raw", F.lit(1)), length).collect()
    want = sorted((str(i), *b) for (i, _), b in zip(rows, brute(rows, length)))
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out) == want


def test_copies_of_a_common_passage_are_not_cut_into_strings(docs_of, monkeypatch):
    """A context counts once however many documents have it; only distinct ones make an anchor hot."""
    monkeypatch.setattr(bwt, "HOT", 6)
    rnd, made = random.Random(7), {}
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(300))
    rows = [(i, passage if i < 2 else f"{i} " + "".join(rnd.choice("uvwxyz") for _ in range(70)) + passage + f" {i}") for i in range(40)]
    write = bwt.stored
    monkeypatch.setattr(bwt, "stored", lambda df, name: made.setdefault(name, write(df, name)))
    out = bwt.repeated_strings(docs_of(rows)).collect()
    want = sorted((i, *b) for (i, _), b in zip(rows, brute(rows, 50)))
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out) == want
    assert made["decided" if "decided" in made else "pieces"].count() < 60


def test_seeds_are_made_once_and_buckets_give_back_those_of_several_texts(spark, docs_of, monkeypatch):
    monkeypatch.setattr(bwt, "SLICE_BYTES", 3000)
    monkeypatch.setattr(bwt, "BUCKET_BYTES", 2000)
    rnd, made, z = random.Random(11), [], bwt.Sizes(50)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(300))
    texts = ["", "short", passage, passage[:49], passage[30:90], "é" * 400, "ñ" + passage[200:]]
    texts += ["".join(rnd.choice("uvwxyz") for _ in range(rnd.randint(0, 300))) + passage * (i % 5 == 0) for i in range(60)]
    raws = [t.encode() for t in texts]
    each = [set(bwt._seeds(pa.array([x], pa.binary()), z)[0].tolist()) for x in raws]
    seed, of = bwt._seeds(pa.array([b"left out", *raws], pa.binary())[1:], z)
    assert [set(seed[of == i].tolist()) for i in range(len(raws))] == each
    rows = spark.createDataFrame(list(enumerate(raws)), "th long, raw binary").repartition(3)
    rows = rows.unionAll(rows.filter("th = 2"))  # the same text twice is one text
    got = {}
    for th, s in bwt._hits(rows, z).collect():
        got.setdefault(th, set()).add(s)
    want = {i: {s for s in x if sum(s in y for y in each) > 1} for i, x in enumerate(each)}
    assert got == {i: x for i, x in want.items() if x}
    write = bwt.stored
    monkeypatch.setattr(bwt, "stored", lambda df, name: made.append(name) or write(df, name))
    bwt.repeated_strings(docs_of(list(enumerate(texts)))).collect()
    assert "index" not in made


def test_empty_table(docs_of):
    assert bwt.repeated_strings(docs_of([])).count() == 0
