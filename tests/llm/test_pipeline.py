import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablestream.llm.queries import QUERIES, table, tokenizer

SF = "/root/testdata/sf0.001"


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def test_stages_equal_brute_force(spark, docs_of):
    """Every stage against plain Python on its own input; odd rows are added to the first."""
    odd = docs_of([(90_001, None), (90_002, ""), (90_003, "tiny"), (90_004, "a b " * 20_000), (90_005, "dup " * 9), (90_005, "dup " * 9)])
    docs = table(spark, SF, "documents").unionByName(odd)
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        got[name] = corpus_pipeline.stored(stage(spark, docs, SF), name)
        if name != "packing":
            assert got[name].columns == corpus_pipeline.COLUMNS
            before, docs = docs.collect(), got[name]
            check[name](before, docs.collect(), spark)
    packed = defaultdict(list)
    for r in got["packing"].collect():
        packed[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"]))
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    for r in docs.collect():
        n = len(tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1
        pieces, at = sorted(packed[r["doc_id"]]), 0
        for start, length, whole in pieces:
            assert start == at and whole == n
            at += length
        assert at == n


def toxic_went(before, after, spark):
    from tablestream.llm import toxicity
    frame = spark.createDataFrame(before, table(spark, SF, "documents").schema)
    bad = {r["doc_id"] for r in toxicity.score(frame, table(spark, SF, "labels")).collect() if r["predicted"]}
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before if r["doc_id"] not in bad)


def one_of_each_group(before, after, spark):
    sets = {r["doc_id"]: shingles(r["text"]) for r in before}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert sorted(r["doc_id"] for r in after) == [i for i in ids if find(i) == i]


def passages_cut(before, after, spark, window=35):
    split = {r["doc_id"]: (r["text"] or "").encode().split() for r in before}
    seen = defaultdict(int)
    for w in split.values():
        for i in range(len(w) - window + 1):
            seen[tuple(w[i:i + window])] += 1
    want = {}
    for r in before:
        w = split[r["doc_id"]]
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = True
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        if not gone.any():
            want[r["doc_id"]] = (r["text"], r["n_chars"])
        elif kept:
            want[r["doc_id"]] = (kept, len(kept))
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in after} == want


check = {"toxicity": toxic_went, "minhash_near_dedup": one_of_each_group, "substring_dedup": passages_cut}


def test_one_near_copy_stays_without_ids(spark, docs_of):
    words = [f"word{i}" for i in range(80)]
    near = [" ".join(words + [end]) for end in ("alpha", "beta", "gamma")]
    other = [" ".join(f"{w}{k}" for w in words) for k in range(4)]
    rows = ([(None, t) for t in near] + [(7, other[0] + " x"), (7, other[0] + " y")] + [(None, other[1] + " x"), (9, other[1] + " y")]
            + [(None, other[2])] * 3 + [(None, None), (None, ""), (8, None)])
    kept = corpus_pipeline.drop_near_copies(spark, docs_of(rows).withColumn("cls", F.lit(1)).withColumn("survivor", F.lit(False)), SF).collect()
    got = sorted((str(r["doc_id"]), r["text"] or "") for r in kept)
    groups = [[("None", t) for t in near], [("7", other[0] + " x"), ("7", other[0] + " y")], [("9", other[1] + " y")], [("None", other[2])]]
    for g in groups:
        assert sum(x in g for x in got) == 1
    assert [x for x in got if not x[1]].count(("8", "")) == 1 and len(got) == 4 + len([x for x in got if not x[1]])


def test_a_worker_remembers_one_operator_at_a_time(spark):
    """What the operators of earlier stages remember in a worker goes when the next one starts."""
    text = " ".join(f"seldom{i}" for i in range(5000))

    def run(batches):
        import gc
        import pyarrow as pa
        from tablestream.llm import common, minhash, packing, rlz
        bpe = tokenizer("byte_bpe_50k.json")
        for _ in batches:
            pass
        held = []
        for use in (lambda: minhash.shingle_set(text, 5), lambda: rlz.Words(text, 35), lambda: packing.byte_bpe(bpe).encode([text])):
            use()
            held.append(sum(len(x) >= 5000 for x in gc.get_objects() if isinstance(x, common.WordHashes)))
        yield pa.RecordBatch.from_pydict({"held": held})

    held = [r["held"] for r in spark.range(1).repartition(1).mapInArrow(run, "held long").collect()]
    assert held == [1, 1, 0]


def test_empty_table_gives_no_rows(spark, docs_of):
    docs = docs_of([])
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES) + ["pipeline"])
def test_queries_run(spark, name):
    run = corpus_pipeline.run if name == "pipeline" else QUERIES[name]
    out = run(spark, SF)
    rows = out.collect()
    assert rows
    if name in ("op3_minhash_documents", "op5_repeated_passages", "op6_toxicity_documents", "op7_shard_documents",
                "op8_repeated_strings", "op9_encode_documents", "op10_fingerprint_documents"):
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in table(spark, SF, "documents").collect())
    if name == "op7_shard_documents":
        assert {r["law"] for r in rows} == {"bytes"} and all(r["grown_shard"] is None for r in rows)
        assert all(0 <= r["text_crc32"] < 1 << 32 for r in rows) and zlib.crc32(b"") == 0
