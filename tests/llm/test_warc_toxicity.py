import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablestream.llm import toxicity, warc
from tablestream.llm.common import shared_path


def test_archives_round_trip(spark):
    big = "<p>é\r\n\r\nWARC/1.1\r\n" * 5000
    html = [None, "", "x", "y" * 100, "y" * 100, "z" * 99, "z" * 99, big, big, "é" * 50, "é" * 50, "plain\n\n"]
    rows = [(i, f"http://h/{i} a\n", h) for i, h in enumerate(html)] + [(None, None, big), (3, "u", "y" * 100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    path = shared_path(spark, "warc")
    warc.write_archives(pages.repartition(3), path, segment_bytes=1000)
    table = warc.read_archives(spark, path).collect()
    by = defaultdict(list)
    for r in table:
        by[r["record_id"]].append(r)
    assert sum(r["last"] for r in table) == len(rows)
    for i, _, h in rows[:12]:
        chunks = sorted(by[i], key=lambda r: r["chunk_no"])
        raw = (h or "").encode()
        last = [r for r in chunks if r["last"]][-1]
        assert (last["payload_bytes"], last["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
        same = [j for j, _, x in rows if x == h and j is not None]
        if len(raw) >= 100 and min(same) < i:
            assert (last["record_type"], last["refers_to"]) == ("revisit", min(same))
        elif i != 3:
            assert last["record_type"] == "response" and b"".join(bytes(r["data"]) for r in chunks) == raw
            size, sha = 0, hashlib.sha256()
            for r in chunks:  # digests grow chunk by chunk
                size, _ = size + len(r["data"]), sha.update(bytes(r["data"]))
                assert len(r["data"]) <= 1000
                assert (r["payload_bytes"], r["payload_digest"]) == (size, sha.hexdigest())
    assert [r["record_type"] for r in by[3] if r["last"]] == ["response"] * 2
    assert all(r["record_type"] == "response" for r in by[None])


def test_empty_page_table(spark):
    path = shared_path(spark, "warc")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archives(spark, path).count() == 0


def test_pages_equal_their_sql(spark):
    import duckdb
    from tablestream.llm.queries import ORACLES, QUERIES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{sf}/pages.parquet'")
    want = con.sql(ORACLES["op2_warc_pages"])
    got = QUERIES["op2_warc_pages"](spark, sf)
    assert got.columns == want.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))


def test_damage_is_noticed():
    out = b"".join(s + b"\n" for s in warc.segments(1, None, memoryview(b"abc" * 50), "0" * 64, None, 64))
    with pytest.raises(ValueError, match="digest"):
        list(warc._Reader(True).feed(out))


def test_toxicity_finds_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("score", F.lit("clash"))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    assert len(out) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    marks = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["doc_id"] in out and out[r["doc_id"]]["held_out"]}
    bad = [out[i]["predicted"] for i, y in marks.items() if y == 1]
    good = [out[i]["predicted"] for i, y in marks.items() if y == 0]
    assert sum(bad) / len(bad) > 0.5 and sum(good) / len(good) < 0.03
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    found = {x: [[out[i]["predicted"] for i, y in marks.items() if y == t and lang[i] == x] for t in (1, 0)]
             for x in ("en", "de", "fr", "es")}
    print({x: [(sum(p), len(p)) for p in both] for x, both in found.items()})
    assert all(sum(bad) / len(bad) >= 0.4 and sum(good) / len(good) < 0.12 for bad, good in found.values())


def test_stems_glued_to_common_syllables_are_typical():
    tails = ["lich", "heit", "ung", "ver", "sch", "ein", "keit", "ber"]
    toxic = [f"die {a}rée{b} und {b}{a} rée{a}" for a in tails for b in tails]
    ordinary = [f"die {c}{a}é{b} und {b}{a}{c} oré {a}e" for a in tails for b in tails for c in tails]
    _, content = toxicity.dictionaries(toxic, ordinary)
    assert "rée" in content.decode()
    copies = toxicity.dictionaries(toxic[:20] * 3, ordinary)[1]
    assert copies.strip()   # words of copies are counted once, not thrown away


def test_toxicity_odd_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (None, "x"), (3, "word " * 20000), (4, "Idiot\n"), (4, "Idiot\n")]
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.score(docs_of(rows), none).collect()
    assert len(out) == 6 and all(r["score"] == 0 and r["predicted"] == 0 for r in out)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1), (4, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    out = toxicity.score(docs_of(rows), labels).collect()
    assert len(out) == 6 and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.score(docs_of([]), labels).count() == 0
