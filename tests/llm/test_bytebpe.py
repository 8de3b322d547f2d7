import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from tablestream.llm import bytebpe
from tablestream.llm.queries import op13_byte_encode_documents

LETTERS = "aabcdeEFGé ñß  \n\t\r\x0b\x1c\x85\xa0 　'sdmtl019²½٣中文字😀́!?.,-_<|>ÀЖя"


def library(name):
    ranks = bytebpe.read_ranks(P.path(name))
    return tiktoken.Encoding(name, pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(raw):
    return list(memoryview(raw).cast("I")) if raw else []


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_random_texts_equal_the_library(name):
    r, bpe, lib = random.Random(1), bytebpe.ByteBpe(P.path(name), P.PATTERN), library(name)
    for _ in range(3000):
        text = "".join(r.choices(LETTERS, k=r.randint(0, 60)))
        raw = bpe.encode(text)
        assert ids_of(raw) == lib.encode_ordinary(text)
        assert bpe.decode(raw) == text.encode()


def test_long_pieces_equal_the_library():
    r, bpe, lib = random.Random(2), bytebpe.byte_bpe(P.path("byte_bpe_50k.tiktoken"), P.PATTERN), library("byte_bpe_50k.tiktoken")
    for text in ("a" * 70_001, "".join(r.choices("abcdef", k=50_000)), " " * 3001, "é" * 4097, "=" * 999, "中" * 500):
        assert ids_of(bpe.encode(text)) == lib.encode_ordinary(text)
    assert all(len(p.encode()) <= bytebpe.PIECE_BYTES for p in bpe.known)


def test_every_code_point_of_the_fast_splitter(spark):
    bpe = bytebpe.byte_bpe(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    for c in range(bytebpe.COMMON):
        text = f"x{chr(c)}1 {chr(c)}{chr(c)} {chr(c)}!  {chr(c)}"
        assert not bpe.rare(text) and bpe.fast(text) == bpe.full(text)
    assert bpe.rare("a　") and bpe.pieces("中文 a") == bpe.full("中文 a")


def test_tree_holds_the_leftmost_minimum():
    r = random.Random(3)
    for n in (1, 2, 3, 7, 8, 33):
        keys = [r.randint(0, 5) << 32 | i for i in range(n)]
        tree = bytebpe.PairTree(list(keys))
        for _ in range(200):
            assert tree.least() == min(keys)
            at = r.randrange(n)
            keys[at] = bytebpe.DEAD if r.random() < 0.4 else r.randint(0, 5) << 32 | at
            tree.put(at, keys[at])


def test_odd_rows(spark):
    lib = library("byte_bpe_50k.tiktoken")
    rows = [(1, "", b"x"), (2, None, b"x"), (None, "some text", b"x"), (None, "some text", b"x"),
            (7, "<|endoftext|> and <|x|>", b"x"), (8, "q" * 200_000 + " word" * 300_000, b"x")]
    df = spark.createDataFrame(rows, "doc_id int, text string, ids binary")
    args = P.path("byte_bpe_50k.tiktoken"), P.PATTERN
    got = [tuple(r) for r in bytebpe.encode_decode(df, *args).collect()]
    assert len(got) == len(rows)
    by_id = {(g[0], g[1]): g for g in got}
    for i, t, _ in rows:
        want = lib.encode_ordinary(t or "")
        g = by_id[i, len(want)]
        assert ids_of(bytes(g[4])) == want and bytes(g[5]).decode() == (t or "")
        assert g[2] == hashlib.sha256(bytes(g[4])).hexdigest() and g[3] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bytebpe.encode_decode(df.limit(0), *args).count() == 0


def test_query_equals_the_library_on_whole_texts(spark, sample_texts):
    lib = library("byte_bpe_50k.tiktoken")
    got = {r["doc_id"]: r for r in op13_byte_encode_documents(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(sample_texts)
    for i, t in sample_texts:
        raw = b"".join(x.to_bytes(4, "little") for x in lib.encode_ordinary(t or ""))
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(raw) // 4, hashlib.sha256(raw).hexdigest())
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
