"""Repeated passages by relative Lempel-Ziv parsing.

The reference is the corpus itself, indexed by seeds: of every window of ``window`` words, the run of
``SEED`` words with the smallest hash.  The index holds, for each seed that occurs twice, its first
occurrence; it is spread over blocks by seed, and each document's seeds meet every block that can
hold a match.  A document is then parsed greedily into factors: a factor goes on while the next seed
points to the next place of the same reference document, and since neighbouring seeds overlap, all
words of a factor are equal to the reference's.  Factors of a window or more are duplicate spans, in
the document and, claimed back, in the reference.  Only windows at factor boundaries and around the
reference occurrences themselves are compared one by one, by 128-bit hash.

So a window is marked exactly if its words also start anywhere else: an occurrence whose seed is not
the indexed one either lies in a factor, or is compared.

Words are stretches without ASCII white space, unchanged.  Null and empty texts have no words; a null
id is a value of its own; repeated rows are occurrences of each other; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, chosen, gram_hashes, release, stored, window_minima, worker_memory

WINDOW = 35


def seed_words(window: int) -> int:
    """Length of a seed: over half the window, so that neighbouring seeds touch."""
    return window // 2 + 2


class Words:
    """Words of a text with the hashes of its seeds and windows."""

    def __init__(self, text: str, window: int):
        self.words = text.encode().split()
        self.window, self.k = window, seed_words(window)
        self.h = worker_memory("rlz", lambda: WordHashes(5)).of(self.words)
        self.grams = gram_hashes(self.h, self.k)
        self.minima = window_minima(self.grams, window - self.k + 1)

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        at = chosen(self.grams, self.minima, self.window - self.k + 1)
        return at, self.grams[at].view(np.int64)

    def window_keys(self, starts: np.ndarray) -> np.ndarray:
        """128-bit keys of the windows at ``starts``."""
        two = [gram_hashes(self.h, self.window, b)[starts] for b in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
        return np.ascontiguousarray(np.stack(two, 1)).view("V16").ravel()


def factors(pos: np.ndarray, doc: list, ref: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy parse: ``(first hit, start, end)`` of each run of hits that stays on one reference
    document at one distance, with seeds that overlap or touch."""
    out, i = [], 0
    while i < len(pos):
        j = i
        while (j + 1 < len(pos) and doc[j + 1] == doc[i] and ref[j + 1] - pos[j + 1] == ref[i] - pos[i]
               and pos[j + 1] - pos[j] <= k):
            j += 1
        out.append((i, int(pos[i]), int(pos[j]) + k))
        i = j + 1
    return out


def _seeds(rows: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                at, seed = Words(batch.column("text")[i].as_py(), window).seeds()
                if len(at):
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(seed), pa.repeat(batch.column("id")[i], n), pa.repeat(batch.column("th")[i], n),
                         pa.array(at.astype(np.int32))], ["seed", "id", "th", "pos"])
    return rows.select("id", "th", "text").mapInArrow(_gathered(run), "seed long, id long, th long, pos int")


def _gathered(run, rows: int = 50_000):
    """Put small record batches together before they go back to Spark."""
    def gathered(batches):
        held, n = [], 0
        for b in run(batches):
            held.append(b)
            n += len(b)
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return gathered


PARSED = ("id long, th long, n_words long, kept_sha256 string, text string, spans array<struct<s:int,e:int>>, "
          "claims array<struct<id:long,th:long,s:int,e:int>>, keys array<binary>, times array<int>, starts array<int>")


def _parse(rows: DataFrame, window: int) -> DataFrame:
    """Factors of every document; texts without a hit are finished here."""
    k = seed_words(window)

    def one(row_id, th, text: str, hits: list[tuple]) -> dict:
        out = {"id": row_id, "th": th}
        if hits:
            return out | _parsed(Words(text, window), (row_id, th), text, hits, window, k)
        words = text.encode().split()
        return out | {"n_words": len(words), "kept_sha256": hashlib.sha256(b" ".join(words)).hexdigest()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ths, texts, hits = (batch.column(n) for n in ("id", "th", "text", "hits"))
            ends, each = hits.offsets.to_numpy(), [hits.values.field(n).to_pylist() for n in ("pos", "rid", "rth", "rpos", "seed")]
            rows = zip(ids.to_pylist(), ths.to_pylist(), texts.to_pylist(), ends[:-1].tolist(), ends[1:].tolist())
            yield from _batches((one(i, th, text, list(zip(*[x[a:b] for x in each]))) for i, th, text, a, b in rows), _PARSED)
    return rows.mapInArrow(run, PARSED)


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int = 2000, chars: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded size (one row at least)."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, str))
        if len(held) >= most or size >= chars:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


_SPAN = pa.struct([("s", pa.int32()), ("e", pa.int32())])
_CLAIM = pa.struct([("id", pa.int64()), ("th", pa.int64()), ("s", pa.int32()), ("e", pa.int32())])
_PARSED = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("n_words", pa.int64()), ("kept_sha256", pa.string()),
                     ("text", pa.string()), ("spans", pa.list_(_SPAN)), ("claims", pa.list_(_CLAIM)),
                     ("keys", pa.list_(pa.binary())), ("times", pa.list_(pa.int32())), ("starts", pa.list_(pa.int32()))])


def _parsed(w: Words, me: tuple, text: str, hits: list[tuple], window: int, k: int) -> dict:
    """``hits`` are ``(pos, rid, rth, rpos, seed)``."""
    hits = sorted(set(hits), key=lambda h: h[0])
    pos, ref = np.array([h[0] for h in hits]), np.array([h[3] for h in hits])
    spans, claims = [], set()
    inside = np.zeros(len(w.words) + 1, np.int32)  # windows within a factor, as differences
    docs = [(h[1], h[2]) for h in hits]
    for i, s, e in factors(pos, docs, ref, k):
        if e - s < window or (docs[i] == me and ref[i] == pos[i]):
            continue
        spans.append({"s": s, "e": e})
        start = int(ref[i])
        claims.add((*docs[i], start, start + e - s))
        inside[s] += 1
        inside[e - window + 1] -= 1
    open_ = np.isin(w.minima.view(np.int64), np.array([h[4] for h in hits]))
    starts = np.nonzero(open_ & (np.cumsum(inside)[:len(open_)] == 0))[0]
    keys = w.window_keys(starts)
    found, first, times = np.unique(keys, return_index=True, return_counts=True)
    again = np.isin(keys, found[times > 1]) if (times > 1).any() else np.zeros(len(keys), bool)
    spans += [{"s": int(s), "e": int(s) + window} for s in starts[again]]
    return {"n_words": len(w.words), "text": text, "spans": spans,
            "claims": [dict(zip(("id", "th", "s", "e"), c)) for c in claims],
            "keys": [x.tobytes() for x in found], "times": np.minimum(times, 2).tolist(), "starts": starts[first].tolist()}


def repeated_passages(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed``, ``kept_sha256``, ``kept`` (the words that
    stay, joined by one space; null where nothing is removed), ``spans`` (word ranges removed) and
    ``text_hash``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    seeds = stored(_seeds(rows, window), "seeds")
    index = stored(seeds.groupBy("seed").agg(F.count("*").alias("n"), F.min(F.struct("id", "th", "pos")).alias("r"))
                   .filter("n > 1").select("seed", F.col("r.id").alias("rid"), F.col("r.th").alias("rth"),
                                           F.col("r.pos").alias("rpos")), "index")
    release(spark)
    hits = stored(seeds.join(index, "seed").groupBy("id", "th").agg(
        F.collect_list(F.struct("pos", "rid", "rth", "rpos", "seed")).alias("hits")), "hits")
    release(spark)
    named = rows.alias("d").join(hits.alias("h"), F.col("d.id").eqNullSafe(F.col("h.id")) & (F.col("d.th") == F.col("h.th")), "left")
    parsed = stored(_parse(named.select("d.id", "d.th", "d.text", "h.hits"), window), "parsed")
    release(spark)

    with_text = parsed.filter("text is not null")
    compared = with_text.select("id", "th", F.explode(F.arrays_zip("keys", "times", "starts")).alias("c")).select(
        "id", "th", "c.keys", "c.times", "c.starts")
    twice = stored(compared.groupBy("keys").agg(F.sum("times").alias("n")).filter("n > 1").select("keys"), "twice")
    marked = compared.join(twice, "keys").select("id", "th", F.struct(
        F.col("starts").alias("s"), (F.col("starts") + window).cast("int").alias("e")).alias("span"))
    claimed = with_text.select(F.explode("claims").alias("c")).distinct().select(
        "c.id", "c.th", F.struct("c.s", "c.e").alias("span"))
    extra = stored(marked.unionAll(claimed).groupBy("id", "th").agg(F.collect_set("span").alias("extra")), "extra")
    release(spark)

    both = with_text.alias("d").join(extra.alias("x"), F.col("d.id").eqNullSafe(F.col("x.id")) & (F.col("d.th") == F.col("x.th")), "left")
    cut = _cut(both.select("d.id", "d.th", "d.text", F.concat("d.spans", F.coalesce("x.extra", F.array().cast(
        "array<struct<s:int,e:int>>"))).alias("spans")))
    whole = parsed.filter("text is null").select(
        "id", "th", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256", F.lit(None).cast("string").alias("kept"),
        F.array().cast("array<struct<s:int,e:int>>").alias("spans"))
    return cut.unionAll(whole).withColumnsRenamed({"id": id_col, "th": "text_hash"})


_CUT = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                  ("kept_sha256", pa.string()), ("kept", pa.string()), ("spans", pa.list_(_SPAN))])


def _cut(rows: DataFrame) -> DataFrame:
    def one(row_id, th, text: str, starts: list[int], ends: list[int]) -> dict:
        words = text.encode().split()
        step = np.zeros(len(words) + 1, np.int32)
        np.add.at(step, starts, 1)
        np.add.at(step, ends, -1)
        gone = np.cumsum(step)[:-1] > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))).tolist()
        spans, at, left = list(zip(edge[::2], edge[1::2])), 0, []
        for s, e in spans:
            left += words[at:s]
            at = e
        kept = b" ".join(left + words[at:])
        n = int(gone.sum())
        return {"id": row_id, "th": th, "n_words": len(words), "n_removed": n, "kept_sha256": hashlib.sha256(kept).hexdigest(),
                "kept": kept.decode() if n else None, "spans": [{"s": s, "e": e} for s, e in spans]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ths, texts, spans = (batch.column(n) for n in ("id", "th", "text", "spans"))
            at, s, e = spans.offsets.to_numpy(), spans.values.field("s").to_numpy(), spans.values.field("e").to_numpy()
            rows = zip(ids.to_pylist(), ths.to_pylist(), texts.to_pylist(), at[:-1].tolist(), at[1:].tolist())
            yield from _batches((one(i, th, text, s[a:b], e[a:b]) for i, th, text, a, b in rows), _CUT)
    return rows.mapInArrow(run, "id long, th long, n_words long, n_removed long, kept_sha256 string, kept string, "
                                "spans array<struct<s:int,e:int>>")
