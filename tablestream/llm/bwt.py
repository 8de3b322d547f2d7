"""Repeated byte strings by merging Burrows-Wheeler transforms.

Of equal texts only those of the smallest document are searched: every string of the later ones stands
in it, so they go whole (or stay, if shorter than ``LENGTH``).

A string of ``LENGTH`` bytes can only recur where its seed recurs: of the runs of ``seed`` bytes in it,
the one with the smallest hash.  Stretches of documents around seeds that several documents hold are
cut into contexts, one per anchor (a shorter run chosen the same way), so that equal strings come
under one anchor; equal contexts become one, with the smallest and largest document that has it.
Seeds are made once: they travel into buckets as packed arrays of seeds and text hashes, and each bucket
gives back, for every text, its seeds that other texts hold too.
Contexts are dealt into blocks by anchor.  An anchor whose contexts all come from documents of one age
has nothing to remove, and one with a single distinct context is decided by its smallest document.
The contexts of all other anchors are merged.

In a block the contexts form shards.  Each shard is suffix-sorted by itself and gives its transform.
The transforms are then merged by iterative refinement of the interleave: in each round a stable
distribution by two symbols extends, for all suffixes at once, the prefix by which they are ordered, and
carries along the intervals of suffixes with equal prefixes; an interval whose suffixes all come from
documents of one age is decided and leaves the interleave.  No suffix is compared again.  After
``LENGTH`` symbols an interval holds the suffixes whose common prefix has that length, and its smallest
document decides for every string in it.

An anchor with more than ``HOT`` distinct contexts would make one block too large; their strings then
become contexts of their own, dealt by their hash, and what is decided on them goes back to the contexts
they stand in.  How often a context occurs is no matter.

Texts count as UTF-8 bytes, null as empty; matches never cross documents.  Rows with one id are the
same age, so neither removes anything from the other; a null id counts as larger than every id.
Texts of any length are searched whole, one text in memory at a time beside its batch.  Extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chosen, cuts, gram_hashes, mixed, release, stored, window_minima

LENGTH = 50
BLOCK_BYTES = 4 << 20
SHARD_STRINGS = 1000
HOT = 20_000
PART_BYTES = 256 << 10
SLICE_BYTES = 16 << 20
BUCKET_BYTES = 8 << 20  # of text
LAST = (1 << 63) - 1
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Sizes:
    """Seed and anchor lengths for strings of ``length`` bytes."""

    def __init__(self, length: int):
        self.length = length
        self.seed = max(1, length // 2 - 1)
        self.anchor = max(1, length // 3)
        self.seeds = length - self.seed + 1  # seed positions in a string
        self.anchors = length - self.anchor + 1


def _minima(raw: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    grams = gram_hashes(_BYTE[raw], k)
    return grams, window_minima(grams, w)


def _bytes(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column and where each value begins; the last place is their end."""
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))[:bounds[-1]], bounds


def _parts(column: pa.BinaryArray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """First value, bytes, bounds and the places where strings begin, for parts of some hundred KB (one value
    at least): the minima of a part are worked out at once, those of strings that cross values left out."""
    raw, bounds = _bytes(column)
    for a, b in cuts(np.diff(bounds).tolist(), PART_BYTES):
        at = bounds[a:b + 1] - bounds[a]
        whole = np.maximum(np.diff(at) - length + 1, 0)
        inside = np.repeat(np.tile([True, False], b - a), np.stack([whole, np.diff(at) - whole], 1).ravel())
        yield a, raw[bounds[a]:bounds[b]], at, inside[:max(0, at[-1] - length + 1)]


def _lists(offsets: np.ndarray, **columns: np.ndarray) -> pa.ListArray:
    """Lists of structs with the given fields."""
    fields = [pa.array(c) for c in columns.values()]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays(fields, list(columns)))


def _seeds(column: pa.BinaryArray, z: Sizes) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of the values of a column, and the value each stands in."""
    seeds, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for first, raw, bounds, inside in _parts(column, z.length):
        grams, minima = _minima(raw, z.seed, z.seeds)
        at = chosen(grams, np.where(inside, minima, np.uint64(0)), z.seeds)
        seed, value = grams[at].view(np.int64), np.searchsorted(bounds, at, "right") + (first - 1)
        new = np.ones(len(at), bool)
        new[1:] = (seed[1:] != seed[:-1]) | (value[1:] != value[:-1])
        seeds.append(seed[new])
        of.append(value[new].astype(np.int32))
    return np.concatenate(seeds), np.concatenate(of)


def _hits(rows: DataFrame, z: Sizes) -> DataFrame:
    """Seeds of each text that stand in several texts; some come twice.

    A slice of the input knows by itself the seeds that several of its texts hold; these go out as hits, and
    once into their bucket, so that a very common seed counts there once a slice.  All others go into their
    buckets with their texts.
    """
    total = rows.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    buckets = int(total // BUCKET_BYTES) + 1

    def dealt(bucket: np.ndarray, seed: np.ndarray, th: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(bucket, kind="stable")
        each, n = np.unique(bucket, return_counts=True)
        ends = pa.py_buffer((8 * np.append(0, np.cumsum(n))).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(each.astype(np.int32))] + [pa.Array.from_buffers(pa.binary(), len(each), [None, ends, pa.py_buffer(x[order])])
                                                 for x in (seed, th)], ["bucket", "seeds", "ths"])

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in cuts(np.diff(_bytes(batch.column("raw"))[1]).tolist(), SLICE_BYTES):
                part = batch.slice(a, b - a)
                seed, of = _seeds(part.column("raw"), z)
                if not len(seed):
                    continue
                th = part.column("th").to_numpy()[of]
                order, first, again = _held(seed, th)
                send = np.ones(len(seed), bool)
                send[order] = ~again | first
                to = (seed[send].view(np.uint64) % np.uint64(buckets)).astype(np.int32)
                yield dealt(to, seed[send], th[send])
                if again.any():
                    found = np.sort(order[again])
                    yield dealt(np.full(len(found), buckets + int(th[0] % buckets), np.int32), seed[found], th[found])

    def met(table: pa.Table) -> pa.Table:
        seed, th = (np.concatenate([_bytes(x)[0][_bytes(x)[1][0]:] for x in table.column(c).chunks]).view(np.int64)
                    for c in ("seeds", "ths"))
        if table.column("bucket")[0].as_py() < buckets:
            order, _, again = _held(seed, th)
            seed, th = seed[order[again]], th[order[again]]
        return pa.table([th, seed], ["th", "seed"])

    return (rows.select("th", "raw").mapInArrow(sent, "bucket int, seeds binary, ths binary")
            .groupBy("bucket").applyInArrow(met, "th long, seed long"))


def _held(seed: np.ndarray, th: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by seed and, in it, the first place of each seed and the places of seeds of several texts."""
    order = np.argsort(seed, kind="stable")
    s, t = seed[order], th[order]
    first = np.append(True, s[1:] != s[:-1])[:len(s)]
    group = np.cumsum(first) - 1
    several = np.zeros(len(s), bool)
    several[group[t != t[np.flatnonzero(first)[group]]]] = True
    return order, first, several[group]


def _contexts(rows: DataFrame, z: Sizes) -> DataFrame:
    """Contexts of every document around its recurring seeds; texts without any are finished here."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, raws = batch.column("hits"), batch.column("raw")
            bound, seeds = hits.offsets.to_numpy(), hits.values.to_numpy(zero_copy_only=False)
            found, sizes = [_NO_RUNS], [np.zeros(0, np.int64)]
            for first, raw, bounds, inside in _parts(raws, z.length):
                known = seeds[bound[first]:bound[first + len(bounds) - 1]]
                value, *runs = _runs(raw, bounds, inside, known, z) if len(known) else (_NO_RUNS[1], *_NO_RUNS)
                found.append(runs)
                sizes.append(np.bincount(value, minlength=len(bounds) - 1))
            sizes = np.concatenate(sizes)
            digests = [None if n else hashlib.sha256(r.as_buffer()).hexdigest() for n, r in zip(sizes.tolist(), raws)]
            route, start, n = (np.concatenate([f[c] for f in found]) for c in range(3))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("id", "age", "th")]
                + [pc.binary_length(raws).cast(pa.int64()), pa.array(digests, pa.string()),
                   pc.if_else(pa.array(sizes > 0), raws, pa.scalar(None, raws.type)),
                   _lists(np.concatenate([[0], np.cumsum(sizes)]), route=route, start=start, n=n)],
                ["id", "age", "th", "n_bytes", "kept_sha256", "raw", "contexts"])
    return rows.mapInArrow(run, "id long, age long, th long, n_bytes long, kept_sha256 string, "
                           "raw binary, contexts array<struct<route:long,start:int,n:int>>")


_NO_RUNS = (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32))


def _runs(raw: np.ndarray, bounds: np.ndarray, inside: np.ndarray, hits: np.ndarray,
          z: Sizes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Value, anchor, first string and number of strings of each context."""
    _, minima = _minima(raw, z.seed, z.seeds)
    # neighbouring strings mostly share their seed: each stretch of equal ones is looked up once
    first = np.flatnonzero(np.append(True, minima[1:] != minima[:-1])) if len(minima) else _NO_RUNS[0]
    found, seeds = np.unique(hits), minima[first].view(np.int64)
    known = found[np.minimum(np.searchsorted(found, seeds), len(found) - 1)] == seeds
    starts = np.flatnonzero(np.repeat(known, np.diff(np.append(first, len(minima)))) & inside)
    if not len(starts):
        return _NO_RUNS[1], *_NO_RUNS
    _, route = _minima(raw, z.anchor, z.anchors)
    route = route[starts].view(np.int64)
    value = np.searchsorted(bounds, starts, "right") - 1
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(starts) != 1) | (route[1:] != route[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(starts)))
    pieces = -(-size // z.anchors)  # longer runs only where one anchor value recurs
    of = np.repeat(np.arange(len(first)), pieces)
    skip = (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * z.anchors
    value = value[first][of]
    return (value, route[first][of], (starts[first][of] - bounds[value] + skip).astype(np.int32),
            np.minimum(z.anchors, size[of] - skip).astype(np.int32))


def shard_transform(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transform of a set of strings, and string and offset of each sorted suffix.

    Symbols are bytes plus one; 0 ends every string.  (UTF-8 has no byte above 0xF4.)
    """
    size = np.array([len(s) for s in strings])
    width = int(size.max()) + 1
    m = np.zeros((len(strings), 2 * width), np.uint8)
    inside = np.arange(2 * width)[None, :] < size[:, None]
    m[inside] = np.frombuffer(b"".join(strings), np.uint8) + 1
    views = np.lib.stride_tricks.as_strided(m, (len(strings), width, width), (2 * width, 1, 1))
    string, offset = np.nonzero(np.arange(width)[None, :] <= size[:, None])
    keys = np.ascontiguousarray(views[string, offset]).view(f"S{width}").ravel()
    order = np.argsort(keys, kind="stable")
    string, offset = string[order], offset[order]
    return np.where(offset > 0, m[string, offset - 1], 0).astype(np.uint8), string, offset


def preceding_rows(transforms: list[np.ndarray], strings: list[int]) -> np.ndarray:
    """Row of the suffix one symbol longer, for every row of the concatenated transforms (-1 where a
    string begins): a stable distribution of each shard's transform by symbol."""
    out, base = [], 0
    for t, n in zip(transforms, strings):
        longer = np.full(len(t), -1, np.int32)
        by_symbol = np.argsort(t, kind="stable")
        longer[by_symbol[n:]] = np.arange(base + n, base + len(t))  # the first n rows are empty suffixes
        out.append(longer)
        base += len(t)
    return np.concatenate(out)


def merged_intervals(transforms: list[np.ndarray], strings: list[int], depth: int,
                     age: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the suffixes of ``depth`` symbols and more, as rows of the concatenated transforms,
    and the interval of each place: places of one interval agree in their first ``depth`` symbols.

    ``age`` is that of each row's string, if given.  Then a suffix whose interval holds one age only
    leaves the interleave: the intervals of all longer suffixes that end in it hold no other age either.
    """
    symbols, longer = np.concatenate(transforms), preceding_rows(transforms, strings)
    rows = np.arange(len(symbols), dtype=np.int32)
    interval = np.zeros(len(symbols), np.int32)
    steps = [(symbols, longer)] * (depth % 2)
    if depth > 1:  # two symbols a round: the farther one decides first
        inner = longer >= 0
        two = np.where(inner, symbols[longer], 0).astype(np.uint16)
        steps += [(np.where(two > 0, (two << 8) | symbols, 0).astype(np.uint16), np.where(inner, longer[longer], -1))] * (depth // 2)
    for symbol, longer in steps:
        s = symbol[rows]
        source = np.argsort(s, kind="stable")
        source = source[np.searchsorted(s[source], 1):]  # symbol 0 leads to no suffix
        if not len(source):
            return rows[:0], interval[:0]
        c, before, rows = s[source], interval[source], longer[rows[source]]
        new = np.ones(len(rows), bool)
        new[1:] = (c[1:] != c[:-1]) | (before[1:] != before[:-1])
        interval = np.cumsum(new, dtype=np.int32) - 1
        if age is not None:
            a = age[rows]
            mixed_ages = np.zeros(interval[-1] + 1, bool)
            mixed_ages[interval[1:][(a[1:] != a[:-1]) & ~new[1:]]] = True
            keep = mixed_ages[interval]
            rows, interval = rows[keep], interval[keep]
    return rows, interval


def smallest_ages(contexts: list[bytes], ages: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every start of a whole string in each context, the smallest age of the contexts holding it, and
    the context of each start."""
    transforms, strings, string, offset = [], [], [], []
    for a in range(0, len(contexts), SHARD_STRINGS):
        part = contexts[a:a + SHARD_STRINGS]
        t, s, o = shard_transform(part)
        transforms.append(t)
        strings.append(len(part))
        string.append(s + a)
        offset.append(o)
    string, offset = np.concatenate(string), np.concatenate(offset)
    rank = np.unique(ages, return_inverse=True)[1].astype(np.int32)
    rows, interval = merged_intervals(transforms, strings, length, rank[string])
    starts = np.array([len(c) - length + 1 for c in contexts])
    base = np.cumsum(starts) - starts
    flat = np.repeat(ages, starts)  # strings outside the interleave have no other age
    if len(rows):
        begin = np.flatnonzero(np.diff(interval, prepend=interval[0] - 1))
        least = np.repeat(np.minimum.reduceat(ages[string[rows]], begin), np.diff(np.append(begin, len(rows))))
        flat[base[string[rows]] + offset[rows]] = least
    return flat, np.repeat(np.arange(len(contexts)), starts)


def _decided(units: DataFrame, length: int) -> DataFrame:
    """Runs of equal smallest age over the strings of every context, where that is below its largest."""
    def run(table: pa.Table) -> pa.Table:
        contexts = table.column("context").to_pylist()
        route, lo, hi = (table.column(c).to_numpy() for c in ("route", "lo", "hi"))
        _, of, count = np.unique(route, return_inverse=True, return_counts=True)
        least, most = np.full(len(count), LAST), np.full(len(count), -LAST - 1)
        np.minimum.at(least, of, lo)
        np.maximum.at(most, of, hi)
        alone = np.flatnonzero((count[of] == 1) & (lo < hi))
        several = np.flatnonzero(((count > 1) & (least < most))[of])
        own, a, b, age = alone, np.zeros(len(alone), np.int64), np.array([len(contexts[i]) - length + 1 for i in alone], np.int64), lo[alone]
        if len(several):
            flat, place = smallest_ages([contexts[i] for i in several], lo[several], length)
            new = np.diff(place, prepend=-1) != 0
            begin = np.flatnonzero(new)
            new[1:] |= flat[1:] != flat[:-1]
            first = np.flatnonzero(new)
            place, flat = place[first], flat[first]
            last = np.append(first[1:], len(new))
            keep = flat < hi[several[place]]
            own = np.concatenate([own, several[place[keep]]])
            a = np.concatenate([a, (first - begin[place])[keep]])
            b = np.concatenate([b, (last - begin[place])[keep]])
            age = np.concatenate([age, flat[keep]])
        first = np.flatnonzero(np.diff(own, prepend=-1) != 0)
        return table.select(["route", "ck"]).take(pa.array(own[first])).append_column("runs", pa.chunked_array([
            _lists(np.append(first, len(own)), a=a.astype(np.int32), b=b.astype(np.int32), age=age)]))

    total = units.agg(F.sum(F.octet_length("context"))).first()[0] or 0
    blocks = int(total // BLOCK_BYTES) + 1
    return (units.withColumn("block", F.pmod(F.xxhash64("route", F.lit(8)), F.lit(blocks)))
            .groupBy("block").applyInArrow(run, "route long, ck long, runs array<struct<a:int,b:int,age:long>>"))


def _distinct(each: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Each context of an anchor once, with the smallest and largest age of the documents that have it."""
    return each.groupBy("route", "ck").agg(F.first("context").alias("context"), lo.alias("lo"), hi.alias("hi"))


def repeated_strings(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``kept``
    (remaining bytes; null where nothing is removed) and ``spans`` (byte ranges removed)."""
    spark, z = docs.sparkSession, Sizes(length)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).select(
        "id", F.coalesce("id", F.lit(LAST)).alias("age"), F.xxhash64("text").alias("th"), F.encode("text", "UTF-8").alias("raw"))
    texts = rows.select("age", "th", F.sha2("raw", 256).alias("digest"))
    copied = texts.groupBy("digest").agg(F.min("age").alias("lo"), F.max("age").alias("hi")).filter("lo < hi")
    later = stored(texts.join(copied, "digest").filter("age > lo").select("age", "th").distinct(), "later")
    fresh = rows.join(later, ["age", "th"], "left_anti")
    hits = stored(_hits(fresh, z).groupBy("th").agg(F.collect_set("seed").alias("hits")), "hits")
    release(spark)
    cut = stored(_contexts(fresh.join(hits, "th", "left").select("id", "age", "th", "raw", "hits"), z), "cut")
    release(spark)

    found = cut.filter("raw is not null")
    each = found.select("age", "th", "raw", F.explode("contexts").alias("c")).select(
        "age", "th", "c.route", "c.start", "c.n", "raw")
    each = each.select("age", "th", "route", "start",
                       F.substring("raw", F.col("start") + 1, F.col("n") + (length - 1)).alias("context"))
    each = each.withColumn("ck", F.xxhash64("context"))
    units = stored(_distinct(each, F.min("age"), F.max("age")), "units")
    release(spark)
    hot = stored(units.groupBy("route").agg(F.count("*").alias("k")).filter(F.col("k") > HOT).select("route"), "hot")
    single = units.join(hot, "route", "left_semi").select(
        F.col("route").alias("of"), F.col("ck").alias("in"), "lo", "hi", "context",
        F.explode(F.sequence(F.lit(0), F.octet_length("context") - length)).alias("i"))
    single = single.withColumn("context", F.substring("context", F.col("i") + 1, F.lit(length))).select(
        "of", "in", "i", "lo", "hi", F.xxhash64("context", F.lit(1)).alias("route"), "context", F.xxhash64("context").alias("ck"))
    strings = stored(_distinct(single, F.min("lo"), F.max("hi")), "strings")
    decided = stored(_decided(units.join(hot, "route", "left_anti").unionByName(strings), length), "pieces")
    back = single.select("of", "in", "i", "route", "ck").join(decided, ["route", "ck"]).groupBy("of", "in").agg(
        F.collect_list(F.struct(F.col("i").alias("a"), (F.col("i") + 1).alias("b"), F.col("runs")[0]["age"].alias("age"))).alias("runs"))
    back = stored(back.select(F.col("of").alias("route"), F.col("in").alias("ck"), "runs"), "back")
    decided = decided.unionByName(back)
    release(spark)
    spans = each.drop("context").join(decided, ["route", "ck"]).select("age", "th", F.transform(
        F.filter("runs", lambda r: r["age"] < F.col("age")),
        lambda r: F.struct((F.col("start") + r["a"]).alias("s"), (F.col("start") + r["b"] + (length - 1)).alias("e"))).alias("spans"))
    spans = stored(spans.filter(F.size("spans") > 0).groupBy("age", "th").agg(
        F.flatten(F.collect_set("spans")).alias("spans")), "spans")
    release(spark)
    done = _removed(found.join(spans, ["age", "th"], "left").select("id", "raw", "spans"))
    none = F.array().cast("array<struct<s:int,e:int>>")
    whole = cut.filter("raw is null").select("id", "n_bytes", F.lit(0).cast("long").alias("n_removed"),
                                             F.lit(0).cast("long").alias("n_spans"), "kept_sha256",
                                             F.lit(None).cast("binary").alias("kept"), none.alias("spans"))
    gone = F.octet_length("raw") >= length
    copies = rows.join(later, ["age", "th"], "left_semi").select(
        "id", F.octet_length("raw").cast("long").alias("n_bytes"),
        F.when(gone, F.octet_length("raw")).otherwise(0).cast("long").alias("n_removed"), gone.cast("long").alias("n_spans"),
        F.sha2(F.when(gone, F.lit(b"")).otherwise(F.col("raw")), 256).alias("kept_sha256"),
        F.when(gone, F.lit(b"")).alias("kept"),
        F.when(gone, F.array(F.struct(F.lit(0).alias("s"), F.octet_length("raw").alias("e")))).otherwise(none).alias("spans"))
    return done.unionAll(whole).unionAll(copies).withColumnRenamed("id", id_col)


def _removed(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bound = batch.column("spans").offsets.to_numpy()
            starts, ends = (batch.column("spans").values.field(c).to_numpy(zero_copy_only=False) for c in ("s", "e"))
            sizes, digests, kept, begins, finishes = [], [], [], [_NO_RUNS[1]], [_NO_RUNS[1]]
            for i, buf in enumerate(batch.column("raw")):
                raw, s, e = buf.as_buffer(), starts[bound[i]:bound[i + 1]], ends[bound[i]:bound[i + 1]]
                order = np.argsort(s, kind="stable")
                s, e = s[order], np.maximum.accumulate(e[order])
                new = np.flatnonzero(np.append(True, s[1:] > e[:-1])) if len(s) else order
                begins.append(s[new])
                finishes.append(e[np.append(new[1:], len(s)) - 1] if len(s) else e)
                sizes.append(len(new))
                edges = [0, *np.stack([begins[-1], finishes[-1]], 1).ravel().tolist(), len(raw)]
                left = b"".join(raw[a:b].to_pybytes() for a, b in zip(edges[::2], edges[1::2]))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left if len(new) else None)
            begin, finish = np.concatenate(begins), np.concatenate(finishes)
            cuts = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
            taken = np.concatenate([[0], np.cumsum((finish - begin).astype(np.int64))])[cuts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pc.binary_length(batch.column("raw")).cast(pa.int64()), pa.array(np.diff(taken)),
                 pa.array(np.diff(cuts)), pa.array(digests, pa.string()), pa.array(kept, pa.binary()),
                 _lists(cuts, s=begin, e=finish)],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])
    return rows.mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, "
                           "kept_sha256 string, kept binary, spans array<struct<s:int,e:int>>")
