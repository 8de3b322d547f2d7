"""Helpers shared by the operators: tables in the shared folder and hashing inside tasks."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# Entries a worker's word cache may hold before it starts afresh (memory bound, never a result cap).
CACHE_ENTRIES = 400_000


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there, and a
    lost executor costs no earlier stage."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**({"compression": "zstd"} | options)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished phases: it does so once the driver has
    collected what refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def utf8(col) -> F.Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.encode(F.coalesce(col, F.lit("")), "UTF-8")


def unsigned_crc32(col) -> F.Column:
    return F.crc32(col).cast("long")


def slices(texts: list, max_bytes: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``max_bytes`` of text each (one row at least)."""
    return cuts([len(t) if t else 0 for t in texts], max_bytes)


def cuts(sizes: list[int], max_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of the given sizes with at most ``max_bytes`` each (one row at least)."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > max_bytes:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


_MEMORY: dict[str, object] = {}


def worker_memory(key: str, make: Callable[[], object]):
    """What a worker remembers for an operator, made when it is first asked for.  Workers outlive
    stages: what the operator before has left goes first, so that a worker holds one at a time."""
    if key not in _MEMORY:
        _MEMORY.clear()
        pa.default_memory_pool().release_unused()
        _MEMORY[key] = make()
    return _MEMORY[key]


class WordHashes(dict):
    """64-bit hash of a word (bytes), remembered for the worker's later rows."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word, self.seed)
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        if len(word) <= 64:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15


def gram_hashes(h: np.ndarray, k: int, base: int = BASE) -> np.ndarray:
    """Hash of every run of ``k`` consecutive entries (``len(h) - k + 1`` values).

    Polynomial hashes of doubling lengths are put together, so the cost grows with log k.
    """
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, size, whole, done = h, 1, None, 0
    while True:
        if k & size:
            if whole is None:
                whole = power
            else:  # append runs of this size after what is put together so far
                m = len(power) - done
                whole = whole[:m] * np.uint64(pow(base, size, 1 << 64)) + power[done:]
            done += size
        if done == k:
            return mixed(whole[:n].copy())
        m = len(power) - size
        power = power[:m] * np.uint64(pow(base, size, 1 << 64)) + power[size:]
        size *= 2


def _sliding(x: np.ndarray, w: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``w`` consecutive entries."""
    size, best = 1, x
    while size * 2 <= w:
        best = pick(best[:len(best) - size], best[size:])
        size *= 2
    return best if size == w else pick(best[:len(best) - (w - size)], best[w - size:])


def window_minima(grams: np.ndarray, w: int) -> np.ndarray:
    """Smallest hash of every ``w`` consecutive grams."""
    return _sliding(grams, w, np.minimum) if len(grams) >= w else grams[:0]


def chosen(grams: np.ndarray, minima: np.ndarray, w: int) -> np.ndarray:
    """Positions of the grams that are the minimum of some window (all of them on ties).

    A gram is never below the minima of the windows around it, so it is one of them exactly if the
    largest of these minima equals it.
    """
    if not len(minima):
        return np.zeros(0, np.int64)
    pad = np.zeros(w - 1, np.uint64)
    return np.nonzero(_sliding(np.concatenate([pad, minima, pad]), w, np.maximum) == grams)[0]
