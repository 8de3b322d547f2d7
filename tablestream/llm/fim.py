"""Fill-in-middle transformation with content-defined chunk memoization.

A text is cut into units (a run of ASCII letters, or one other code point).  Two cut points drawn from
the document's id split it into prefix, middle and suffix, which are put in a new order behind
sentinels.  To count the units, a rolling hash over the code points cuts the text into chunks whose ends
depend on the text around them only, so passages shared by documents give the same chunks.  A worker
remembers a chunk's boundary summary: its number of units, whether it begins and whether it ends inside
a letter run.  Chunks are found by their whole content (a hash match counts only if the texts are equal).
Counts of consecutive chunks add up, less one where a letter run goes on over the boundary; the sums tell
in which chunk a cut falls, and only that chunk is split into units again.

Null and empty texts have no units and stay plain; a null id draws its cuts from an empty number; equal
rows give equal results; extra columns are ignored, whatever their names; an empty table gives no rows.
Very long texts are hashed in blocks of fixed size and never handled unit by unit as a whole: memory is a
few times the text of one row.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CACHE_ENTRIES, slices

# The units, and the sentinels before prefix, suffix and middle.
UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

ROLL = 32            # code points that the rolling hash sees
CUT_BITS = 8         # a chunk ends where so many leading bits are zero: 256 code points on average
SHORTEST, LONGEST = 32, 4096
HASH_BLOCK = 1 << 20


def _gear(codes: np.ndarray) -> np.ndarray:
    """Rolling hash of the last ``ROLL`` code points at every position: each one's own hash, shifted by
    its distance.  Shifts of doubling lengths are added up."""
    h = codes * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA77)
    step = 1
    while step < ROLL:
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    return h


def chunk_ends(text: str) -> list[int]:
    """Ends of the chunks of ``text`` (the last is its length)."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n, ends, last = len(codes), [], 0
    for a in range(0, n, HASH_BLOCK):
        before = min(a, ROLL - 1)
        h = _gear(codes[a - before:a + HASH_BLOCK])[before:]
        for at in (np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + (a + 1)).tolist():
            while at - last > LONGEST:
                last += LONGEST
                ends.append(last)
            if at - last >= SHORTEST:
                ends.append(at)
                last = at
    ends += range(last + LONGEST, n, LONGEST)
    if n and (not ends or ends[-1] < n):
        ends.append(n)
    return ends


def _letter(c: str) -> bool:
    return "a" <= c <= "z" or "A" <= c <= "Z"


class Chunks(dict):
    """Boundary summary of a chunk: units, begins with a letter, ends with a letter."""

    def __missing__(self, chunk: str) -> tuple[int, bool, bool]:
        if len(self) >= CACHE_ENTRIES:   # memory bound, never a cap on results
            self.clear()
        got = self[chunk] = (len(UNIT.findall(chunk)), _letter(chunk[0]), _letter(chunk[-1]))
        return got


class UnitIndex:
    """Number of units of a text, and the place of a unit, from the summaries of its chunks."""

    def __init__(self, text: str, chunks: Chunks):
        self.text, self.ends = text, chunk_ends(text)
        self.joins, fresh, inside, start = [], [], False, 0
        for end in self.ends:
            units, first, last = chunks[text[start:end]]
            join = inside and first           # its first unit began in an earlier chunk
            self.joins.append(join)
            fresh.append(units - join)
            inside, start = last, end
        self.upto = list(accumulate(fresh))   # units begun up to the end of each chunk
        self.n = self.upto[-1] if fresh else 0

    def place(self, unit: int) -> int:
        """Code points before unit number ``unit`` (from 0; the number of units is the text's end)."""
        if unit >= self.n:
            return len(self.text)
        k = bisect_right(self.upto, unit)
        local = unit - (self.upto[k - 1] if k else 0) + self.joins[k]
        start = self.ends[k - 1] if k else 0
        found = next(islice(UNIT.finditer(self.text, start, self.ends[k]), local, None))
        return found.start()


def draws(row_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers that the seed and the id decide."""
    digest = hashlib.sha256(f"{seed}:{'' if row_id is None else row_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def transform_text(text: str, row_id: int | None, chunks: Chunks, seed: int = 1, rate: int = 90,
                   spm: int = 20) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, and the output."""
    index = UnitIndex(text, chunks)
    h1, h2, h3, h4 = draws(row_id, seed)
    if not text or h3 % 100 >= rate or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return index.n, "plain", None, None, text
    first, second = sorted((h1 % (index.n + 1), h2 % (index.n + 1)))
    a, b = index.place(first), index.place(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return index.n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return index.n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore_text(output: str, form: str) -> str:
    """The text that an output of the given form came from.  No sentinel begins with the end of another
    one, and no transformed text holds one, so the first of each kind is the real one."""
    if form == "plain":
        return output
    front, middle = output.split(MIDDLE, 1)
    if form == "psm":
        prefix, suffix = front[len(PREFIX):].split(SUFFIX, 1)
    else:
        suffix, prefix = front[len(SUFFIX):].split(PREFIX, 1)
    return prefix + middle + suffix


_CHUNKS = Chunks()


def transform(docs: DataFrame, seed: int = 1, rate: int = 90, spm: int = 20, id_col: str = "doc_id",
              text_col: str = "text", keep: bool = True) -> DataFrame:
    """Per row: id, ``n`` units, ``form`` (plain, psm, spm), ``prefix_chars``, ``middle_chars`` (null if
    plain), ``output_sha256``, ``restored_sha256`` (of the text rebuilt from output and form) and, with
    ``keep``, ``output``.  ``rate`` of 100 documents are transformed, ``spm`` of 100 of those suffix first."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = (f"id {id_type}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, "
              f"restored_sha256 string" + ", output string" * keep)
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sha(t: str) -> str:
            return hashlib.sha256(t.encode()).hexdigest()

        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            for a, b in slices(texts):
                got = [transform_text(t, i, _CHUNKS, seed, rate, spm) for i, t in zip(ids[a:b], texts[a:b])]
                cols = [batch.column("id").slice(a, b - a), pa.array([g[0] for g in got], pa.int64()),
                        pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.int64()),
                        pa.array([g[3] for g in got], pa.int64()), pa.array([sha(g[4]) for g in got], pa.string()),
                        pa.array([sha(restore_text(g[4], g[1])) for g in got], pa.string())]
                if keep:
                    cols.append(pa.array([g[4] for g in got], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
