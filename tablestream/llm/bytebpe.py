"""Byte-level BPE with a segment tree over byte positions.

A piece of text is a row of bytes.  Leaf ``i`` of a segment tree holds the rank of the pair that begins
at byte ``i`` (the token there and the next live one) together with ``i``; an inner node holds the
smaller of its two children.  The root is therefore the leftmost pair of the lowest rank.  A merge makes
the right token's leaf dead and changes the leaves of the merged token and of its live left neighbour:
three point updates of logarithmic cost, each stopping where a node stays as it was.  A piece of n bytes
costs n log n, also when it is a run of a million letters.

Pieces met before come from a bounded memory of the worker.  Null and empty texts encode to no ids and
decode to no bytes; equal rows give equal results; a null id is kept; extra columns are ignored,
whatever their names; an empty table gives no rows; very long texts take memory in proportion to one
row's bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

PIECE_ENTRIES = 700_000   # remembered pieces of a worker: a memory bound, never a cap on results
PIECE_BYTES = 128         # longer pieces are not remembered
PAIR_ENTRIES = 2_000_000
DEAD = 1 << 62
PLACE = (1 << 32) - 1     # low bits of a leaf: its position
COMMON = 0x3000           # code points whose classes the fast splitter knows


class PairTree:
    """Smallest key over positions 0 to n-1, with point updates."""

    def __init__(self, keys: list[int]):
        size = 1
        while size < len(keys):
            size *= 2
        self.size = size
        nodes = [DEAD] * size + keys + [DEAD] * (size - len(keys))
        for i in range(size - 1, 0, -1):
            a, b = nodes[2 * i], nodes[2 * i + 1]
            nodes[i] = a if a < b else b
        self.nodes = nodes

    def least(self) -> int:
        return self.nodes[1]

    def put(self, at: int, key: int) -> None:
        nodes, i = self.nodes, at + self.size
        nodes[i] = key
        while i > 1:
            other = nodes[i ^ 1]
            key = key if key < other else other
            i >>= 1
            if nodes[i] == key:
                return
            nodes[i] = key


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken vocabulary file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


def _ranges(name: str) -> str:
    """The common code points of a class, as ranges of a character set."""
    found, out, start = regex.compile(name).match, [], None
    for c in range(COMMON + 1):
        hit = c < COMMON and found(chr(c)) is not None
        if hit and start is None:
            start = c
        elif not hit and start is not None:
            out.append(f"\\u{start:04x}-\\u{c - 1:04x}")
            start = None
    return "".join(out)


def spelt_out(pattern: str) -> str:
    """``pattern`` for the built-in engine: Unicode properties and white space as ranges of common code
    points.  It finds the same pieces in texts that hold no other code points."""
    inside, out = False, []
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.S):
        if part in "[]":
            inside = part == "["
        elif part == r"\S":
            part = f"[^{_ranges(chr(92) + 's')}]"
        elif part.startswith(r"\p") or part == r"\s":
            part = _ranges(part) if inside else f"[{_ranges(part)}]"
        out.append(part)
    return "".join(out)


class ByteBpe:
    """Encoder and decoder for a table of token ranks, which are the ids too."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.tokens = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.pairs: dict[int, int] = {}
        self.known: dict[str, bytes] = {}
        self.full = regex.compile(pattern).findall
        self.fast = re.compile(spelt_out(pattern)).findall
        self.rare = re.compile(f"[^\\u0000-\\u{COMMON - 1:04x}]").search

    def _pair(self, a: int, b: int) -> int:
        """Rank of two neighbouring tokens in the high bits of a leaf, or ``DEAD``."""
        key = a << 32 | b
        got = self.pairs.get(key)
        if got is None:
            rank = self.ranks.get(self.tokens[a] + self.tokens[b])
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            got = self.pairs[key] = DEAD if rank is None else rank << 32
        return got

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, pair = len(piece), self._pair
        token = [self.ranks[piece[i:i + 1]] for i in range(n)]
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        tree = PairTree([pair(token[i], token[i + 1]) | i for i in range(n - 1)])
        while (key := tree.least()) < DEAD:
            at = key & PLACE
            gone = right[at]
            after = right[at] = right[gone]
            token[at] = key >> 32
            if gone < n - 1:
                tree.put(gone, DEAD)
            if after < n:
                left[after] = at
                tree.put(at, pair(token[at], token[after]) | at)
            else:
                tree.put(at, DEAD)
            before = left[at]
            if before >= 0:
                tree.put(before, pair(token[before], token[at]) | before)
        out, at = [], 0
        while at < n:
            out.append(token[at])
            at = right[at]
        return out

    def pieces(self, text: str) -> list[str]:
        return self.full(text) if self.rare(text) else self.fast(text)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        known, out = self.known, []
        for piece in self.pieces(text):
            ids = known.get(piece)
            if ids is None:
                raw = piece.encode()
                ids = array("I", self.merge(raw)).tobytes()
                if len(raw) <= PIECE_BYTES:
                    if len(known) >= PIECE_ENTRIES:
                        known.clear()
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


_BPE: dict[tuple[str, str], ByteBpe] = {}


def byte_bpe(path: str, pattern: str) -> ByteBpe:
    if (path, pattern) not in _BPE:
        _BPE[path, pattern] = ByteBpe(path, pattern)
    return _BPE[path, pattern]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text", keep: bool = True) -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, with ``keep``, ``ids``
    (little-endian unsigned 32-bit) and ``decoded`` (bytes)."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(ranks_path, pattern)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts, 8 << 20):
                ids = [bpe.encode(t) for t in texts[a:b]]
                decoded = [bpe.decode(i) for i in ids]
                cols = [batch.column("id").slice(a, b - a), pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                        pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string())]
                if keep:
                    cols += [pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids binary, decoded binary" * keep
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
