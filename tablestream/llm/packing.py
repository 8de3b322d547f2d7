"""Packing documents into token sequences by first-fit decreasing.

Documents are dealt at random (by hash) into groups of about ``group_docs``.  Inside a group every
whole stretch of ``seq_len`` tokens becomes a sequence of its own; the remainders are placed by
first-fit decreasing, where a tournament tree over the bins' free space finds the first bin that
holds a remainder in logarithmic time.  Bins that stay open are then filled from the emptiest one by
cutting its pieces, and the last open bin is cut into power-of-two sequences, which need no padding.

Null and empty texts give the end token alone.  Equal rows are packed separately, each under its own
id; a null id is kept as null.  An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cuts, worker_memory

END_ID = 1
SEQ_LEN = 2048
GROUP_DOCS = 1024
CHUNK_ENTRIES = 500_000  # remembered chunks of a worker: a memory bound, never a cap on results
# fixed value: how a byte-level tokenizer cuts a text into pieces
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


class ByteBpe:
    """Ids of a byte-level tokenizer file, worked out once for each blank-separated chunk of a batch.

    A token never reaches over a single blank that has other characters on both sides, so a text's
    ids are those of its chunks in order.  A batch's texts are split and their distinct chunks numbered
    by Arrow; those chunks are encoded in one go, with the file's own vocabulary as byte ranks (few of
    them: only those not remembered), and every text is put together from its chunks' numbers.  Texts with blanks beside other white
    space, letters beyond Latin, or the special tokens' strings go to the tokenizers library whole;
    both ways give its ids.
    """

    space = r"[\t-\r\x1c-\x20\x{85}\x{a0}]"
    odd = rf"{space}{space}|^{space}|{space}$|<\||[^\x00-\x{{24f}}]"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        # the byte-level alphabet: printable Latin-1 stands for itself, the rest from U+0100 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        special = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in self.tok.get_vocab().items()
                 if t not in special}
        self.core = tiktoken.Encoding("file", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.begins = np.zeros(max(ranks.values()) + 1, bool)  # tokens that begin with a blank
        self.begins[[i for t, i in ranks.items() if t[0] == 32]] = True
        self.later = _Chunks()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        return self.encode_array(pa.array(texts, pa.string())).to_pylist()

    def encode_array(self, texts: pa.StringArray, end: bytes = b"") -> pa.BinaryArray:
        """Ids of each text, followed by ``end``."""
        odd = pc.match_substring_regex(texts, self.odd)
        split = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        bounds, chunks = split.offsets.to_numpy(), split.values.dictionary_encode()
        words, codes = chunks.dictionary, chunks.indices.to_numpy().astype(np.int32)
        first, n = bounds[:-1], len(texts)
        own = [self._library(t) if o else self._ids(f) for t, o, f in
               zip(texts.to_pylist() if pc.any(odd).as_py() else [None] * n, odd.to_pylist(),
                   words.take(pa.array(codes[first])).to_pylist())]
        later, used = np.ones(len(codes), bool), np.zeros(len(words), bool)
        later[first] = False
        used[codes[later]] = True
        known = self._later(words.filter(pa.array(used)))
        codes = (np.cumsum(used, dtype=np.int32) - 1)[codes]
        codes[first] = len(known) + np.arange(n, dtype=np.int32)
        codes = np.insert(codes, bounds[1:], len(known) + n)
        bounds = bounds + np.arange(n + 1)
        joined = pa.concat_arrays([known, pa.array([*own, end], pa.binary())]).take(pa.array(codes))
        ends = np.frombuffer(joined.buffers()[1], np.int32)[bounds]
        return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), joined.buffers()[2]])

    def _library(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _ids(self, text: str) -> bytes:
        return array("I", self.core.encode_ordinary(text)).tobytes()

    def _later(self, chunks: pa.StringArray) -> pa.BinaryArray:
        """Ids of distinct chunks that follow a blank, with that blank.  Looking up very many takes longer
        than encoding them."""
        if not len(chunks) or len(chunks) > CHUNK_ENTRIES // 8:
            return self._with_blank(chunks)
        names = chunks.to_pylist()
        found = list(map(self.later.find, names))
        new = [c for c, ids in zip(names, found) if ids is None]
        made = iter(self._with_blank(pa.array(new, pa.string())).to_pylist())
        found = [next(made) if ids is None else ids for ids in found]
        self.later.keep(dict(zip(names, found)))
        return pa.array(found, pa.binary())

    def _with_blank(self, chunks: pa.StringArray) -> pa.BinaryArray:
        """All chunks are encoded as one text, in which a token with a blank begins the next chunk."""
        if not len(chunks):
            return pa.array([], pa.binary())
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks), " ")[0].as_py()
        ids = np.asarray(self.core.encode_ordinary(" " + text), np.uint32)
        ends = np.append(np.flatnonzero(self.begins[ids]), len(ids)).astype(np.int32) * 4
        return pa.Array.from_buffers(pa.binary(), len(chunks), [None, pa.py_buffer(ends), pa.py_buffer(ids)])


class _Chunks(dict):
    """Chunks met since the last turn; those of the turn before stay when they are met again, so
    frequent ones stay when the others go."""

    def __init__(self):
        super().__init__()
        self.older = {}

    def find(self, chunk: str) -> bytes | None:
        return self.get(chunk) or self.older.get(chunk)

    def keep(self, met: dict[str, bytes]) -> None:
        most = CHUNK_ENTRIES // 2
        if len(self) + sum(c not in self for c in met) > most:
            self.older = dict(self)
            self.clear()
        short = ((c, ids) for c, ids in met.items() if len(c) <= 64)
        self.update(islice(short, most))


def byte_bpe(path: str) -> ByteBpe:
    return worker_memory(f"packing {path}", lambda: ByteBpe(path))


class TournamentTree:
    """Free space of bins; ``first(size)`` is the first bin with at least that much."""

    def __init__(self, capacity: int, leaves: int):
        self.n = 1 << max(0, (leaves - 1).bit_length())
        self.tree = [capacity] * (2 * self.n)

    def first(self, size: int) -> int:
        t, i = self.tree, 1
        while i < self.n:
            i += i
            if t[i] < size:
                i += 1
        return i - self.n

    def take(self, bin_no: int, size: int) -> None:
        t, i = self.tree, bin_no + self.n
        t[i] -= size
        while i > 1:
            i >>= 1
            t[i] = max(t[2 * i], t[2 * i + 1])


def pack_lengths(lengths: list[int], seq_len: int) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of ``(item, start, length)`` for items of the given lengths."""
    full, rest = [], []
    for i, n in enumerate(lengths):
        whole = n - n % seq_len
        full += [[(i, s, seq_len)] for s in range(0, whole, seq_len)]
        if n > whole:
            rest.append((n - whole, i, whole))
    if not rest:
        return full
    rest.sort(key=lambda x: (-x[0], x[1]))
    tree = TournamentTree(seq_len, len(rest))
    bins: list[list[tuple[int, int, int]]] = []
    for n, i, s in rest:
        b = tree.first(n)
        if b == len(bins):
            bins.append([])
        bins[b].append((i, s, n))
        tree.take(b, n)
    used = [sum(p[2] for p in b) for b in bins]
    done = [b for b, u in zip(bins, used) if u == seq_len]
    opened = sorted(((u, b) for b, u in zip(bins, used) if u < seq_len), key=lambda x: x[0])
    lo, hi = 0, len(opened) - 1
    levels = [u for u, _ in opened]
    while lo < hi:  # the emptiest bin's pieces fill the fullest one
        room = seq_len - levels[hi]
        i, s, n = opened[lo][1].pop()
        cut = min(room, n)
        opened[hi][1].append((i, s, cut))
        levels[hi] += cut
        levels[lo] -= cut
        if cut < n:
            opened[lo][1].append((i, s + cut, n - cut))
        if levels[hi] == seq_len:
            done.append(opened[hi][1])
            hi -= 1
        if not opened[lo][1]:
            lo += 1
    if lo == hi and opened[lo][1]:
        done += _powers_of_two(opened[lo][1])
    return full + done


def _powers_of_two(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Cut a sequence into sequences whose lengths are powers of two."""
    left, out = sum(p[2] for p in pieces), []
    queue = list(reversed(pieces))
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        seq = []
        while size:
            i, s, n = queue.pop()
            cut = min(size, n)
            seq.append((i, s, cut))
            size -= cut
            if cut < n:
                queue.append((i, s + cut, n - cut))
        out.append(seq)
    return out


def pack(docs: DataFrame, tokenizer_path: str, seq_len: int = SEQ_LEN, group_docs: int = GROUP_DOCS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit),
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n_groups = max(1, -(-rows.count() // group_docs))
    rows = rows.withColumn("grp", F.pmod(F.xxhash64("id", "text", F.lit(20)), F.lit(n_groups)))
    id_type = rows.schema["id"].dataType.simpleString()

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer_path)
        end = np.asarray([END_ID], np.uint32).tobytes()
        for batch in batches:
            for a, b in cuts(pc.binary_length(batch.column("text")).to_pylist(), 8 << 20):
                part = batch.slice(a, b - a)
                ids = bpe.encode_array(part.column("text"), end)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("grp"), ids],
                                                 ["id", "grp", "ids"])

    def packed(table: pa.Table) -> pa.Table:
        grp = table.column("grp")[0].as_py()
        ids = table.column("ids").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (zlib.crc32(ids[i]), len(ids[i])))
        lengths = [len(ids[i]) // 4 for i in order]
        out = {k: [] for k in ("row", "start", "length", "ids", "ids_crc32", "doc_tokens",
                               "sequence_id", "offset")}
        for no, seq in enumerate(pack_lengths(lengths, seq_len)):
            offset = 0
            for item, start, n in seq:
                i = order[item]
                piece = ids[i][4 * start:4 * (start + n)]
                for k, v in zip(out, (i, start, n, piece, zlib.crc32(piece), lengths[item],
                                      (grp << 32) + no, offset)):
                    out[k].append(v)
                offset += n
        found = table.column("id").combine_chunks().take(pa.array(out.pop("row"), pa.int64()))
        types = {"ids": pa.binary()}
        return pa.table([found] + [pa.array(v, types.get(k, pa.int64())) for k, v in out.items()],
                        ["id", *out])

    schema = (f"id {id_type}, start long, length long, ids binary, ids_crc32 long, "
              "doc_tokens long, sequence_id long, offset long")
    return (rows.mapInArrow(tokens, f"id {id_type}, grp long, ids binary")
            .groupBy("grp").applyInArrow(packed, schema).withColumnRenamed("id", id_col))
