"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled text: one of ordinary words, one of the same words
and, farthest (so that ordinary words cost the same in both), pieces typical of toxic text; the first has
their halves there, so that only whole pieces make a difference.  Every text is cut into overlapping windows of a few words, and a window's distance is how many bytes fewer
it takes under the toxic dictionary.  A logistic model over the distances (how many windows pass each
of a row of thresholds, the largest distance, their mean and spread, the number and length of the
windows) turns them into a calibrated score.

The model is fitted in one task on an executor, from at most ``MAX_TOXIC`` and ``MAX_ORDINARY`` labelled
documents of at most ``MAX_TRAIN_BYTES`` each (one text per id, whatever the rows of an id), two thirds
for the dictionaries and a third for the calibration, which weighs both classes as they stand in the whole
label table.  Only the model, some 20 KB, reaches the driver.  Scoring reads whole texts.

Null and empty texts are scored like a text without toxic windows; rows with a null id are never
trained on and held out as crc32 of nothing says; a label repeated with both values counts as toxic;
extra columns are ignored; an empty document table gives no rows; labels of one class, or none, give
every document that class's share as its score.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CACHE_ENTRIES, WordHashes, gram_hashes

MAX_TOXIC = 3000
MAX_ORDINARY = 6000
MAX_TRAIN_BYTES = 32768
WINDOW, STEP = 6, 3  # words
LEVEL = 6
DICT_BYTES = 8192  # of ordinary words, and again of toxic pieces
PIECES, LONGEST_START = (4, 6, 8), 12  # characters of pieces anywhere; of a word's start, at most
SLOTS = 1 << 22  # counters that pieces are hashed to, before those of frequent ones are counted
THRESHOLDS = (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12)  # bytes
SCORE_LIMIT = 0.3


def held_out(id_col: Column) -> Column:
    """Rows never learnt from."""
    return F.coalesce(F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


class Distance:
    """Bytes saved by the toxic dictionary, window by window."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        halves = b" ".join(h for p in toxic.split() for h in (p[:len(p) // 2], p[len(p) // 2:])) + b" "
        self._ordinary, self._toxic = _compressor(halves + ordinary), _compressor(toxic + ordinary)

    def features(self, text: str) -> list[float]:
        words = text.lower().encode().split()
        plain, toxic = self._ordinary, self._toxic
        saved, size = [], 0
        for i in range(0, max(1, len(words) - WINDOW + STEP), STEP):
            w = b" ".join(words[i:i + WINDOW])
            size += len(w)
            saved.append(len(plain(w)) - len(toxic(w)))
        d, n = np.asarray(saved), len(saved)
        top = max(0, int(d.max()))
        return [float(np.log1p((d >= t).sum())) for t in THRESHOLDS] + [
            top, float(np.log(n)), top / float(np.log(n + 8)),
            float(d.mean()), float(d.std()), float(np.log1p(size / n))]


def _compressor(content: bytes):
    import zstandard

    content = content or b" " * 8
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False,
                                    write_content_size=False, write_dict_id=False).compress


def _pieces(word: bytes) -> set[str]:
    """The whole word, its starts, and pieces of several lengths in characters; ends are spaces."""
    t = " " + word.decode() + " "
    return ({t} | {t[:n] for n in range(4, min(len(t), LONGEST_START + 1))}
            | {t[i:i + n] for n in PIECES for i in range(len(t) - n + 1)})


def _content(counts: Counter) -> bytes:
    """The most frequent words or pieces that fit, the most frequent last (nearest to the window)."""
    out, size = [], 0
    for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        if size + len(w) + 1 > DICT_BYTES:
            break
        out.append(w)
        size += len(w) + 1
    return b" ".join(reversed(out)) + b" "


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of both dictionaries.

    Words in a run of three that an earlier document of the same side has (copies and standing passages)
    are not counted again as evidence.  A piece is typical of toxic text if at least four toxic documents have it
    (one in 190 of many) and it is twenty times as frequent there as in ordinary text.  Every toxic word
    gives the dictionary its longest typical piece, the most frequent of equals.
    """
    split = [[t.lower().encode().split() for t in side] for side in (toxic, ordinary)]
    ordinary_words = Counter(w for ws in split[1] for w in ws)   # as they come, standing passages included
    hashes = WordHashes(6)
    runs = [[gram_hashes(hashes.of(ws), 3) for ws in side] for side in split]
    values, times = np.unique(np.concatenate([np.unique(r) for side in runs for r in side] or [np.zeros(0, np.uint64)]),
                              return_counts=True)
    repeated = values[times > 1]

    def own(ws: list[bytes], runs: np.ndarray, seen: np.ndarray) -> list[bytes]:
        places = np.searchsorted(repeated, runs)   # one lookup a run; isin would sort all of them a document
        found = (np.append(repeated, [np.uint64(0)])[places] == runs) & (places < len(repeated))
        again = {i + j for i in np.flatnonzero(found & seen[places]).tolist() for j in range(3)}
        seen[places[found]] = True
        return [w for i, w in enumerate(ws) if i not in again]

    split = [[own(ws, r, seen) for ws, r in zip(docs, rs)]
             for docs, rs, seen in zip(split, runs, np.zeros((2, len(repeated) + 1), bool))]
    del runs, values, times
    size = [1 + sum(map(len, side)) for side in split]
    enough = max(4, len(toxic) // 190)
    slots = np.zeros(SLOTS, np.int32)
    for ws in split[0]:
        slots[list({hash(p) % SLOTS for w in set(ws) for p in _pieces(w)})] += 1
    frequent = slots >= enough   # no piece of as many documents is lost, few others stay
    have = Counter(p for ws in split[0] for p in {p for w in set(ws) for p in _pieces(w) if frequent[hash(p) % SLOTS]})
    have = {p: n for p, n in have.items() if n >= enough}
    held = Counter()
    known: dict[bytes, set[str]] = {}
    for ws in split[1]:
        if len(known) >= CACHE_ENTRIES:
            known.clear()
        words = set(ws)
        known.update((w, _pieces(w) & have.keys()) for w in words if w not in known)
        held.update(set().union(*map(known.__getitem__, words)))
    known.clear()
    typical = {p for p, n in have.items() if n / size[0] > 20 * (held[p] + 0.5) / size[1]}
    best = {w: max(found, key=lambda p: (len(p), have[p], p))
            for w in {w for ws in split[0] for w in ws} if (found := _pieces(w) & typical)}
    chosen = Counter(best[w] for ws in split[0] for w in ws if w in best)
    spread = Counter(p for ws in split[0] for p in {best[w] for w in ws if w in best})
    return _content(ordinary_words), _content(Counter({p.encode(): n for p, n in chosen.items() if spread[p] >= enough}))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, scale and weights (the constant last) of a ridge logistic regression."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + np.eye(len(w))
        w += np.linalg.solve(h, z.T @ (weight * (y - p)) - w)
    return mean, scale, w


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> dict:
    """Model fitted on the labelled rows that are not held out."""
    marks = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
             .filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("y").alias("y")))
    counts = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return {"share": float(1 in counts)}
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        F.col("text").isNotNull() & (F.octet_length("text") <= MAX_TRAIN_BYTES))
    order = F.xxhash64("id", F.lit(6))
    # ids alone are ranked; only the picked documents' texts move
    ids = [marks.filter(F.col("y") == y).orderBy(order, "id").limit(most) for y, most in ((1, MAX_TOXIC), (0, MAX_ORDINARY))]
    sample = (texts.join(ids[0].unionByName(ids[1]), "id").groupBy("id", "y").agg(F.min("text").alias("text"))
              .withColumn("place", order))

    def task(t: pa.Table) -> pa.Table:
        t = t.sort_by([("place", "ascending"), ("id", "ascending")])
        sides = [t.filter(pa.compute.equal(t.column("y"), y)).column("text").to_pylist() for y in (1, 0)]
        return pa.table({"model": pa.array([pickle.dumps(fit(*sides, counts))], pa.binary())})

    found = sample.groupBy().applyInArrow(task, "model binary").first()
    return pickle.loads(found["model"]) if found else {"share": counts[1] / sum(counts.values())}


def fit(toxic: list[str], ordinary: list[str], counts: dict[int, int]) -> dict:
    """Model of the sampled texts; ``counts`` are the labels of the whole table."""
    plain_dict, toxic_dict = dictionaries(*[[t for i, t in enumerate(side) if i % 3 < 2] for side in (toxic, ordinary)])
    measure = Distance(plain_dict, toxic_dict)
    rest = toxic[2::3], ordinary[2::3]
    if not (rest[0] and rest[1]):
        return {"share": counts[1] / sum(counts.values())}
    x = np.array([measure.features(t) for side in rest for t in side])
    y = np.array([1] * len(rest[0]) + [0] * len(rest[1]))
    share = np.array([counts[0], counts[1]]) / sum(counts.values())
    weight = np.where(y == 1, share[1] / len(rest[0]), share[0] / len(rest[1])) * len(y)
    mean, scale, w = logistic(x, y, weight)
    return {"plain": plain_dict, "toxic": toxic_dict, "mean": mean, "scale": scale, "w": w}


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` (0 to 1), ``predicted`` (1 from 0.3 on) and
    ``text_hash``, which tells rows of one id apart."""
    model = train(docs, labels, id_col, text_col, label_col)
    rows = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = None if "share" in model else Distance(model["plain"], model["toxic"])
        for batch in batches:
            texts = batch.column("text")
            if measure is None:
                s = np.full(len(texts), model["share"])
            else:
                x = np.array([measure.features(t.as_py()) for t in texts]).reshape(len(texts), -1)
                if len(x):
                    x = (x - model["mean"]) / model["scale"]
                    s = 1 / (1 + np.exp(-np.clip(x @ model["w"][:-1] + model["w"][-1], -30, 30)))
                else:
                    s = np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(s, pa.float64()),
                 pa.array((s >= SCORE_LIMIT).astype(np.int32)), batch.column("text_hash")],
                ["id", "held_out", "score", "predicted", "text_hash"])

    return (rows.mapInArrow(run, f"id {id_type}, held_out boolean, score double, predicted int, text_hash long")
            .withColumnRenamed("id", id_col))
