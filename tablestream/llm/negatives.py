"""Hard negatives by Fagin's threshold algorithm.

The rows are dealt into blocks of bounded size, whatever their labels and ids.  A block keeps one list
per dimension, its rows sorted by that component.  For an anchor, every list is read from the end that
the sign of the anchor's component favours; a component of zero reads none.  Each row met is scored in
full at once (random access, in whole numbers).  The threshold is the score of a row that would hold the
last value read in every list: no row not yet met can be above it.  Reading goes on, in steps of
doubling length, until the threshold lies strictly below the k-th best score of each of the anchor's
windows, so ties at the k-th place are all met, or below a window's lower bound.

A window is a range of scores and a number of rows wanted.  The first search has one window per anchor
(the best rows of the same label: its positives), the second one per positive (rows of other labels whose
score lies between two shares of the positive's score).  Blocks search apart; the best rows of all blocks
are put in order per window.  The anchors are a stated share of all rows: they meet all rows block by
block, in groups of bounded size, and no pair that is not among a block's best is passed on.

Rows with a null id, label or vector, or with a null or non-finite component, take no part.  An empty
vector scores 0 with others like it.  Vectors of different lengths do not meet.  Repeated rows are rows
of their own: all but the anchor's row itself are its others, and ranks count each.  Equal scores go to
the smaller id.  An empty table gives no rows; extra columns are ignored, whatever their names (texts
among them, however long).  Scores that a long cannot hold end the query with an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BLOCK_ROWS = 16_384    # rows of a block: what one task sorts and holds
GROUP_ROWS = 4_096     # anchors that one task searches for
FIRST_DEPTH = 16
EXACT = 1 << 53        # whole numbers below it are exact as doubles,
EXACT_SHORT = 1 << 24  # below this one also as single floats
LIMIT = 1 << 63


class Lists:
    """A block's rows with one sorted list per dimension."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, numbers: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.rows, self.ids = rows[by_id], ids[by_id]
        self.labels, self.numbers = labels[by_id], numbers[by_id]
        self.size, self.width = rows.shape
        self.order = np.argsort(self.rows.T, axis=1, kind="stable").astype(np.int32)   # ascending, per dimension
        self.top = int(np.abs(self.rows).max(initial=0))
        self.floats = self.rows.astype(np.float32 if self.top ** 2 * self.width < EXACT_SHORT else np.float64)

    def scores(self, at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Inner products of the rows ``at`` with the anchor, exact."""
        most = self.top * int(np.abs(anchor).max(initial=0)) * max(1, self.width)
        if most < (EXACT_SHORT if self.floats.dtype == np.float32 else EXACT):
            return (self.floats[at] @ anchor.astype(self.floats.dtype)).astype(np.int64)
        if most < LIMIT:
            return self.rows[at] @ anchor
        exact = [sum(map(int.__mul__, row, anchor.tolist())) for row in self.rows[at].tolist()]
        if any(not -LIMIT <= s < LIMIT for s in exact):
            raise OverflowError("a score does not fit a long")
        return np.array(exact, np.int64)

    def threshold(self, depth: int, anchor: np.ndarray, up: np.ndarray, down: np.ndarray) -> int:
        """Score of a row with the last value read in every list."""
        last = np.concatenate([self.rows[self.order[up, self.size - depth], up], self.rows[self.order[down, depth - 1], down]])
        return sum(map(int.__mul__, last.tolist(), np.concatenate([anchor[up], anchor[down]]).tolist()))

    def search(self, anchor: np.ndarray, fits: np.ndarray, windows: list[tuple[int, int, int]]) -> list[list[tuple[int, int]]]:
        """Best rows of each window ``(lowest, highest, wanted)`` as ``(score, place)``, higher scores
        first, then smaller ids.  ``fits`` marks the rows that may be taken."""
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met = np.zeros(self.size, bool)
        places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)   # rows met that fit, with their scores
        depth, read = min(FIRST_DEPTH, self.size), 0
        while True:
            if len(up) + len(down):
                fresh = np.zeros(self.size, bool)
                fresh[self.order[up, self.size - depth:self.size - read].ravel()] = True
                fresh[self.order[down, read:depth].ravel()] = True
                fresh &= ~met
                met |= fresh
            else:                                       # no list to read: every score is 0
                fresh, depth = ~met, self.size
                met = fresh
            new = np.flatnonzero(fresh & fits)
            if len(new):
                places, scores = np.concatenate([places, new]), np.concatenate([scores, self.scores(new, anchor)])
            best = [self._best(places, scores, *w) for w in windows]
            if not (fits & ~met).any():                 # nothing is left that could be taken
                return best
            bound = self.threshold(depth, anchor, up, down)
            if all(bound < low or (len(b) == wanted and bound < b[-1][0])
                   for b, (low, _, wanted) in zip(best, windows)):
                return best
            read, depth = depth, min(2 * depth, self.size)

    def _best(self, places: np.ndarray, scores: np.ndarray, low: int, high: int, wanted: int) -> list[tuple[int, int]]:
        inside = np.flatnonzero((scores >= low) & (scores <= high))
        if len(inside) > wanted:     # all that reach the last wanted score, then by id
            least = np.partition(scores[inside], len(inside) - wanted)[len(inside) - wanted]
            inside = inside[scores[inside] >= least]
        s, p = scores[inside], places[inside]
        first = np.lexsort((p, -s))[:wanted]             # places are in the order of ids
        return list(zip(s[first].tolist(), p[first].tolist()))


def prepare(vectors: DataFrame, relabel: Callable | None = None, id_col: str = "vec_id", label_col: str = "label",
            vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """The rows that take part: ``row`` (a number of its own), ``id``, ``label`` and ``v``, the vector in
    whole numbers (``floor(scale * x)``).  ``relabel`` gives the label from the columns id and label."""
    v, label = F.col(vector_col), F.col(label_col).cast("long")
    if relabel is not None:
        label = relabel(F.col(id_col), label)
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull() & finite)
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                       label.alias("label"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _search(rows: DataFrame, asked: DataFrame, blocks: int, groups: int, same: bool) -> DataFrame:
    """Every window of ``asked`` (columns row, label, v, windows) against all rows, block by block.
    Gives the best rows of each block: ``anchor`` (row), ``window`` (from 1), ``score``, ``id``."""
    part = rows.select("row", "id", "label", "v", F.size("v").alias("width"), (F.col("row") % blocks).alias("block"),
                       F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), F.lit(False).alias("asks"),
                       F.lit(None).cast("array<struct<low:bigint,high:bigint,wanted:int>>").alias("windows"))
    ask = asked.select("row", F.lit(None).cast("long").alias("id"), "label", "v", F.size("v").alias("width"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
                       F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("grp"), F.lit(True).alias("asks"), "windows")

    def cell(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        width = t.column("width")[0].as_py()
        asks = t.column("asks").to_numpy()

        def side(mask: np.ndarray, name: str):
            return t.filter(pa.array(mask)).column(name).combine_chunks()

        if asks.all() or not asks.any():
            return pa.table({n: pa.array([], pa.int64()) for n in ("anchor", "window", "score", "id")})
        lists = Lists(_matrix(side(~asks, "v"), width), *(side(~asks, n).to_numpy() for n in ("id", "label", "row")))
        found: list[tuple[int, int, int, int]] = []
        for row, label, anchor, windows in zip(side(asks, "row").to_pylist(), side(asks, "label").to_pylist(),
                                               _matrix(side(asks, "v"), width), side(asks, "windows").to_pylist()):
            fits = (lists.labels == label) == same
            fits &= lists.numbers != row
            got = lists.search(anchor, fits, [(w["low"], w["high"], w["wanted"]) for w in windows])
            found += [(row, k, s, int(lists.ids[p])) for k, best in enumerate(got, 1) for s, p in best]
        cols = list(zip(*found)) or [[], [], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("anchor", "window", "score", "id"), cols)})

    return part.unionByName(ask).groupBy("width", "block", "grp").applyInArrow(
        cell, "anchor long, window long, score long, id long")


def _first(found: DataFrame, wanted: int) -> DataFrame:
    """The best ``wanted`` of each window over all blocks, with their rank."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)


def mine(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30,
         high: int = 90, relabel: Callable | None = None, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """For each anchor (ids divisible by ``every``) and each of its ``positives`` best rows of the same
    label, the ``negatives`` best rows of other labels whose score is at least ``low`` and at most
    ``high`` hundredths of the positive's: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score``."""
    rows = stored(prepare(vectors, relabel, id_col, label_col, vector_col, scale), "vectors")
    is_anchor = F.col("id") % every == 0
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count(F.when(is_anchor, 1))).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    # a block is never larger than BLOCK_ROWS; small tables are cut finer so that all cores work
    blocks = max(math.ceil(n / BLOCK_ROWS), min(cores, math.ceil(n / 1024)), 1)
    groups = max(math.ceil(n_anchors / GROUP_ROWS), 1)
    anchors = rows.filter(is_anchor)
    window = "array<struct<low:bigint,high:bigint,wanted:int>>"

    ends = F.lit(-LIMIT).cast("long"), F.lit(LIMIT - 1).cast("long")
    one = F.array(F.struct(ends[0].alias("low"), ends[1].alias("high"), F.lit(positives).alias("wanted")))
    near = _first(_search(rows, anchors.withColumn("windows", one.cast(window)), blocks, groups, True), positives)
    near = stored(near.select("anchor", F.col("rank").cast("long").alias("window"), F.col("id").alias("positive_id"),
                              F.col("score").alias("positive_score")), "positives")

    # the smallest and largest whole scores within the two shares of the positive's score
    # (decimals: a share of a long may not fit one)
    share = F.col("positive_score").cast("decimal(24,0)")
    bounds = F.struct(F.ceil(share * low / 100).cast("long").alias("low"),
                      F.floor(share * high / 100).cast("long").alias("high"), F.lit(negatives).alias("wanted"))
    asked = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("window", bounds.alias("w")))).alias("ws"))
    asked = asked.select("anchor", F.transform("ws", lambda x: x["w"]).cast(window).alias("windows"))
    asked = anchors.join(asked, F.col("row") == F.col("anchor"))
    hard = _first(_search(rows, asked, blocks, groups, False), negatives)
    return hard.withColumnRenamed("id", "negative_id").join(near, ["anchor", "window"]) \
        .join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor") \
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
                F.col("score").alias("negative_score"))
