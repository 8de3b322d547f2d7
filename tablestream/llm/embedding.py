"""Embedding near-duplicates by an exact metric range join.

Equal vectors are one point with a weight.  Every point belongs to the cell of its nearest pivot, on
the unit sphere with straight-line distance, where a cosine limit is a radius ``r``.  A point is also
copied to an earlier cell if a partner could lie there: by the triangle inequality only if that pivot
is at most ``2r`` further away, and only if the plane between both pivots is within ``r``.  So cells
join independently and every pair is met once.  A cell is joined in pairs of blocks of at most
``BLOCK`` points; a task returns, per point, the weight it links to and the smallest point of its
local component, never pairs.

The pivots are a sample of at most ``MAX_PIVOTS`` points by hash, one per ``PIVOT_POINTS``; any choice
gives the same result.  Where vectors do not cluster, a radius of this size reaches most cells and the
work is that of all pairs of blocks.

Vectors that are null, zero or hold null or non-finite components link with nothing, as do rows with
a null id (whose component is null); vectors of different length never link.  Repeated rows count as
links of each other.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .graph import components

BLOCK = 4096
PIVOT_POINTS = 4096
MAX_PIVOTS = 256


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, without overflow."""
    v = vectors / np.abs(vectors).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _matrix(col, dim: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.asarray(col.flatten(), np.float64).reshape(-1, dim)


def copies(x: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each row, and a mask of the earlier cells that get a copy."""
    dots = x @ pivots.T
    home = dots.argmax(1)
    own = dots[np.arange(len(x)), home]
    dist = np.sqrt(np.maximum(0, 2 - 2 * dots))
    triangle = dist <= np.sqrt(np.maximum(0, 2 - 2 * own))[:, None] + 2 * radius
    apart = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))[home]
    plane = own[:, None] - dots <= radius * apart
    return home, triangle & plane & (np.arange(len(pivots))[None, :] < home[:, None])


def _assigned(points: DataFrame, dim: int, pivots: np.ndarray, radius: float) -> DataFrame:
    """One row per point and cell it takes part in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 2048):
                part = batch.slice(a, 2048)
                home, mask = copies(unit(_matrix(part.column("v"), dim)), pivots, radius)
                row, cell = np.nonzero(mask)
                rows = np.concatenate([np.arange(len(part)), row])
                cells = np.concatenate([home, cell])
                side = np.repeat([0, 1], [len(part), len(row)]).astype(np.int32)
                got = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([got.column("id"), got.column("n"), got.column("v"),
                                                  pa.array(cells.astype(np.int32)), pa.array(side)],
                                                 ["id", "n", "v", "cell", "side"])
    return points.mapInArrow(run, "id long, n long, v array<double>, cell int, side int")


def _labels(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id each point reaches inside the block pair (``linked`` is symmetric)."""
    label, big = ids.copy(), np.iinfo(np.int64).max
    while True:
        new = label.copy()
        for a in range(0, len(label), 512):
            near = np.where(linked[a:a + 512], label[None, :], big).min(1)
            new[a:a + 512] = np.minimum(new[a:a + 512], near)
        if (new == label).all():
            return label
        label = new


def _joined(assigned: DataFrame, dim: int, least: float) -> DataFrame:
    """Links of each point found in each pair of blocks."""
    sizes = assigned.groupBy("cell").agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.when(F.col("side") == 0, 1)) / BLOCK)).cast("int").alias("own"),
        F.ceil(F.count(F.when(F.col("side") == 1, 1)) / BLOCK).cast("int").alias("rep"))
    rows = assigned.join(F.broadcast(sizes), "cell")  # one row per pivot: at most MAX_PIVOTS
    block = F.pmod(F.xxhash64("id"), F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("rep"))).cast("int")

    def pair(i, j, kind):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(kind).alias("kind"))

    def each(n):
        return F.filter(F.sequence(F.lit(0), n), lambda t: t < n)

    b = F.col("block")
    rows = rows.withColumn("block", block).withColumn("task", F.explode(F.when(
        F.col("side") == 0, F.concat(F.transform(each(F.col("own")), lambda t: pair(F.least(b, t), F.greatest(b, t), 0)),
                                     F.transform(each(F.col("rep")), lambda t: pair(b, t, 1))))
        .otherwise(F.transform(each(F.col("own")), lambda t: pair(t, b, 1)))))

    def run(table: pa.Table) -> pa.Table:
        kind, i, j = (table.column(c)[0].as_py() for c in ("kind", "i", "j"))
        x, ids = unit(_matrix(table.column("v"), dim)), table.column("id").to_numpy()
        n, side, block = (table.column(c).to_numpy() for c in ("n", "side", "block"))
        left = side == 0 if kind else block == i
        right = ~left if kind else block == j
        a, c = np.nonzero(left)[0], np.nonzero(right)[0]
        links, hit = np.zeros(len(ids), np.int64), []
        for s in range(0, len(a), 512):
            r, q = np.nonzero(x[a[s:s + 512]] @ x[c].T >= least)
            p, q = a[s:s + 512][r], c[q]
            keep = p != q
            p, q = p[keep], q[keep]
            np.add.at(links, p, n[q])
            if kind or i != j:
                np.add.at(links, q, n[p])
            hit.append(np.stack([p, q]))
        hit = np.concatenate(hit, 1) if hit else np.zeros((2, 0), np.int64)
        used, at = np.unique(hit, return_inverse=True)
        at = at.reshape(hit.shape)
        linked = np.zeros((len(used), len(used)), bool)
        linked[at[0], at[1]] = linked[at[1], at[0]] = True
        return pa.table({"id": ids[used], "links": links[used], "label": _labels(linked, ids[used])})

    rows = rows.select("id", "n", "v", "side", "block", "cell", "task.i", "task.j", "task.kind")
    return rows.groupBy("cell", "i", "j", "kind").applyInArrow(run, "id long, links long, label long")


def near_duplicates(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    fine = (F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
            & F.exists("v", lambda x: x != 0) & F.col("id").isNotNull())
    usable = rows.filter(F.coalesce(fine, F.lit(False)))
    points = stored(usable.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("n")), "points")
    radius = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-7
    links = None
    for r in points.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect():
        dim = r["d"]
        own = points.filter(F.size("v") == dim)
        wanted = min(MAX_PIVOTS, r["n"] // PIVOT_POINTS + 1)
        sample = own.select("v").orderBy(F.xxhash64("id", F.lit(4))).limit(wanted).collect()
        pivots = unit(np.array([p["v"] for p in sample], float))
        part = _joined(stored(_assigned(own, dim, pivots, radius), "assigned"), dim, least)
        links = part if links is None else links.unionAll(part)
    if links is None:
        found = points.select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component")).limit(0)
    else:
        links = stored(links, "links")
        parts = components(links.select(F.col("id").alias("a"), F.col("label").alias("b")))
        found = (links.groupBy("id").agg(F.sum("links").alias("links"))
                 .join(parts.withColumnRenamed("node", "id"), "id", "left"))
    classes = stored(points.join(found, "id", "left").select(
        "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id")), "classes")
    mine = rows.withColumn("key", F.when(F.coalesce(fine, F.lit(False)), F.col("v")))
    return (mine.join(classes.withColumnRenamed("v", "key"), "key", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))
