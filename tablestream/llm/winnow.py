"""Document fingerprints by winnowing, with built-in functions only.

A text's words (stretches without ASCII white space) are hashed, every run of ``k`` words gets a hash,
and of every ``w`` consecutive run hashes the smallest is kept, the rightmost on ties, with its
position.  So two texts that share ``k + w - 1`` words in a row share a kept hash, and a kept hash
depends on its window alone.  A text of fewer than ``k`` words has one hash for all of them; a text
without words has an empty fingerprint.

``next_document`` pairs every row with the next one by id without a global sort: ids are cut into
ranges at approximate quantiles, each range is one window partition, and the first row of the
following range stands in at its end.

Null text counts as empty; null ids come first; rows with one id follow each other by a hash of
their text; extra columns are ignored; an empty table gives no rows; a single row is its own next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import utf8

K = 4
W = 8
RANGE_ROWS = 1024  # rows of a range of ids, about
MAX_RANGES = 16384  # bound of the list of range limits; beyond it ranges hold more rows
SPACE = r"[ \t-\r]+"


def run_hashes(text: Column, k: int) -> Column:
    """Hash of every run of ``k`` words."""
    return F.transform(F.array(text), lambda t: _runs(F.filter(F.split(t, SPACE), lambda x: x != ""), k))[0]


def _runs(words: Column, k: int) -> Column:
    return F.transform(F.array(F.transform(words, lambda x: F.xxhash64(x))), lambda h: F.when(
        F.size(h) >= k,
        F.transform(F.slice(h, F.lit(1), F.size(h) - (k - 1)),
                    lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, k)])),
    ).when(F.size(h) > 0, F.array(F.xxhash64(F.array_join(h.cast("array<string>"), " "))))
        .otherwise(F.array().cast("array<bigint>")))[0]


def kept_positions(hashes: Column, w: int) -> Column:
    """Positions of the window minima, rightmost on ties.

    A hash is the minimum of some window exactly if the neighbours it beats, larger or equal ones to
    the left and larger ones to the right, fill a window together with it.
    """
    def beaten(x: Column, p: Column, step: int) -> Column:
        if w == 1:
            return F.lit(0)
        n = None
        for j in range(1, w):
            other = F.get(hashes, p + step * j)
            stop = F.coalesce(other < x if step < 0 else other <= x, F.lit(True))
            n = F.when(stop, j - 1) if n is None else n.when(stop, j - 1)
        return n.otherwise(w - 1)

    need = F.least(F.lit(w), F.size(hashes)) - 1
    marks = F.transform(hashes, lambda x, p: F.when(beaten(x, p, -1) + beaten(x, p, 1) >= need, p))
    return F.array_compact(marks)


def fingerprint(df: DataFrame, text_col: str, prefix: str, k: int = K, w: int = W) -> DataFrame:
    """Adds ``<prefix>_hashes`` (kept hashes) and ``<prefix>_positions`` (their first words)."""
    runs, positions, hashes = (f"{prefix}_{x}" for x in ("runs", "positions", "hashes"))
    return (df.withColumn(runs, run_hashes(F.col(text_col), k))
            .withColumn(positions, kept_positions(F.col(runs), w))
            .withColumn(hashes, F.transform(positions, lambda p: F.get(F.col(runs), p)))
            .drop(runs))


def as_string(hashes: str, positions: str) -> Column:
    return F.array_join(F.zip_with(hashes, positions, lambda h, p: F.concat(
        F.hex(h), F.lit("@"), p.cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two sets of kept hashes; two empty ones are alike."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def _range_of(id_col: Column, limits: list) -> Column:
    """Number of the id's range: two short searches in the sorted limits."""
    if not limits:
        return F.lit(0)
    step = max(1, int(len(limits) ** 0.5))
    coarse = limits[::step]
    fine = [limits[i:i + step] for i in range(0, len(limits), step)]
    at = F.size(F.filter(F.array(*map(F.lit, coarse)), lambda b: b <= id_col))
    within = F.get(F.array(*[F.array(*map(F.lit, f)) for f in fine]), at - 1)
    return F.when(id_col.isNull() | (at == 0), 0).otherwise(
        (at - 1) * step + F.size(F.filter(within, lambda b: b <= id_col)))


def next_document(rows: DataFrame, cols: list[str], derive: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Adds ``next_<col>`` of the row that follows by ``(id, tie)``; the last row's next is the first.

    ``rows`` has ``id``, ``tie`` (a hash that orders rows of one id) and ``text``; ``derive`` adds the
    other columns named in ``cols``.
    """
    total = rows.count()
    n = min(MAX_RANGES, total // RANGE_ROWS + 1)
    limits = []
    if n > 1:
        at = rows.select(F.percentile_approx("id", [i / n for i in range(1, n)], 20 * n)).first()[0]
        limits = sorted(set(at or []))
    ranged = rows.withColumn("range", _range_of(F.col("id"), limits))
    # first row of every range that has rows, as a last row of the range before it
    firsts = ranged.groupBy("range").agg(F.min(F.struct("id", "tie")).alias("first"))
    w = Window.orderBy("range")  # one row per range: at most MAX_RANGES
    firsts = firsts.select("first", F.coalesce(F.lag("range").over(w), F.max("range").over(
        w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("before"))
    # at most MAX_RANGES rows of three numbers: a proven bound
    heads = (rows.alias("r").join(F.broadcast(firsts).alias("f"), F.col("r.id").eqNullSafe(F.col("f.first.id")) &
                                  (F.col("r.tie") == F.col("f.first.tie")))
             .groupBy("f.before").agg(F.first("r.text").alias("text")))
    ends = derive(heads).select(F.lit(None).cast(rows.schema["id"].dataType).alias("id"), F.lit(0).cast("long").alias("tie"),
                        *cols, F.col("before").alias("range"), F.lit(True).alias("end"))
    both = derive(ranged).select("id", "tie", *cols, "range", F.lit(False).alias("end")).unionByName(ends)
    order = Window.partitionBy("range").orderBy("end", "id", "tie")
    return both.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in cols]).filter(~F.col("end"))


def compare_with_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                        w: int = W) -> DataFrame:
    """Fingerprints of every text and of its edited text (the last quarter replaced by the start of
    the next document), with the likeness of both and of neighbouring documents."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pairs = next_document(rows.withColumn("tie", F.xxhash64("text")), ["text", "own_hashes", "own_positions"],
                          lambda df: fingerprint(df, "text", "own", k, w))
    n, cut = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    pairs = pairs.withColumn("edited", F.concat(F.left("text", n - cut), F.left("next_text", cut)))
    pairs = pairs.select("id", n.cast("long").alias("n_chars"), "edited", "own_hashes", "own_positions",
                         "next_own_hashes")
    out = fingerprint(pairs, "edited", "edited", k, w)
    return out.select(
        F.col("id").alias(id_col), "n_chars", F.sha2(utf8(F.col("edited")), 256).alias("edited_sha256"),
        as_string("own_hashes", "own_positions").alias("fingerprint"),
        as_string("edited_hashes", "edited_positions").alias("edited_fingerprint"),
        likeness(F.col("own_hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("own_hashes"), F.col("next_own_hashes")).alias("near_next"))
