"""Near-duplicate documents by bottom-k sketches.

One hash function gives every word shingle a value; a document's sketch is its ``SKETCH`` smallest.
Documents with equal sets are one class (by a 128-bit digest of the set).  Inverted lists of the
retained values bring classes together: two sets over the limit share at least ``SHARED`` of their
retained values (a miss has a chance of about 1e-8 at a limit of 0.85 and 1e-6 at 0.8), so it is enough to list, for
each class, its rarest values and leave out the ``SHARED - 1`` most frequent ones.  Standing passages,
whose values are frequent, thus bring nobody together unless they are most of the text.

Pairs are made without listing a group's pairs: each list compares its members with its hub, the
member with the most common values.  Only lists that still hold several components after that are
compared across components: pair by pair where few are open, else in blocks of members whose tasks
return only what connects components.  A pair must agree in size, then in the bottom-k of the union of both
sketches, and at last in the exact likeness of the full sets.

Words are stretches without ASCII white space, A-Z in lower case; a text with fewer words than a
shingle has its whole sequence as one.  Null texts and texts without words have empty sets and link
with nothing.  Rows with a null id take part like any other (their component is the smallest id they
reach, or null) and are never kept in place of a row with an id.  Repeated rows share their class.
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, gram_hashes, slices, stored, worker_memory
from .graph import components

SKETCH = 32
SHARED = 14
PAIRS = 20_000  # a hub's group with more open pairs is compared in blocks
BLOCK = 512


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes (signed 64-bit)."""
    split = text.encode().lower().split()
    if not split:
        return np.zeros(0, np.int64)
    h = worker_memory("minhash", lambda: WordHashes(3)).of(split)
    return np.unique(gram_hashes(h, min(words, len(h))).view(np.int64))


def needed(size: np.ndarray | int, num: int, den: int):
    """Retained values that two linked sets share, by the smaller set."""
    return np.minimum(SHARED, -(-num * np.minimum(size, SKETCH) // den))


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """id, row key, set size, set digest and sketch of every row with a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                sets = [shingle_set(t, words) for t in texts[a:b]]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("th"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(s) if len(s) else None for s in sets], pa.binary()),
                     pa.array([s[:SKETCH] for s in sets], pa.list_(pa.int64()))],
                    ["id", "th", "size", "cls", "sketch"])
    return docs.mapInArrow(run, "id long, th long, size long, cls binary, sketch array<long>")


def listed(classes: DataFrame, num: int, den: int) -> DataFrame:
    """Inverted lists: ``value, cls, size, common``, the rarest values of each class.

    ``common`` sums how often the class's values occur: high for a group's centre.
    """
    entries = classes.select("cls", "size", F.explode("sketch").alias("value"))
    often = entries.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    shared = entries.join(often, "value")
    per = shared.groupBy("cls", "size").agg(
        F.array_sort(F.collect_list(F.struct("df", "value"))).alias("vals"), F.sum("df").alias("common"))
    held = F.least(F.col("size"), F.lit(SKETCH))
    need = F.least(F.lit(SHARED), F.ceil(held * num / F.lit(den)))
    # values of one class alone are the rarest; they use up places without making a list
    places = F.greatest(F.lit(0), F.size("vals") - need + 1).cast("int")
    return per.select("cls", "size", "common", F.explode(F.slice("vals", F.lit(1), places)).alias("e")).select(
        F.col("e.value").alias("value"), "cls", "size", "common")


def alike_sketches(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs ``a, b`` whose sizes and union sketches allow the limit."""
    left = classes.select(F.col("cls").alias("a"), F.col("size").alias("size_a"), F.col("sketch").alias("sketch_a"))
    right = classes.select(F.col("cls").alias("b"), F.col("size").alias("size_b"), F.col("sketch").alias("sketch_b"))
    both = pairs.join(left, "a").join(right, "b").filter(
        F.least("size_a", "size_b") * den >= F.greatest("size_a", "size_b") * num)
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, SKETCH)
    hits = F.size(F.array_intersect(F.array_intersect(union, F.col("sketch_a")), F.col("sketch_b")))
    need = F.least(F.lit(SHARED), F.ceil(F.least(F.greatest("size_a", "size_b"), F.lit(SKETCH)) * num / F.lit(den)))
    return both.filter(hits >= need).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose full sets reach the limit exactly."""
    full = pairs.join(sets.select(F.col("cls").alias("a"), F.col("values").alias("va")), "a").join(
        sets.select(F.col("cls").alias("b"), F.col("values").alias("vb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("va"), batch.column("vb")):
                x, y = (np.frombuffer(v.as_buffer(), np.int64) for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * common >= num * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return full.select("a", "b", "va", "vb").mapInArrow(run, "a binary, b binary")


def linked_in_blocks(groups: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links between components of large groups, from exact comparisons of block with block.

    Members outside the hub's component meet each other and those inside it; members inside are
    already linked and never meet.  A task returns what connects its components, not its pairs.
    """
    def each(n):
        return F.filter(F.sequence(F.lit(0), n), lambda t: t < n)

    def task(i, j, kind):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(kind).alias("kind"))

    own, main = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("others", "mains"))
    rows = groups.withColumn("own", own).withColumn("inside", main)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cls"), F.greatest(F.lit(1), F.when(
        F.col("side") == 0, F.col("own")).otherwise(F.col("inside")))).cast("int"))
    k = F.col("block")
    rows = rows.withColumn("t", F.explode(F.when(F.col("side") == 0, F.concat(
        F.transform(each(F.col("own")), lambda t: task(F.least(k, t), F.greatest(k, t), 0)),
        F.transform(each(F.col("inside")), lambda t: task(k, t, 1))))
        .otherwise(F.transform(each(F.col("own")), lambda t: task(t, k, 1)))))
    full = rows.select("hub", "cls", "component", "side", "block", "t.i", "t.j", "t.kind").join(sets, "cls")

    def run(table: pa.Table) -> pa.Table:
        kind, i, j = (table.column(c)[0].as_py() for c in ("kind", "i", "j"))
        cls, component = table.column("cls").to_pylist(), table.column("component").to_pylist()
        values = [np.frombuffer(v.as_buffer(), np.int64) for v in table.column("values")]
        side, block = table.column("side").to_numpy(), table.column("block").to_numpy()
        left = np.flatnonzero(side == 0 if kind else block == i)
        right = np.flatnonzero(side == 1 if kind else block == j)
        size = np.array([len(v) for v in values])
        flat = np.concatenate([values[r] for r in right] or [np.zeros(0, np.int64)])
        owner = np.repeat(np.arange(len(right)), size[right])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        root = {c: c for c in component}

        def find(c):
            while root[c] != c:
                c = root[c]
            return c

        links = []
        for x in left.tolist():
            lo, hi = np.searchsorted(flat, values[x], "left"), np.searchsorted(flat, values[x], "right")
            n = hi - lo
            at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
            common = np.bincount(owner[at], minlength=len(right))
            for r in np.flatnonzero(den * common >= num * (size[x] + size[right] - common)).tolist():
                y = int(right[r])
                p, q = find(component[x]), find(component[y])
                if p != q:
                    root[max(p, q)] = min(p, q)
                    links.append((min(cls[x], cls[y]), max(cls[x], cls[y])))
        return pa.table({"a": pa.array([p for p, _ in links], pa.binary()), "b": pa.array([q for _, q in links], pa.binary())})

    return full.groupBy("hub", "i", "j", "kind").applyInArrow(run, "a binary, b binary")


def full_sets(docs: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """Whole shingle sets of the given classes, from one row of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("cls").slice(a, b - a),
                     pa.array([shingle_set(t, words).tobytes() for t in texts[a:b]], pa.binary())], ["cls", "values"])

    picked = docs.join(rows, (docs["id"].eqNullSafe(rows["rid"])) & (docs["th"] == rows["rth"])).select("cls", "text")
    return picked.mapInArrow(run, "cls binary, values binary").dropDuplicates(["cls"])


def near_duplicates(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``kept``, ``n_links``, ``text_hash``,
    ``survivor``.

    Links: sets with ``den * |A and B| >= num * |A or B|``.  ``n_links`` counts confirmed comparisons
    of the class, which join the component together; links inside a component are not all made.
    ``survivor`` marks one text of each component, that with the smallest id (null ids last) and then
    text hash, whatever ids are missing or repeated (equal rows share it), and every row with an empty set.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    base = stored(sketches(rows.select("id", "th", "text"), words), "sketches")
    classes = stored(base.filter("size > 0").groupBy("cls").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("row"), F.min("id").alias("least"), F.first("size").alias("size"), F.first("sketch").alias("sketch")),
        "classes")
    lists = stored(listed(classes, num, den), "lists")
    hubs = stored(lists.groupBy("value").agg(F.max(F.struct("common", "cls")).alias("hub"), F.count("*").alias("n"))
                  .filter("n > 1").select("value", F.col("hub.cls").alias("b")), "hubs")
    pairs = _ordered(lists.select("value", F.col("cls").alias("a")).join(hubs, "value"))
    first = stored(alike_sketches(pairs, classes, num, den), "first")

    def sets_of(pairs: DataFrame) -> DataFrame:
        used = pairs.select(F.col("a").alias("cls")).unionAll(pairs.select(F.col("b").alias("cls"))).distinct()
        named = classes.join(used, "cls").select("cls", F.col("row.id").alias("rid"), F.col("row.th").alias("rth"))
        return stored(full_sets(rows, named, words), "sets")

    links = stored(verified(first, sets_of(first), num, den), "links")
    parts = stored(components(links), "parts")
    # lists whose members are not all in one component: compare across components
    lists = stored(lists.join(parts.withColumnRenamed("node", "cls"), "cls", "left")
                   .withColumn("component", F.coalesce("component", "cls")), "labelled")
    mixed = lists.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    hubs = hubs.join(mixed.select("value"), "value").join(parts.withColumnRenamed("node", "b"), "b", "left").select(
        "value", F.col("b").alias("hub"), F.coalesce("component", "b").alias("main"))
    open_lists = stored(lists.select("value", "cls", "size", "component").join(hubs, "value"), "open")
    groups = open_lists.groupBy("hub", "cls").agg(F.first("component").alias("component"), F.first("main").alias("main"))
    groups = stored(groups.withColumn("side", (F.col("component") == F.col("main")).cast("int")), "groups")
    counts = groups.groupBy("hub").agg(F.sum(1 - F.col("side")).alias("others"), F.sum("side").alias("mains"))
    counts = stored(counts.withColumn("large", F.col("others") * (F.col("others") + F.col("mains")) > PAIRS), "counts")
    x = open_lists.join(counts.filter("not large").select("hub"), "hub")
    y = x.alias("y")
    x = x.alias("x")
    across = _ordered(x.join(y, (F.col("x.value") == F.col("y.value")) & (F.col("x.component") < F.col("y.component"))
                             & (F.col("x.size") * den >= F.col("y.size") * num)
                             & (F.col("y.size") * den >= F.col("x.size") * num))
                      .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")))
    second = stored(alike_sketches(across.join(first, ["a", "b"], "left_anti"), classes, num, den), "second")
    more = stored(verified(second, sets_of(second), num, den), "more")
    large = groups.join(counts.filter("large"), "hub")
    sets = sets_of(large.select(F.col("cls").alias("a"), F.col("cls").alias("b")))
    blocks = stored(linked_in_blocks(large, sets, num, den), "blocks")
    more = more.unionAll(blocks)
    every = links.unionAll(more)
    parts = components(every)
    counts = every.select(F.col("a").alias("cls")).unionAll(every.select(F.col("b").alias("cls"))).groupBy("cls").agg(
        F.count("*").alias("n_links"))
    named = classes.select("cls", "row", F.col("least").alias("id")).join(parts.withColumnRenamed("node", "cls"), "cls", "left")
    named = stored(named.withColumn("component", F.coalesce("component", "cls")), "named")
    smallest = named.groupBy("component").agg(F.min("id").alias("component_id"), F.min("row").alias("first"))
    final = stored(named.select("cls", "component").join(smallest, "component").join(counts, "cls", "left")
                   .select("cls", "component_id", "first", F.coalesce("n_links", F.lit(0)).alias("n_links")), "final")
    out = base.select("id", "th", "size", "cls").join(final, "cls", "left")
    return out.select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("th").alias("text_hash"),
        (F.col("first").isNull() | (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("th") == F.col("first.th")))).alias("survivor"),
    ).withColumn("kept", F.when(F.col("component_id").isNull(), F.lit(True)).otherwise(
        F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False))))


def _ordered(pairs: DataFrame) -> DataFrame:
    """Each pair once, smaller first."""
    return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
