"""Sharding by fixed virtual slots.

Records hash into a fixed number of slots, bytes are summed per slot, and a stored, versioned map says
which shard owns each slot.  Version 1 deals the slots round robin; ``rebalance`` loads the newest
version, edits it so that bytes come out near equal, for the same or another number of shards, and
stores it as the next one.  A version is never overwritten, so of two edits of one version the second
fails.  Only the slot table (its size is a parameter, not the data's) ever reaches the driver; records
are hashed, counted and joined on the executors.

Null text counts as empty; a null id hashes as a value of its own; extra columns are ignored; an empty
table gives no rows.  Rows of a missing or repeated id that together exceed a slot's fair share are dealt
over all slots instead, so neither a shard nor a slot's window depends on them; other repeated rows share a
slot.  Each row keeps a place of its own.  Texts of any length count with all their bytes, in one piece.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_path, stored, unsigned_crc32, utf8

N_SLOTS = 8192
OVERHEAD = 16  # bytes that every record takes besides its text


def rebalanced(owner: dict[int, int], weight: dict[int, int], n_shards: int) -> dict[int, int]:
    """Edit a slot map so that shard weights come out near equal.

    Shards give up slots, largest first, until none holds more than the mean; the freed slots then
    go, largest first, to whichever shard is lightest.  Slots that fit where they are stay.
    """
    mean = sum(weight.values()) / n_shards
    load = [0] * n_shards
    moved, out = [], {}
    for slot in sorted(owner, key=lambda s: (-weight.get(s, 0), s)):
        w, shard = weight.get(slot, 0), owner[slot]
        # keep a reserve of a few per cent for the small slots that even out the rest
        if shard < n_shards and load[shard] + w <= 0.97 * mean:
            out[slot] = shard
            load[shard] += w
        else:
            moved.append(slot)
    heap = [(x, i) for i, x in enumerate(load)]
    heapq.heapify(heap)
    for slot in moved:
        x, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (x + weight.get(slot, 0), shard))
    return out


def slotted(docs: DataFrame, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored records ``id``, ``size``, ``crc`` and ``vslot``: a record's slot never changes again."""
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(OVERHEAD)).cast("long").alias("size"),
        unsigned_crc32(utf8(text)).alias("crc"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    # ids above a fair share are fewer than the slots, so the list may be broadcast
    hot = stored(rows.groupBy("id").agg(F.count("*").alias("k"), F.sum("size").alias("b"))
                 .filter((F.col("k") > 1) & (F.col("b") * n_slots > total)).select(F.col("id").alias("hot_id"), F.lit(True).alias("hot")), "hot")
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).join(
        F.broadcast(hot), F.col("id").eqNullSafe(F.col("hot_id")), "left")
    slot = F.when(F.col("hot"), F.pmod(F.xxhash64(F.spark_partition_id()) + F.col("row"), F.lit(n_slots))).otherwise(
        F.pmod(F.xxhash64("id"), F.lit(n_slots)))
    return stored(dealt.select("id", "size", "crc", slot.cast("int").alias("vslot")), "records")


def _sums(rows: DataFrame) -> dict[int, tuple[int, int]]:
    return {r["vslot"]: (r["n"], r["b"]) for r in
            rows.groupBy("vslot").agg(F.count("*").alias("n"), F.sum("size").alias("b")).collect()}


def _store(rows: DataFrame, path: str, version: int, owner: dict[int, int], sums: dict[int, tuple[int, int]]) -> None:
    table = [(s, owner[s], *sums.get(s, (0, 0))) for s in sorted(owner)]
    rows.sparkSession.createDataFrame(table, "virtual_slot int, shard int, rows long, bytes long").coalesce(1).write.parquet(
        f"{path}/version={version}")


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """All versions: ``version``, ``virtual_slot``, ``shard``, ``rows``, ``bytes``."""
    return spark.read.schema("virtual_slot int, shard int, rows long, bytes long, version int").parquet(path).select(
        "version", "virtual_slot", "shard", "rows", "bytes")


def start_map(rows: DataFrame, path: str, n_shards: int, n_slots: int = N_SLOTS) -> None:
    """Version 1 of a slot map: slots dealt round robin."""
    _store(rows, path, 1, {s: s % n_shards for s in range(n_slots)}, _sums(rows))


def rebalance(rows: DataFrame, path: str, n_shards: int) -> int:
    """Edit the newest version of the map for the bytes of ``rows`` and store it as the next; its number."""
    slot_map = read_map(rows.sparkSession, path)
    newest = slot_map.agg(F.max("version")).first()[0]
    owner = {r["virtual_slot"]: r["shard"] for r in slot_map.filter(F.col("version") == newest).collect()}
    sums = _sums(rows)
    _store(rows, path, newest + 1, rebalanced(owner, {s: b for s, (_, b) in sums.items()}, n_shards), sums)
    return newest + 1


def placed(rows: DataFrame, path: str, version: int, id_col: str = "doc_id") -> DataFrame:
    """Records with their ``shard`` and ``place`` (0, 1, ... in the shard) by one version of the map."""
    # where each slot's rows begin inside its shard
    w = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = (read_map(rows.sparkSession, path).filter(F.col("version") == version)
              .select("virtual_slot", "shard", F.coalesce(F.sum("rows").over(w), F.lit(0)).alias("base")))
    in_slot = Window.partitionBy("vslot").orderBy("id", "size", "crc")
    ranked = rows.withColumn("nth", F.row_number().over(in_slot) - 1)
    return (ranked.join(F.broadcast(starts), ranked["vslot"] == starts["virtual_slot"])  # n_slots rows
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
                    "virtual_slot", "shard", (F.col("base") + F.col("nth")).alias("place")))


def shard(docs: DataFrame, n_shards: int, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text",
          map_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(records, slot_map)``: records as ``placed`` gives them by a map started and rebalanced once in
    ``map_path`` (a fresh folder by default), and all versions of that map."""
    spark = docs.sparkSession
    path = map_path or shared_path(spark, "slot_map")
    rows = slotted(docs, n_slots, id_col, text_col)
    start_map(rows, path, n_shards, n_slots)
    return placed(rows, path, rebalance(rows, path, n_shards), id_col), read_map(spark, path)
