"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays, passages
that occur elsewhere are cut out, and what is left is packed into token sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept; its result
is written as Parquet in the shared folder and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.  Documents are told apart by ``doc_id`` and text: equal rows
count as copies, and one of them stays.  Missing and repeated ids are allowed; null and empty texts
are nobody's copy and are packed as their end token; texts of any length are read whole; columns beyond
those of ``documents`` are dropped; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.llm import minhash, packing, rlz, toxicity
from tablestream.llm.common import stored
from tablestream.llm.queries import table, tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _chosen(rows: DataFrame, picked: DataFrame, how: str) -> DataFrame:
    """Rows joined to a stage's decisions by id and text."""
    same = rows["doc_id"].eqNullSafe(picked["doc_id"]) & (F.xxhash64(F.coalesce(rows["text"], F.lit(""))) == picked["text_hash"])
    return rows.join(picked, same, how)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    rows = docs.select(COLUMNS)
    bad = toxicity.score(rows, table(spark, sf_dir, "labels")).filter("predicted = 1").select("doc_id", "text_hash").distinct()
    return _chosen(rows, stored(bad, "toxic"), "left_anti")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group with shingles of five words 0.8 alike or
    more.  Where the smallest id is missing or repeated, the text hash decides; of equal rows one stays."""
    rows = docs.select(COLUMNS)
    kept = minhash.near_duplicates(rows, words=5, num=80, den=100).filter("survivor").select("doc_id", "text_hash").distinct()
    left = _chosen(rows, stored(kept, "kept"), "left_semi")
    return left.dropDuplicates(["doc_id", "text"])


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows of 35 words that also start elsewhere.  Texts with nothing to cut stay
    as they are; a document of which nothing is left goes."""
    rows = docs.select(COLUMNS)
    cut = rlz.repeated_passages(rows).filter("n_removed > 0").select("doc_id", "text_hash", "kept").distinct()
    named = _chosen(rows, stored(cut, "cut"), "left")
    return named.filter("kept is null or kept <> ''").select(
        rows["doc_id"], F.coalesce("kept", "text").alias("text"), "lang", "source",
        F.when(F.col("kept").isNull(), F.col("n_chars")).otherwise(F.length("kept")).cast("long").alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048, one row per piece."""
    return packing.pack(docs.select(COLUMNS), tokenizer("byte_bpe_50k.json")).drop("ids")


STAGES = [("toxicity", reject_toxic), ("minhash_near_dedup", drop_near_copies), ("substring_dedup", cut_passages),
          ("packing", pack_sequences)]

# No stage but the last two could be said in SQL, and those need a tokenizer: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
