"""Dedupe and upsert by key with a monotone sequence.

Semantics (per key):

* inside a batch the row with the highest ``_sdc_sequence`` wins; a NULL
  sequence sorts first (it wins), ties go to the later position (Q12);
* a stored row is replaced when ``batch.seq >= stored.seq``; an older batch
  row is ignored; unseen keys insert; NULL keys never match, so (after the
  in-batch dedupe, where NULL keys form one group) they always insert.

Where batches are appended and resolved when they are read, :func:`resolve` applies the same rules over
all commits of a key, and :func:`children_of` takes the children of the chosen root rows.

Plan shape, chosen for scale:

* the dedupe is ``groupBy(keys).agg(max_by(row, order))`` - partial
  aggregation before the shuffle, so a key holding a third of the batch
  costs one row per map task, not one huge window partition;
* the upsert is *one* full-outer join on keys that are unique on both sides
  after the dedupe (NULL keys included: they are one group there), so no key
  is skewed and the batch is read once;
* children joined to their parents are split where one parent holds much of all rows
  (:func:`split_hot`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.tables import SEQUENCE

POS = "_pos"
COMMIT = "_commit"
SALT = "__salt"


def newer_first(seq: Column, pos: Column | None) -> Column:
    """Order of rows of one key inside a batch: NULL sequence last (it wins), then by sequence, then by
    position."""
    parts = [seq.isNull(), F.coalesce(seq, F.lit(0).cast("bigint"))]
    return F.struct(*parts, *([pos] if pos is not None else []))


def _order(seq: str, pos: str | None) -> Column:
    return newer_first(F.col(seq), F.col(pos) if pos else None)


def latest_per_key(df: DataFrame, keys: list[str], seq: str = SEQUENCE, pos: str | None = None) -> DataFrame:
    """One row per key (``keys`` may include level ids) - the newest one."""
    cols = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in cols])
    out = df.groupBy(*keys).agg(F.max_by(packed, _order(seq, pos)).alias("__row"))
    return out.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in cols]).select(*df.columns)


def _key_match(keys: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])


def _null_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def replaceable_keys(cur: DataFrame, inc: DataFrame, keys: list[str], seq: str = SEQUENCE) -> DataFrame:
    """Keys whose stored row is replaced (deduped batch row with ``seq >=`` stored)."""
    i = inc.select(*keys, seq).alias("i")
    c = cur.select(*keys, seq).alias("c")
    cond = _key_match(keys, "i", "c") & (F.col(f"i.{seq}") >= F.col(f"c.{seq}"))
    return i.join(c, cond, "left_semi").select(*keys).distinct()


def insert_new_keys(cur: DataFrame, inc: DataFrame, keys: list[str], seq: str = SEQUENCE) -> DataFrame:
    """J2+J3: deduped batch rows to insert = key absent after the delete."""
    gone = replaceable_keys(cur, inc, keys, seq)
    kept = cur.select(*keys).join(gone, keys, "left_anti")
    return inc.join(kept, keys, "left_anti")


def upsert(cur: DataFrame, inc: DataFrame, keys: list[str], seq: str = SEQUENCE,
           pos: str | None = None, with_action: bool = False) -> DataFrame:
    """M1: stored table + batch -> new table (newer-or-equal replaces).

    ``cur`` and ``inc`` have the same columns (evolve first).  ``inc`` is
    deduped here.  With ``with_action`` a column ``_action`` tells
    ``kept`` / ``replaced`` / ``inserted``.
    """
    cols = [c for c in cur.columns if c != pos]
    # After the dedupe all NULL-key rows of the batch are one group (one
    # survivor), so they cannot skew the join; NULL never equals NULL, so the
    # survivor comes out unmatched and is inserted.
    inc_d = latest_per_key(inc, keys, seq, pos).select(*cols)
    rest = [c for c in cols if c not in keys]
    c = cur.select(*keys, F.struct(*rest).alias("__c"))
    i = inc_d.select(*keys, F.struct(*rest).alias("__i"))
    j = c.join(i, keys, "full_outer")
    take_i = F.col("__i").isNotNull() & (F.col("__c").isNull() |
                                         (F.col(f"__i.{seq}") >= F.col(f"__c.{seq}")))
    row = F.when(take_i, F.col("__i")).otherwise(F.col("__c"))
    merged = j.select(*keys, row.alias("__r"), take_i.alias("__take"), F.col("__c").isNotNull().alias("__had"))
    out = merged.select(*keys, *[F.col(f"__r.{x}").alias(x) for x in rest], "__take", "__had")
    if with_action:
        act = F.when(~F.col("__take"), "kept").when(F.col("__had"), "replaced").otherwise("inserted")
        out = out.withColumn("_action", act)
    return out.drop("__take", "__had").select(*cols, *(["_action"] if with_action else []))


def parent_decisions(cur_root: DataFrame, inc_root: DataFrame, keys: list[str], seq: str = SEQUENCE,
                     pos: str | None = None) -> DataFrame:
    """Keys whose batch row wins at the root, with the winning sequence.

    ``_sdc_source_key_<k>`` naming is used so child tables can join on it.
    """
    inc_d = latest_per_key(inc_root.select(*keys, seq, *([pos] if pos else [])), keys, seq, pos)
    c = cur_root.select(*keys, F.col(seq).alias("__cseq"))
    j = inc_d.filter(~_null_key(keys)).join(c, keys, "left")
    win = j.filter(F.col("__cseq").isNull() | (F.col(seq) >= F.col("__cseq")))
    extra = [F.col(pos).alias("__win_pos")] if pos else []
    return win.select(*[F.col(k).alias(f"_sdc_source_key_{k}") for k in keys], F.col(seq).alias("__win_seq"),
                      *extra)


def resolve(rows: DataFrame, keys: list[str], seq: str = SEQUENCE, null_keys: bool = False) -> DataFrame:
    """M1 over appended commits: the row of each key that a row of batches, upserted one by one, leaves.

    ``rows`` hold at most one row per key and ``_commit`` (commits sort in the order they were made).
    A later row replaces when its sequence is at least the stored one; a later NULL sequence never
    replaces; a key whose first row has a NULL sequence keeps that row.  With ``null_keys`` rows with a
    NULL in their key are kept as they are (they match nobody).  One aggregate: a key written by many
    commits is combined before the shuffle.
    """
    rest = [c for c in rows.columns if c not in keys]
    row, s, commit = F.struct(*[F.col(c) for c in rest]), F.col(seq), F.col(COMMIT)
    known = rows.filter(~_null_key(keys)) if null_keys else rows
    best = known.groupBy(*keys).agg(
        F.min(F.struct(commit, s.isNull().alias("unset"))).alias("__first"),
        F.max_by(F.when(s.isNotNull(), row), F.when(s.isNotNull(), F.struct(s, commit))).alias("__newest"),
        F.min_by(F.when(s.isNull(), row), F.when(s.isNull(), commit)).alias("__unset"))
    pick = F.when(F.col("__first.unset"), F.col("__unset")).otherwise(F.col("__newest"))
    out = best.select(*keys, pick.alias("__row")).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])
    out = out.select(*rows.columns)
    return out.unionByName(rows.filter(_null_key(keys))) if null_keys else out


def split_hot(left: DataFrame, right: DataFrame, keys: list[str], total: int | None = None,
              share: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on ``keys`` with a column ``__salt`` to join on as well.

    A key is hot if it holds more than one of ``share`` parts of the rows of ``left`` (default: four
    parts a shuffle partition).  Its rows are dealt over as many salts as it holds parts, by a hash of
    the whole row, and its row on the right is repeated for each salt; other keys have salt 0.  There
    are fewer than ``share`` hot keys, whatever the data, so their list may be broadcast.  ``right`` has
    one row per key; ``total`` saves counting ``left``.
    """
    parts = share or 4 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = max(1, (left.count() if total is None else total) // parts)
    hot = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > part)
    hot = F.broadcast(hot.select(*keys, F.ceil(F.col("__n") / part).cast("int").alias("__parts")))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.col("__parts")).cast("int")
    salted = left.join(hot, keys, "left").select(*left.columns, F.coalesce(spread, F.lit(0)).alias(SALT))
    last = F.coalesce(F.col("__parts"), F.lit(1)) - 1
    repeated = right.join(hot, keys, "left").select(*right.columns, F.explode(F.sequence(F.lit(0), last)).alias(SALT))
    return salted, repeated


def children_of(kids: DataFrame, chosen: DataFrame, kid_keys: list[str], root_keys: list[str],
                total: int | None = None) -> DataFrame:
    """M2 over appended commits: the children written by the commit whose root row was chosen."""
    want = chosen.select(*[F.col(r).alias(k) for k, r in zip(kid_keys, root_keys)], F.col(COMMIT).alias("__chosen"))
    kids, want = split_hot(kids, want, kid_keys, total)
    out = kids.join(want, [*kid_keys, SALT]).filter(F.col(COMMIT) == F.col("__chosen"))
    return out.drop(SALT, "__chosen")


def upsert_children(cur: DataFrame, inc: DataFrame, parent_keys: list[str], levels: list[str],
                    decisions: DataFrame | None = None, seq: str = SEQUENCE,
                    mode: str = "sync", pos: str = "pos", hot: bool = False) -> DataFrame:
    """M2: upsert a child table.

    ``parent_keys`` are the ``_sdc_source_key_*`` columns.  ``mode="sync"``
    (default) follows the parent: every stored child of a parent whose batch
    row won is dropped, and only the children of that winning row are
    inserted (fixes Q1, Q2, Q18).  ``mode="legacy"`` dedupes on
    ``parent keys + levels`` and upserts like a root table.  ``hot`` counts the
    children of each parent and splits parents that hold much of all rows.
    """
    if mode == "legacy":
        return upsert(cur, inc, parent_keys + levels, seq, pos=pos if pos in inc.columns else None)
    if decisions is None:
        raise ValueError("sync mode needs the parent decisions (see parent_decisions)")

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        if not hot:
            return left.join(right, parent_keys, how)
        left, right = split_hot(left, right, parent_keys)
        return left.join(right, [*parent_keys, SALT], how).drop(SALT)

    new_kids = joined(inc, decisions, "inner").filter(F.col(seq).eqNullSafe(F.col("__win_seq")))
    if "__win_pos" in decisions.columns and pos in inc.columns:
        # equal sequences: only the children of the winning record (its position)
        new_kids = new_kids.filter(F.col(pos) == F.col("__win_pos"))
    new_kids = new_kids.drop("__win_seq", "__win_pos")
    new_kids = latest_per_key(new_kids, parent_keys + levels, seq)
    kept = joined(cur, decisions.select(*parent_keys), "left_anti")
    return kept.unionByName(new_kids.select(*cur.columns))


def upsert_stats(merged_with_action: DataFrame) -> DataFrame:
    """Counts of kept / replaced / inserted rows."""
    return merged_with_action.groupBy("_action").agg(F.count("*").alias("n"))


def late_rows(cur: DataFrame, inc: DataFrame, keys: list[str], seq: str = SEQUENCE) -> DataFrame:
    """Deduped batch rows older than the stored row of their key (ignored by the upsert)."""
    i = inc.alias("i")
    c = cur.select(*keys, seq).alias("c")
    cond = _key_match(keys, "i", "c") & (F.col(f"i.{seq}") < F.col(f"c.{seq}"))
    return i.join(c, cond, "left_semi")
