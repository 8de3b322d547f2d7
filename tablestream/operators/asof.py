"""As-of lookup: for each row, the latest *mark* before it in the same group.

Used for "schema in force", "first SCHEMA before a RECORD" and bookmarks.
A plain ``last(ignorenulls)`` window partitioned by stream would put a hot
stream (a third of all rows) into one task, so positions are cut into
buckets of ``bucket`` positions:

1. inside a bucket: window over ``(group, bucket)`` - bounded size;
2. across buckets: the last mark of every earlier bucket, computed on a
   bucket-level table (one row per bucket, not per record);
3. an equi-join on ``(group, bucket)`` brings the carry-in to the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.barrier import compute_once

DEFAULT_BUCKET = 1 << 20


def asof_last(rows: DataFrame, marks: DataFrame, by: list[str], pos: str, value: str,
              out: str, bucket: int = DEFAULT_BUCKET, strict: bool = True) -> DataFrame:
    """``rows`` plus column ``out`` = ``value`` of the latest mark with ``mark.pos < row.pos``.

    ``marks`` has columns ``by + [pos, value]``.  With ``strict=False`` a mark
    at the same position counts too.  Ties between marks at one position
    are broken by the larger value; marks without a value are passed over.
    """
    kind = marks.schema[value].dataType
    r = rows.withColumns({"__is_mark": F.lit(False), "__mv": F.lit(None).cast(kind)})
    m = marks.select(*by, F.col(pos), F.col(value).alias("__mv"), F.lit(True).alias("__is_mark"))
    return carry_last(r.unionByName(m, allowMissingColumns=True), by, pos, "__is_mark", "__mv", out, bucket, strict)


def carry_last(both: DataFrame, by: list[str], pos: str, is_mark: str, value: str, out: str,
               bucket: int = DEFAULT_BUCKET, strict: bool = True) -> DataFrame:
    """:func:`asof_last` over one relation that holds rows and marks (told apart by ``is_mark``), such
    as a log that is read and parsed once.  Rows come back without ``is_mark`` and ``value``.

    Rows are shuffled once, by ``(by, bucket)``: the window inside a bucket and the bucket-level table
    both read that shuffle (one-row generators keep column pruning and the join's null filters from
    making two of it), and only the bucket-level table, one row per bucket, is shuffled again.
    """
    ex = both.withColumn("__b", F.floor(F.col(pos) / F.lit(bucket))).repartition(*by, "__b")
    rest = [F.col(f"`{c}`") for c in ex.columns if c not in (*by, "__b")]
    held = ex.select(*by, "__b", F.inline(F.array(F.struct(*rest))))
    tag = F.col(is_mark)
    # 1. within a bucket; marks sort after rows at equal position if strict
    w = Window.partitionBy(*by, "__b").orderBy(F.col(pos), tag.asc() if strict else tag.desc(), F.col(value)) \
              .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = held.withColumn("__in", F.last(value, ignorenulls=True).over(w)).filter(~tag)
    # 2. bucket-level carry: last mark of all earlier buckets
    mark = F.when(tag & F.col(value).isNotNull(), F.struct(F.col(pos), F.col(value)))
    levels = held.groupBy(*by, "__b").agg(F.max(mark)[value].alias("__last"))
    wb = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = levels.select(*by, "__b", F.last("__last", ignorenulls=True).over(wb).alias("__carry"))
    # 3. bring carry-in to rows
    joined = inner.join(compute_once(carry), on=[*by, "__b"], how="left")
    return joined.select(*[F.col(f"`{c}`") for c in both.columns if c not in (is_mark, value, out)],
                         F.coalesce(F.col("__in"), F.col("__carry")).alias(out))


def running_count(rows: DataFrame, by: list[str], pos: str, out: str,
                  bucket: int = DEFAULT_BUCKET, ties: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` plus ``out`` = 1-based rank of the row by ``pos`` inside ``by``.

    Same bucketing as :func:`asof_last`: ``row_number`` inside a bucket plus
    the row count of all earlier buckets (prefix sum on a bucket-level table),
    so a group of any size is ranked by many tasks.
    Positions must be unique within a group, or ``ties`` name columns that order equal ones.
    """
    B = F.lit(bucket)
    r = rows.withColumn("__b", F.floor(F.col(pos) / B))
    w = Window.partitionBy(*by, "__b").orderBy(F.col(pos), *[F.col(c) for c in ties])
    inner = r.withColumn("__rn", F.row_number().over(w))
    sizes = r.groupBy(*by, "__b").agg(F.count("*").alias("__n"))
    wb = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(wb), F.lit(0))).drop("__n")
    j = inner.join(before, on=[*by, "__b"], how="left")
    return j.withColumn(out, (F.col("__rn") + F.col("__before")).cast("bigint")).drop("__b", "__rn", "__before")


def previous_value(rows: DataFrame, by: list[str], pos: str, value: str, out: str,
                   bucket: int = DEFAULT_BUCKET) -> DataFrame:
    """``out`` = ``value`` of the previous row (by ``pos``) in the group - a bucketed ``lag``.

    Inside a bucket it is ``lag``; a bucket's first row takes the last value of
    the nearest earlier bucket (a bucket-level table, joined back on the key).
    """
    B = F.lit(bucket)
    r = rows.withColumn("__b", F.floor(F.col(pos) / B))
    w = Window.partitionBy(*by, "__b").orderBy(F.col(pos))
    inner = r.withColumn("__lag", F.lag(value).over(w)).withColumn("__first", F.row_number().over(w) == 1)
    last = r.groupBy(*by, "__b").agg(F.max_by(value, pos).alias("__last"))
    wb = Window.partitionBy(*by).orderBy("__b")
    carry = last.select(*by, "__b", F.lag("__last").over(wb).alias("__carry"))
    j = inner.join(carry, on=[*by, "__b"], how="left")
    return j.withColumn(out, F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__lag"))) \
            .drop("__b", "__lag", "__first", "__carry")


def running_max(rows: DataFrame, by: list[str], pos: str, cols: list[str],
                bucket: int = DEFAULT_BUCKET) -> DataFrame:
    """Replace each of ``cols`` by its running maximum (rows up to and including
    this one, ordered by ``pos`` inside ``by``), bucketed like the functions above:
    a window inside ``(group, bucket)`` plus the maximum of all earlier buckets."""
    B = F.lit(bucket)
    r = rows.withColumn("__b", F.floor(F.col(pos) / B))
    w = Window.partitionBy(*by, "__b").orderBy(F.col(pos)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = r.select("*", *[F.max(c).over(w).alias(f"__in_{c}") for c in cols])
    per = r.groupBy(*by, "__b").agg(*[F.max(c).alias(f"__bm_{c}") for c in cols])
    wb = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = per.select(*by, "__b", *[F.max(f"__bm_{c}").over(wb).alias(f"__cm_{c}") for c in cols])
    j = inner.join(carry, on=[*by, "__b"], how="left")
    return j.select(*[c for c in rows.columns if c not in cols],
                    *[F.greatest(F.col(f"__in_{c}"), F.col(f"__cm_{c}")).alias(c) for c in cols])
