"""Safe bookmarks.

A STATE may be released once every record before it is stored.  What is stored is known from the
commits of the loader, one small row each with the positions it covers: after a commit, a STATE is safe
if it stands before the first record of every commit still to come (:func:`safe_bookmarks`).  The loader
itself releases the newest STATE before the first record that is not stored
(:func:`newest_safe_state`), and only if its value changed (T3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.asof import DEFAULT_BUCKET, asof_last, previous_value, running_max


def safe_bookmarks(commits: DataFrame, states: DataFrame, bucket: int = DEFAULT_BUCKET) -> DataFrame:
    """A3: after each commit, ``n, stream, threshold, state_pos``.

    ``commits`` has ``n`` (their order over all streams, from 1), ``stream`` and ``first_pos``.
    ``threshold`` is the lowest first position of the commits after it (NULL after the last);
    ``state_pos`` is the newest STATE below it (NULL if none).
    """
    # the lowest first position of later commits = a running maximum, read backwards, of the negated one
    back = commits.filter(F.col("n") > 1).select((-F.col("n") + 1).alias("at"), (-F.col("first_pos")).alias("neg"))
    lowest = running_max(back, by=[], pos="at", cols=["neg"], bucket=bucket)
    rows = commits.join(lowest.select((-F.col("at")).alias("n"), (-F.col("neg")).alias("threshold")), "n", "left")
    end = F.lit((1 << 63) - 1)   # nothing waits: every STATE is below
    rows = rows.withColumn("__below", F.coalesce("threshold", end))
    marks = states.select(F.col("pos").alias("__below"), F.col("pos").alias("__state"))
    out = asof_last(rows, marks, by=[], pos="__below", value="__state", out="state_pos", bucket=bucket)
    return out.select("n", "stream", "threshold", "state_pos")


def bookmark_changes(states: DataFrame, bucket: int = DEFAULT_BUCKET) -> DataFrame:
    """Emitted STATE values in order, dropping repeats of the previous value."""
    s = states.select("pos", F.to_json("value").alias("value"))
    prev = previous_value(s, by=[], pos="pos", value="value", out="__prev", bucket=bucket)
    return prev.filter(F.col("__prev").isNull() | (F.col("__prev") != F.col("value"))).drop("__prev")


def newest_safe_state(states: DataFrame, waiting: int | None) -> DataFrame:
    """The newest STATE before the position ``waiting`` of the first record that is not stored (``None``:
    everything is stored); one row at most."""
    if waiting is not None:
        states = states.filter(F.col("pos") < waiting)
    return (states
            .agg(F.max_by(F.to_json("value"), "pos").alias("value"), F.max("pos").alias("pos"))
            .filter(F.col("pos").isNotNull()))
