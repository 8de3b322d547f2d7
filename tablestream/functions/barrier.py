"""Keep expensive columns computed once when later filters refer to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame) -> DataFrame:
    """Stop filters above ``df`` from being pushed into its projections.

    Catalyst pushes a filter below the projection that defines the columns
    it tests by inlining their definitions (e.g. a JSON parse or a rule
    array) once per reference; it does not weigh their cost.  Passing the
    rows through a one-row-per-row generator (``inline(array(struct(...)))``)
    keeps such filters above it, so each expression runs once per row.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
