"""Apply a layout change to stored rows as one projection.

``plans.evolve.evolve`` decides the new layout; here the stored DataFrame is
re-shaped to it: split columns are renamed (data kept), new columns are NULL
of their type, everything is cast to the new layout's types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.evolve import Layout


def project(stored: DataFrame, new: Layout, changes: list[tuple], extra: tuple[str, ...] = ()) -> DataFrame:
    """``stored`` (old layout) -> rows in ``new`` layout order (plus ``extra`` columns as they are)."""
    renamed = {c[2]: c[1] for c in changes if c[0] == "split"}   # new name -> old name
    have = set(stored.columns)
    cols = []
    for name, t, _ in new.columns():
        src = renamed.get(name, name)
        cols.append((F.col(f"`{src}`") if src in have else F.lit(None)).cast(t).alias(name))
    return stored.select(*cols, *extra)

