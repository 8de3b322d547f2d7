"""Scalar column helpers (P11, P12, N1 over a column of names)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The string stored as NULL by default, and the timestamp
# resolution of stored date-times (4 fractional digits = 100 microseconds).
NULL_LITERAL = "NULL"
TIMESTAMP_STEP_MICROS = 100


def parse_datetime(s: Column) -> Column:
    """ISO-8601 text -> UTC timestamp truncated to 100 us; unparsable -> NULL."""
    t = s.try_cast("timestamp")
    return F.timestamp_micros(F.floor(F.unix_micros(t) / TIMESTAMP_STEP_MICROS) * TIMESTAMP_STEP_MICROS)


def to_naive(ts: Column) -> Column:
    """UTC timestamp -> timestamp_ntz wall clock (session time zone is UTC)."""
    return ts.cast("timestamp_ntz")


def iso_utc(ts: Column) -> Column:
    """A timestamp_ntz (UTC wall clock) as ISO text with ``Z``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def null_literal(c: Column, literal: str | None = NULL_LITERAL) -> Column:
    """The string ``literal`` is stored as NULL (``None`` turns it off)."""
    return c if literal is None else F.nullif(c, F.lit(literal))


def canonical_name(c: Column) -> Column:
    """N1 over a column of names: lower, non ``[a-z0-9_$]`` -> ``_``, empty -> ``_``."""
    low = F.lower(F.coalesce(F.nullif(c, F.lit("")), F.lit("_")))
    return F.regexp_replace(low, r"[^a-z0-9_$]", "_")


def fit_name(c: Column, suffix: Column | None = None, limit: int = 63) -> Column:
    """Cut to ``limit`` keeping ``suffix`` whole."""
    if suffix is None:
        return F.substring(c, 1, limit)
    return F.concat(F.substring(c, F.lit(1), F.lit(limit) - F.length(suffix)), suffix)
