"""Record versions, load metadata and surrogate keys.

All three are column expressions plus at most one small per-stream
aggregate; nothing is windowed per stream (a hot stream would be one task).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as V
from ..functions.scalars import parse_datetime
from ..plans.tables import BATCHED_AT, PRIMARY_KEY, RECEIVED_AT, SEQUENCE, TABLE_VERSION


def max_versions(records: DataFrame) -> dict[str, int | None]:
    """A2: newest version per stream - one small row per stream to the driver.

    Callers holding the raw log should filter it with
    ``messages.may_mention(line, "version")`` *before* parsing (see
    ``loader.tables_from_log``): lines without the word cannot carry one.
    """
    return {r["stream"]: r["max_version"] for r in
            records.groupBy("stream").agg(F.max("version").alias("max_version")).collect()}


def per_stream(values: dict, stream: Column | None = None) -> Column:
    """A literal ``stream -> value`` lookup (streams are few: one SCHEMA each)."""
    stream = F.col("stream") if stream is None else stream
    if not values:
        return F.lit(None)
    pairs = []
    for k, v in values.items():
        pairs += [F.lit(k), F.lit(v).cast("bigint")]
    return F.element_at(F.create_map(*pairs), stream)


def latest_version_rows(records: DataFrame, known_max: dict[str, int | None] | None = None,
                        scan: bool = True) -> DataFrame:
    """Keep rows whose ``version`` equals the stream's newest version.

    A newer version discards rows still buffered for older ones, so inside a
    batch the survivors are ``version <=> max(version)`` per stream (rows
    without a version survive only while no version was seen, Q16).
    ``known_max`` may carry maxima already known (e.g. from earlier batches);
    with ``scan=False`` they are taken as complete and no aggregate runs.

    The per-stream maxima are collected (one row per stream) and applied as
    a literal lookup, so records are neither joined nor shuffled: a stream
    holding a third of the rows costs nothing extra.
    """
    mx = max_versions(records) if scan else {}
    for k, v in (known_max or {}).items():
        if v is not None and (mx.get(k) is None or v > mx[k]):
            mx[k] = v
    if all(v is None for v in mx.values()):
        return records
    return records.filter(F.col("version").eqNullSafe(per_stream(mx)))


def stamp(records: DataFrame, batched_at: dt.datetime, keyless: bool = False,
          surrogate: str = "hash") -> DataFrame:
    """Add ``_sdc_*`` metadata columns to routed RECORD rows.

    * ``_sdc_table_version`` = message version, else the record's own field;
    * ``_sdc_received_at`` = the record's own value, else ``time_extracted``;
    * ``_sdc_batched_at`` = ``batched_at`` (one literal per batch, so a re-run
      stamps the same value);
    * ``_sdc_sequence`` = message sequence, else ``batched_at`` in epoch seconds;
    * ``_sdc_primary_key`` (key-less streams) = the record's own value, else
      a deterministic hash of (stream, pos) - or ``uuid()`` when asked.
    """
    rec = F.col("record")
    ts = batched_at if batched_at.tzinfo else batched_at.replace(tzinfo=dt.timezone.utc)
    epoch = int(ts.timestamp())
    own_received = V.typed(V.at(rec, (RECEIVED_AT,)), "string")
    cols: dict[str, Column] = {
        TABLE_VERSION: F.coalesce(F.col("version"), V.typed(V.at(rec, (TABLE_VERSION,)), "integer")),
        RECEIVED_AT: parse_datetime(F.coalesce(own_received, F.col("time_extracted"))),
        BATCHED_AT: F.timestamp_micros(F.lit(round(ts.timestamp() * 1_000_000))),
        SEQUENCE: F.coalesce(F.col("sequence"), F.lit(epoch).cast("bigint")),
    }
    if keyless:
        # positions derived from files restart per micro-batch: the file joins the key
        where = F.concat_ws("|", F.col("_file"), F.col("pos").cast("string")) if "_file" in records.columns \
            else F.col("pos")
        cols[PRIMARY_KEY] = F.coalesce(V.typed(V.at(rec, (PRIMARY_KEY,)), "string"),
                                       surrogate_key(F.col("stream"), where, surrogate))
    return records.withColumns(cols)


def surrogate_key(stream: Column, pos: Column, how: str = "hash") -> Column:
    """Retry-safe ``sha2(stream|pos)`` by default, random ``uuid()`` on request."""
    if how == "uuid":
        return F.expr("uuid()")
    return F.sha2(F.concat_ws("|", stream, pos.cast("string")), 256)
