"""Log -> tables in one call: parse, route, version filter, stamp, validate, flatten."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import session
from .operators import checks, stamp as st
from .operators.flatten import apply_schema, default_layouts
from .plans.evolve import Layout
from .plans.tables import TablePlan, plan_tables
from .sources import messages as M

# Fixed batch time used when a caller gives none: re-runs stamp the same value.
DEFAULT_BATCHED_AT = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def stream_records(log: DataFrame, stream: str) -> DataFrame:
    """RECORD rows of one stream from a ``(pos, line)`` log."""
    return M.route(M.parse(log))["records"].filter(F.col("stream") == stream)


def latest_schema(log_or_schemas: DataFrame, stream: str) -> tuple[dict, list[str]]:
    """The newest SCHEMA message of ``stream`` (one small row to the driver)."""
    schemas = log_or_schemas
    if "line" in schemas.columns:
        # only lines that can be SCHEMA messages are parsed
        schemas = M.route(M.parse(schemas.filter(M.may_mention(F.col("line"), "SCHEMA"))))["schemas"]
    row = (schemas.filter(F.col("stream") == stream)
           .select(F.max_by(F.struct(F.to_json("schema").alias("s"), "key_properties"), "pos").alias("m"))
           .collect()[0]["m"])
    if row is None:
        raise M.MessageError(f"no SCHEMA for stream {stream!r}")
    return json.loads(row["s"]), list(row["key_properties"] or [])


def tables_from_records(records: DataFrame, stream: str, schema: dict, keys: list[str],
                        batched_at: dt.datetime = DEFAULT_BATCHED_AT,
                        layouts: dict[tuple, Layout] | None = None, versions: bool | dict = True,
                        validate: bool = False, keep: tuple[str, ...] = (), materialize: bool = False
                        ) -> tuple[dict[tuple, DataFrame], list[TablePlan], dict[tuple, Layout]]:
    """Plan, filter, stamp (and validate) ``records``; flatten every table.

    With ``materialize`` the stamped records are written once to the shared
    checkpoint folder (``spark.checkpoint.dir``) as Parquet, so the root and every
    child table read the columns they need of parsed records instead of re-parsing
    the log each.
    """
    plans = plan_tables(stream, schema, keys)
    layouts = layouts or default_layouts(plans)
    if isinstance(versions, dict):      # maxima already known
        recs = st.latest_version_rows(records, known_max=versions, scan=False)
    else:
        recs = st.latest_version_rows(records) if versions else records
    recs = st.stamp(recs, batched_at, keyless=not keys)
    if validate:
        recs, _ = checks.split_valid(checks.validate(recs, schema))
    if materialize:
        recs = session.stored(recs.drop("line"), "records")
    return apply_schema(recs, plans, layouts, keep=keep), plans, layouts


def tables_from_log(log: DataFrame, stream: str, schema: dict | None = None,
                    keys: list[str] | None = None, **kw) -> dict[tuple, DataFrame]:
    """``{table path: DataFrame}`` for ``stream``; schema from the log unless given."""
    if schema is None:
        schema, keys = latest_schema(log, stream)
    if kw.get("versions", True) is True:
        # per-stream maxima from the lines that can carry a version: the text
        # test runs on the raw log, before any parse
        kw["versions"] = st.max_versions(stream_records(log.filter(M.may_mention(F.col("line"), "version")),
                                                        stream))
    return tables_from_records(stream_records(log, stream), stream, schema, keys or [], **kw)[0]


def table_counts(tables: dict[tuple, DataFrame]) -> DataFrame:
    """Rows per table (``table_name`` = path joined by ``__``), one union of partial counts."""
    from .plans.naming import SEPARATOR
    parts = [df.groupBy().agg(F.count("*").alias("n")).select(F.lit(SEPARATOR.join(p)).alias("table_name"), "n")
             for p, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def load_counts(tables: dict[tuple, DataFrame]) -> DataFrame:
    """A1: ``records_persisted`` (root rows) and ``rows_persisted`` (all tables), one job."""
    parts = [df.select(F.lit(1 if len(p) == 1 else 0).alias("r")) for p, df in tables.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(F.sum("r").cast("bigint").alias("records_persisted"), F.count("*").alias("rows_persisted"))
