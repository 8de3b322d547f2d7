"""Relational database sink (K6) through Spark's JDBC writer.

Each table of a batch is appended to a staging table; the upsert into the
target table then runs *in the database* (one statement per table, given by
the caller), because the final merge there must see the stored rows.  No
database runs in this repository's tests: only the writer configuration is
checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batch_size: int = 10_000, isolation: str = "READ_COMMITTED",
                 extra: dict | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size), "isolationLevel": isolation}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in (extra or {}).items()})
    return opts


def staging_writer(df: DataFrame, options: dict[str, str], partitions: int | None = None) -> DataFrameWriter:
    """Writer that appends ``df`` to the staging table named in ``options``.

    ``partitions`` bounds the number of parallel connections (one per task).
    """
    if partitions is not None:
        df = df.coalesce(partitions)
    return df.write.format("jdbc").mode("append").options(**options)


def write_tables(tables: dict[tuple, DataFrame], names: dict[tuple, str], url: str,
                 staging_prefix: str = "stg_", **kw) -> list[str]:
    """Append every table of a batch to ``<prefix><name>``; returns the staging names."""
    out = []
    for path, df in tables.items():
        name = f"{staging_prefix}{names[path]}"
        staging_writer(df, jdbc_options(url, name, **kw)).save()
        out.append(name)
    return out
