"""Build a loader from the reference-style JSON config (same option names).

| option | here |
| --- | --- |
| ``invalid_records_detect`` / ``invalid_records_threshold`` | ``LogLoader`` thresholds (P2) |
| ``persist_empty_tables`` | ``TableStore(persist_empty=...)`` (E10) |
| ``max_buffer_size`` | ``maxBytesPerTrigger`` of the file stream (T1) |
| ``max_batch_rows`` | refused: file sources bound batches by files and bytes (T1) |
| ``batch_detection_threshold`` | not needed: Spark triggers decide batch ends |
| ``state_support`` | ``LogLoader(emit_states=...)`` (T4) |
| ``add_upsert_indexes`` | always on: key-hash bucket layout (K5) |
| ``before_run_sql`` / ``after_run_sql`` (+ ``_file``) | SQL hooks (K4) |
| ``postgres_schema`` | namespace folder under the store base |
| ``postgres_host`` ... ``postgres_ssl*`` | JDBC options for ``sinks.jdbc`` (K6) |
| ``logging_level`` | Spark log level |
| ``disable_collection``, ``application_name`` | no effect (no telemetry; the session is already named) |
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .sinks.tables import TableStore
from .streaming.job import LogLoader

DEFAULTS = {
    "invalid_records_detect": True, "invalid_records_threshold": 0, "persist_empty_tables": False,
    "max_buffer_size": 104_857_600, "state_support": True,
    "postgres_schema": "public", "logging_level": None,
}


def jdbc_url(config: dict) -> str | None:
    if not config.get("postgres_database"):
        return None
    host, port = config.get("postgres_host") or "localhost", config.get("postgres_port") or 5432
    url = f"jdbc:postgresql://{host}:{port}/{config['postgres_database']}"
    if config.get("postgres_sslmode"):
        url += f"?sslmode={config['postgres_sslmode']}"
    return url


def loader_from_config(spark: SparkSession, config: dict, base: str, buckets: int = 64,
                       bookmark_path: str | None = None) -> tuple[LogLoader, dict]:
    """``(loader, run_options)``; call ``loader.run(path, **run_options)``."""
    if config.get("max_batch_rows") is not None:
        raise ValueError("max_batch_rows is not supported: bound batches by max_buffer_size (bytes)")
    c = {**DEFAULTS, **{k: v for k, v in config.items() if v is not None}}
    if c.get("logging_level"):
        spark.sparkContext.setLogLevel(str(c["logging_level"]).upper())
    store = TableStore(spark, f"{base.rstrip('/')}/{c['postgres_schema']}", buckets=buckets,
                       persist_empty=bool(c["persist_empty_tables"]))
    before = c.get("before_run_sql") or (f"file:{c['before_run_sql_file']}" if c.get("before_run_sql_file") else None)
    after = c.get("after_run_sql") or (f"file:{c['after_run_sql_file']}" if c.get("after_run_sql_file") else None)
    loader = LogLoader(spark, store, invalid_detect=bool(c["invalid_records_detect"]),
                       invalid_threshold=int(c["invalid_records_threshold"]),
                       emit_states=bool(c["state_support"]), bookmark_path=bookmark_path,
                       before_sql=before, after_sql=after)
    run = {"max_bytes_per_trigger": int(c["max_buffer_size"]), "max_files_per_trigger": None}
    return loader, run
