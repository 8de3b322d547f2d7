"""tablestream: JSON change-message logs -> relational tables on Spark.

Main entry points::

    from tablestream.loader import tables_from_log            # batch: log -> {path: DataFrame}
    from tablestream.sinks.tables import TableStore            # upserting parquet table store
    from tablestream.streaming.job import LogLoader            # Structured Streaming loader
    from tablestream.config import loader_from_config          # reference-style JSON config
"""

__version__ = "0.1.0"
