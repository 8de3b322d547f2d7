"""Structured Streaming loader.

``readStream.text`` over a folder of JSON-line files -> ``foreachBatch``:
parse and route the micro-batch once (persisted).  A stream's SCHEMA (where
it changes something) and ACTIVATE_VERSION messages cut its records into
segments, in log order: the records before a control message are stored
under the schema then in force (S4), then the message applies (a new schema;
an activation after the flush, T5).
Per stream and segment: version filter, stamp, validate (invalid records to
a quarantine), and upsert every table through the
:class:`~tablestream.sinks.tables.TableStore`; independent streams may be
written from several driver threads.  Once the batch is durable its newest
STATE is released; where a stream fails, the newest STATE before the first
record that is not stored.

Batch size is bounded by ``maxFilesPerTrigger`` / ``maxBytesPerTrigger``;
``availableNow`` drains what is there and stops.  The store knows a commit by
streaming query, batch and segment, so a retried one is a no-op and a lost
executor or a restarted query gives the same tables.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from concurrent.futures import ThreadPoolExecutor
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..operators import checks, stamp as st
from ..operators.flatten import apply_schema
from ..plans.tables import plan_tables
from ..sinks.tables import TableStore, _Fs
from ..sources import messages as M
from .bookmarks import newest_safe_state


def _statements(sql: list[str] | str | None) -> list[str]:
    """K4 hooks: a list of statements, inline text, or ``file:<path>``; ``;`` separates."""
    if not sql:
        return []
    if isinstance(sql, list):
        return [q for q in sql if q.strip()]
    if sql.startswith("file:"):
        with open(sql[5:], encoding="utf-8") as f:
            sql = f.read()
    return [q.strip() for q in sql.split(";") if q.strip()]


class LogLoader:
    def __init__(self, spark: SparkSession, store: TableStore | None, *,
                 invalid_detect: bool = True, invalid_threshold: int = 0,
                 emit_states: bool = True, bookmark_path: str | None = None,
                 before_sql: list[str] | str | None = None, after_sql: list[str] | str | None = None,
                 target: Callable[[str, dict], None] | None = None,  # (stream, {path: DataFrame})
                 clock: Callable[[], dt.datetime] | None = None, quarantine: bool = True,
                 parallel_streams: int = 1, job: str = "default"):
        self.spark, self.store = spark, store
        self.invalid_detect, self.invalid_threshold = invalid_detect, invalid_threshold
        self.emit_states, self.bookmark_path = emit_states, bookmark_path
        self.before_sql, self.after_sql = _statements(before_sql), _statements(after_sql)
        self.target = target
        self.quarantine = quarantine
        self.parallel_streams = max(1, parallel_streams)
        self.clock = clock or (lambda: dt.datetime.now(dt.timezone.utc))
        if store is None and target is None:
            raise ValueError("give a TableStore, a target callback, or both")
        self.fs = _Fs(spark)
        # without a store, schemas and versions lie in a folder of the job
        self.base = store.base if store is not None else f"{session.checkpoint_dir(spark)}/loader-meta/{job}"
        self.last_state: str | None = self._released()
        self._invalid: dict[str, dict[tuple[int, int], int]] = {}   # stream -> commit -> invalid records

    # ----------------------------------------------------------- schemas
    def _schema_path(self, stream: str) -> str:
        return f"{self.base}/{stream}/_schema.json"

    def _schema(self, stream: str) -> tuple[dict, list[str]] | None:
        txt = self.fs.read(self._schema_path(stream))
        if not txt:
            return None
        d = json.loads(txt)
        return None if d["schema"] is None else (d["schema"], d["keys"])

    def _save_schema(self, stream: str, schema: dict, keys: list[str], batch: list, began: tuple | None) -> None:
        """``began`` is what was in force before the batch, for a retry of it."""
        self.fs.write_atomic(self._schema_path(stream), json.dumps(
            {"schema": schema, "keys": keys, "batch": batch, "began": began}))

    def _schema_before(self, stream: str, batch: list) -> tuple[dict, list[str]] | None:
        """Schema in force when ``batch`` began, also if an earlier try of it has stored a later one."""
        d = json.loads(self.fs.read(self._schema_path(stream)) or "{}")
        if d.get("batch") != batch:
            return self._schema(stream)
        return tuple(d["began"]) if d["began"] else None

    # ----------------------------------------------------------- one batch
    def process_batch(self, log: DataFrame, batch_id: int) -> None:
        self._batch = batch_id
        if "pos" not in log.columns:   # plain files: number lines in file order within the batch
            log = M.file_positions(log)
        parsed = M.parse(log).persist()
        try:
            routed = M.route(parsed)
            # One small job for the control messages: the first bad line (strict
            # mode), and the few SCHEMA / ACTIVATE_VERSION messages of the batch.
            ctrl = self._control_rows(parsed)
            bad = [r for r in ctrl if r["bad_reason"] is not None]
            if bad:
                raise M.MessageError(f"bad message at pos {bad[0]['pos']}: {bad[0]['bad_reason']}")
            records = routed["records"]
            # one small job: per stream, whether it has versions (P4), and its first position
            seen = {r["stream"]: r for r in records.groupBy("stream").agg(
                F.max("version").isNotNull().alias("versioned"), F.min("pos").alias("first")).collect()}
            control: dict[str, list] = {}
            for c in ctrl:
                control.setdefault(c["stream"], []).append(c)
            orphans = sorted(s for s in seen if self._schema(s) is None
                             and not any(c["type"] == M.SCHEMA for c in control.get(s, [])))
            if orphans:
                raise M.MessageError(f"RECORD before SCHEMA for stream(s) {orphans}")
            batched_at = self.clock()
            failed = self._run_streams({s: (records.filter(F.col("stream") == s) if s in seen else None,
                                            s in seen and seen[s]["versioned"], control.get(s, []), batch_id, batched_at)
                                        for s in sorted({*seen, *control})}, parsed)
            if self.emit_states:
                waiting = [seen[s]["first"] for s in failed if s in seen]
                self._emit_state(routed["states"], min(waiting, default=None))
            for error in failed.values():
                if error is not None:
                    raise error
        finally:
            parsed.unpersist()

    def _run_streams(self, jobs: dict, parsed: DataFrame) -> dict[str, Exception | None]:
        """Store the streams of a batch; those that are not stored, with the error or None if never tried.
        Streams are independent tables: with ``parallel_streams > 1`` their Spark jobs are submitted from
        several driver threads at once."""
        failed: dict[str, Exception | None] = {}
        if self.parallel_streams == 1 or len(jobs) < 2:
            for stream, job in jobs.items():
                if failed:
                    failed[stream] = None
                    continue
                try:
                    self._run_stream(stream, *job, parsed)
                except Exception as error:  # raised by the caller once safe bookmarks are out
                    failed[stream] = error
            return failed
        with ThreadPoolExecutor(max_workers=self.parallel_streams) as pool:
            running = {s: pool.submit(self._run_stream, s, *job, parsed) for s, job in jobs.items()}
            for stream, f in running.items():
                if f.exception() is not None:
                    failed[stream] = f.exception()
        return failed

    def _run_stream(self, stream: str, records: DataFrame | None, versioned: bool, control: list, batch_id: int,
                    batched_at: dt.datetime, parsed: DataFrame) -> None:
        """The stream's records before one of its own SCHEMA or
        ACTIVATE_VERSION messages are stored under what is then in force, then
        the message applies.  A SCHEMA equal to the one in force cuts nothing.
        A retry begins with the schema the first try began with, so it cuts, and
        numbers its segments, alike."""
        batch, began = [self._load(), batch_id], self._schema(stream)
        if any(c["type"] == M.SCHEMA for c in control):
            stored, began = began, self._schema_before(stream, batch)
            if began != stored:
                self._save_schema(stream, *(began or (None, [])), batch, began)
        cuts, in_force = [], began
        for c in control:
            if c["type"] == M.SCHEMA:
                new = (json.loads(c["body"]), list(c["key_properties"] or []))
                if new == in_force:
                    continue
                in_force = new
            cuts.append(c)
        cut = None
        for segment, c in enumerate([*cuts, None]):
            hi = c["pos"] if c is not None else None
            if records is not None and (c is None or hi is not None):   # without a position: before all records
                part = records
                if cut is not None:
                    part = part.filter(F.col("pos") > cut)
                if hi is not None:
                    part = part.filter(F.col("pos") < hi)
                self._write_stream(stream, part, batch_id, segment, batched_at, versioned)
            elif c is None and self.store is not None and self.store.persist_empty and self._schema(stream):
                none = parsed.filter(F.lit(False))   # E10: a stream that only declared itself
                self._write_stream(stream, M.route(none)["records"], batch_id, segment, batched_at, False)
            if c is not None and c["type"] == M.SCHEMA:
                self._save_schema(stream, json.loads(c["body"]), list(c["key_properties"] or []), batch, began)
            elif c is not None:
                if self._schema(stream) is None:
                    raise M.MessageError(f"ACTIVATE_VERSION before SCHEMA for stream {stream!r}")
                if self.store is not None:
                    self.store.activate_version(stream, c["version"])
                activate = getattr(self.target, "activate_version", None)   # K7
                if activate is not None:
                    activate(stream, c["version"])
            cut = hi if hi is not None else cut

    def _load(self) -> str:
        return self.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""

    def _newest_version(self, stream: str, part: DataFrame) -> int | None:
        """The stream's newest version so far, over its whole life."""
        path = f"{self.base}/{stream}/_max_version.json"
        known = json.loads(self.fs.read(path) or "null")
        here = part.agg(F.max("version")).first()[0]
        if here is not None and (known is None or here > known):
            self.fs.write_atomic(path, json.dumps(here))
            return here
        return known

    def _write_stream(self, stream: str, recs: DataFrame, batch_id: int, segment: int, batched_at: dt.datetime,
                      versioned: bool) -> None:
        found = self._schema(stream)
        if found is None:
            if recs.isEmpty():
                return
            raise M.MessageError(f"RECORD before SCHEMA for stream {stream!r}")
        schema, keys = found
        plans = plan_tables(stream, schema, keys)
        version = self._newest_version(stream, recs) if versioned or self.fs.exists(
            f"{self.base}/{stream}/_max_version.json") else None
        recs = st.latest_version_rows(recs, {stream: version}, scan=False)
        recs = st.stamp(recs, batched_at, keyless=not keys)
        checked = checks.validate(recs, schema).persist()
        try:
            # counted over the whole run, a repeated batch once
            found = checks.invalid_counts(checked).agg(F.sum("invalid")).first()[0] or 0
            seen = self._invalid.setdefault(stream, {})
            seen[batch_id, segment] = found
            if self.invalid_detect:
                checks.refuse_invalid({stream: sum(seen.values())}, self.invalid_threshold)
            good, bad = checks.split_valid(checked)
            load = self._load()
            if self.quarantine and found:
                # K2: invalid records are kept, with their reasons, per commit
                (bad.select("pos", "stream", "line", checks.REASONS).write.mode("overwrite").parquet(
                    f"{self.base}/{stream}/_quarantine/load={load or 'direct'}/batch={batch_id}/segment={segment}"))
            if self.target is not None:
                # K7: a user target gets every table of the batch as DataFrames
                self.target(stream, apply_schema(good, plans))
            if self.store is not None:
                self.store.write_batch(stream, plans, good, batch_id, version=version, segment=segment, load=load)
        finally:
            checked.unpersist()

    @staticmethod
    def _control_rows(parsed: DataFrame) -> list:
        m = F.col("msg")
        cols = ["pos", "type", "stream", "bad_reason", F.to_json("payload").alias("body"),
                F.try_variant_get(m, "$.key_properties", "array<string>").alias("key_properties"),
                F.try_variant_get(m, "$.version", "bigint").alias("version")]
        good = parsed.filter(F.col("bad_reason").isNull() & F.col("type").isin(M.SCHEMA, M.ACTIVATE_VERSION))
        first_bad = parsed.filter(F.col("bad_reason").isNotNull()).orderBy("pos").limit(1)
        return good.select(*cols).unionByName(first_bad.select(*cols)).orderBy("pos").collect()

    def _released(self) -> str | None:
        """The last value in the bookmark folder, so that a restart does not write it again."""
        names = [n for n in self.fs.listdir(self.bookmark_path) if n.startswith("state-") and n.endswith(".json")] \
            if self.bookmark_path else []
        return self.fs.read(f"{self.bookmark_path}/{max(names)}") if names else None

    def _emit_state(self, states: DataFrame, waiting: int | None) -> None:
        """Release the newest STATE with every record before it stored.  Earlier batches are stored;
        ``waiting`` is the first position of this one that is not (None: all is stored)."""
        row = newest_safe_state(states, waiting).collect()
        if row and row[0]["value"] != self.last_state and self.bookmark_path:
            self.last_state = row[0]["value"]
            self.fs.write_atomic(f"{self.bookmark_path}/state-{self._batch:012d}-{row[0]['pos']:020d}.json",
                                 row[0]["value"])

    # ----------------------------------------------------------- run
    def run(self, path: str, checkpoint: str | None = None, max_files_per_trigger: int | None = 1,
            available_now: bool = True, timeout: float | None = None,
            max_bytes_per_trigger: int | None = None):
        log = M.read_log(self.spark, path, streaming=True, max_files_per_trigger=max_files_per_trigger,
                         max_bytes_per_trigger=max_bytes_per_trigger)
        ckpt = checkpoint or f"{session.checkpoint_dir(self.spark)}/loader-{hashlib.sha256(path.encode()).hexdigest()[:16]}"
        w = log.writeStream.foreachBatch(self.process_batch).option("checkpointLocation", ckpt)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
        self._invalid = {}
        for sql in self.before_sql:   # K4: once per run, also when there is nothing to load
            self.spark.sql(sql)
        q = w.start()
        ended = q.awaitTermination(timeout)
        if ended is not False and q.exception() is None:   # K4: only once the query has ended well
            for sql in self.after_sql:
                self.spark.sql(sql)
        return q
