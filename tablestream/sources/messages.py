"""Message log source.

A log is a DataFrame ``(pos bigint, line string)``: one JSON message per
line, ``pos`` giving source order.  :func:`read_log` builds it from text
files (batch or streaming); :func:`parse` turns it into typed envelope
columns with the VARIANT message kept; :func:`route` splits by message type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import variant as V
from ..functions.barrier import compute_once
from ..operators.asof import DEFAULT_BUCKET, asof_last, carry_last

# Message types and the envelope fields each one requires.
RECORD, SCHEMA, STATE, ACTIVATE_VERSION = "RECORD", "SCHEMA", "STATE", "ACTIVATE_VERSION"
MESSAGE_TYPES = (RECORD, SCHEMA, STATE, ACTIVATE_VERSION)
REQUIRED = {
    RECORD: ("stream", "record"),
    SCHEMA: ("stream", "schema"),
    ACTIVATE_VERSION: ("stream", "version"),
    STATE: ("value",),
}


class MessageError(ValueError):
    pass


FILE_SPAN = 1 << 42   # positions per file: byte offset of the split + line index inside it


def read_log(spark: SparkSession, path: str, streaming: bool = False,
             max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Text files of JSON lines -> ``(pos, line)``.

    A message's own ``pos`` field wins (see :func:`parse`).  Without one, the
    position follows the files: file path order, then line order inside the
    file (:func:`file_positions`).  A streaming log keeps the file columns and
    the loader numbers each micro-batch the same way.
    """
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if streaming and max_bytes_per_trigger:   # T1: batch bounded by bytes (whole files)
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    df = reader.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("_file"),
                                  F.col("_metadata.file_block_start").alias("_block"))
    return df if streaming else file_positions(df)


def file_positions(df: DataFrame) -> DataFrame:
    """``(line, _file, _block)`` -> ``(pos, line, _file)`` in file order.

    Splits of one file are not read in offset order, so the position is built
    from parts that are: the rank of the file path, the split's byte offset,
    and the line's index inside its split (rows of a split are contiguous in
    a task, so ``monotonically_increasing_id`` minus the split's first id).
    Only the file list and the split list (one row each) are aggregated; they are
    broadcast, so lines stay in the task that read their split: a join on the file
    would send all of a file, whatever its size, to one task.
    """
    d = df.withColumn("_m", F.monotonically_increasing_id())
    files = d.select("_file").distinct().withColumn(
        "_fi", F.dense_rank().over(Window.orderBy("_file")) - 1)
    splits = d.groupBy("_file", "_block").agg(F.min("_m").alias("_m0"))
    j = d.join(F.broadcast(files), "_file").join(F.broadcast(splits), ["_file", "_block"])
    pos = F.col("_fi") * F.lit(FILE_SPAN) + F.col("_block") + (F.col("_m") - F.col("_m0"))
    return j.select(pos.cast("bigint").alias("pos"), "line", "_file")


def _field(msg, name: str, kind: str = "string"):
    return F.try_variant_get(msg, f'$["{name}"]', kind)


PAYLOAD = {RECORD: "record", SCHEMA: "schema", STATE: "value"}


def parse(log: DataFrame) -> DataFrame:
    """``(pos, line)`` -> ``pos, line, msg, type, stream, payload, bad_reason``.

    ``payload`` is the message body (``record`` / ``schema`` / ``value``),
    extracted once here and reused by :func:`route`.  ``bad_reason`` is NULL
    for a well-formed envelope; otherwise one of ``unparsable``,
    ``missing type``, ``unknown type <t>`` or ``<TYPE> without <field>``.
    Columns are built in stages so each VARIANT extraction runs once.
    """
    extra = [c for c in ("_file",) if c in log.columns]
    df = log.select("pos", "line", *extra, F.try_parse_json("line").alias("msg"))
    m = F.col("msg")
    # a message's own "pos" field wins over the position of its line
    df = df.select(F.coalesce(_field(m, "pos", "bigint"), F.col("pos")).alias("pos"), "line", *extra, "msg",
                   _field(m, "type").alias("type"))
    t = F.col("type")
    payload = F.lit(None).cast("variant")
    for kind, field in PAYLOAD.items():
        payload = F.when(t == kind, V.at(m, (field,))).otherwise(payload)
    df = df.select("*", _field(m, "stream").alias("stream"), payload.alias("payload"),
                   _field(m, "version", "bigint").alias("_version"))
    reason = F.when(m.isNull(), F.lit("unparsable")) \
              .when(t.isNull(), F.lit("missing type")) \
              .when(~t.isin(*MESSAGE_TYPES), F.concat(F.lit("unknown type "), t))
    for kind, fields in REQUIRED.items():
        for f in fields:
            if f == "stream":
                present = F.col("stream").isNotNull()
            elif f == "version":
                present = F.col("_version").isNotNull()
            else:
                present = F.col("payload").isNotNull()
            reason = reason.when((t == kind) & ~present, F.lit(f"{kind} without {f}"))
    out = df.select("pos", "line", *extra, "msg", "type", "stream", "payload", reason.alias("bad_reason"))
    # routing filters on type / bad_reason must not re-run the parse
    return compute_once(out)


def _record_columns(parsed: DataFrame) -> list[Column]:
    m = F.col("msg")
    return [F.col("pos"), F.col("stream"), F.col("line"), *[F.col(c) for c in ("_file",) if c in parsed.columns],
            F.col("payload").alias("record"),
            _field(m, "version", "bigint").alias("version"),
            _field(m, "sequence", "bigint").alias("sequence"),
            _field(m, "time_extracted").alias("time_extracted"),
            F.length("line").alias("line_bytes")]


def route(parsed: DataFrame) -> dict[str, DataFrame]:
    """Four relations plus ``bad`` (S2).  No driver round trip."""
    good = parsed.filter(F.col("bad_reason").isNull())
    m = F.col("msg")
    out = {
        "records": good.filter(F.col("type") == RECORD).select(*_record_columns(parsed)),
        "schemas": good.filter(F.col("type") == SCHEMA).select(
            "pos", "stream", F.col("payload").alias("schema"),
            F.try_variant_get(m, "$.key_properties", "array<string>").alias("key_properties")),
        "states": good.filter(F.col("type") == STATE).select(
            "pos", F.col("payload").alias("value")),
        "activations": good.filter(F.col("type") == ACTIVATE_VERSION).select(
            "pos", "stream", _field(m, "version", "bigint").alias("version")),
        "bad": parsed.filter(F.col("bad_reason").isNotNull()).select("pos", "line", "bad_reason"),
    }
    return out


def may_mention(line, word: str):
    """Cheap text test: can this JSON line hold ``word`` as a key or value?

    True when the word appears literally or the line has a ``\\u`` escape
    (which could spell it).  Used as a filter *before* parsing, so lines that
    cannot match are never parsed.
    """
    return line.contains(word) | line.contains("\\u")


def orphan_records(records: DataFrame, schemas: DataFrame) -> DataFrame:
    """RECORDs with no SCHEMA of their stream before them (S3: an error in strict mode).

    The first SCHEMA position per stream is collected (one row per stream)
    and applied as a literal lookup - no join, so a hot stream is not
    funnelled into one task.
    """
    first = {r["stream"]: r["first"] for r in
             schemas.groupBy("stream").agg(F.min("pos").alias("first")).collect()}
    if not first:
        return records
    pairs = []
    for k, v in first.items():
        pairs += [F.lit(k), F.lit(v).cast("bigint")]
    f = F.element_at(F.create_map(*pairs), F.col("stream"))
    return records.filter(f.isNull() | (F.col("pos") < f))


def schema_in_force(records: DataFrame, schemas: DataFrame, schema_id: str = "schema_id") -> DataFrame:
    """Each RECORD with the id of the latest SCHEMA of its stream before it.

    ``schemas`` carries ``stream, pos, <schema_id>``; the lookup is a bucketed
    as-of join, so a hot stream does not end up in one task.
    """
    marks = schemas.select("stream", "pos", schema_id)
    return asof_last(records, marks, by=["stream"], pos="pos", value=schema_id, out=schema_id)


def records_with_schema(parsed: DataFrame, out: str = "schema_pos", bucket: int = DEFAULT_BUCKET) -> DataFrame:
    """S4 in one pass: the RECORDs of a parsed log (columns as in :func:`route`) with the position of the
    SCHEMA in force (NULL where none came before).

    The log is read and parsed once and its records shuffled once, by stream and bucket of positions;
    SCHEMA messages travel with them without their bodies.
    """
    both = parsed.filter(F.col("bad_reason").isNull() & F.col("type").isin(RECORD, SCHEMA))
    is_schema = F.col("type") == SCHEMA
    body = {c: F.when(~F.col("__schema"), F.col(c)) for c in ("line", "record")}   # of records only
    both = both.select(*_record_columns(parsed), is_schema.alias("__schema"),
                       F.when(is_schema, F.col("pos")).alias("__at")).withColumns(body)
    return carry_last(both, ["stream"], "pos", "__schema", "__at", out, bucket)


def require_clean(parsed: DataFrame) -> None:
    """Strict mode (S1): raise if any line is bad. One short job, no rows to the driver."""
    bad = parsed.filter(F.col("bad_reason").isNotNull()).select("pos", "bad_reason").limit(1).collect()
    if bad:
        raise MessageError(f"bad message at pos {bad[0]['pos']}: {bad[0]['bad_reason']}")
