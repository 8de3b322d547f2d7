import json



def log_df(spark, messages):
    """(pos, line) log from Python message dicts (pos = list index * 10)."""
    rows = [(i * 10, m if isinstance(m, str) else json.dumps(m)) for i, m in enumerate(messages)]
    return spark.createDataFrame(rows, "pos bigint, line string")


def schema_msg(stream, schema, keys):
    return {"type": "SCHEMA", "stream": stream, "schema": schema, "key_properties": keys}


def record_msg(stream, record, **kw):
    return {"type": "RECORD", "stream": stream, "record": record, **kw}


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect()) if cols else sorted(tuple(r) for r in df.collect())
