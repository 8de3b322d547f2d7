"""Seeded random nested schemas: per-table row counts equal a walk of the records."""

import json
import random

from tablestream.loader import tables_from_log
from tablestream.plans.tables import VALUE

from helpers import log_df, record_msg

LITS = ["integer", "number", "boolean", "string"]


def rand_schema(rng, depth=0):
    r = rng.random()
    if depth >= 3 or r < 0.45:
        return {"type": [rng.choice(LITS), "null"]}
    if r < 0.75:
        return {"type": ["object", "null"],
                "properties": {f"p{i}": rand_schema(rng, depth + 1) for i in range(rng.randint(1, 3))}}
    return {"type": ["array", "null"], "items": rand_schema(rng, depth + 1)}


def rand_value(rng, s):
    t = s["type"][0]
    if rng.random() < 0.1:
        return None
    if t == "object":
        return {k: rand_value(rng, v) for k, v in s["properties"].items() if rng.random() < 0.9}
    if t == "array":
        return [rand_value(rng, s["items"]) for _ in range(rng.randint(0, 3))]
    return {"integer": rng.randint(-5, 5), "number": rng.random(), "boolean": rng.random() < 0.5,
            "string": rng.choice(["a", "b", ""])}[t]


def expected_counts(stream, schema, records):
    counts = {(stream,): len(records)}

    def tables(s, path, in_array):
        t = s["type"][0]
        if t == "object":
            for k, v in s["properties"].items():
                tables(v, path + (k,), in_array)
        elif t == "array":
            counts[path] = 0
            tables(s["items"], path + (VALUE,) if s["items"]["type"][0] != "object" else path, True)

    def walk(s, value, path):
        t = s["type"][0]
        if value is None:
            return
        if t == "object" and isinstance(value, dict):
            for k, v in s["properties"].items():
                walk(v, value.get(k), path + (k,))
        elif t == "array" and isinstance(value, list):
            counts[path] = counts.get(path, 0) + len(value)
            inner = path + (VALUE,) if s["items"]["type"][0] != "object" else path
            for item in value:
                walk(s["items"], item, inner)

    for k, v in schema["properties"].items():
        tables(v, (stream, k), False)
    for r in records:
        for k, v in schema["properties"].items():
            walk(v, r.get(k), (stream, k))
    return counts


def test_random_nested_schemas(spark):
    rng = random.Random(20240)
    for case in range(12):
        props = {"id": {"type": "integer"}}
        props.update({f"f{i}": rand_schema(rng) for i in range(rng.randint(1, 4))})
        schema = {"type": "object", "properties": props}
        records = [{"id": i, **{k: rand_value(rng, v) for k, v in props.items() if k != "id"}}
                   for i in range(rng.randint(1, 12))]
        msgs = [record_msg("r", json.loads(json.dumps(r)), sequence=1) for r in records]
        tabs = tables_from_log(log_df(spark, msgs), "r", schema, ["id"])
        got = {p: df.count() for p, df in tabs.items()}
        assert got == expected_counts("r", schema, records), (case, schema)
