"""Schema -> table tree.

A declared stream schema becomes one :class:`TablePlan` for the root and one
for every array path.  A plan tells the Spark side

* which arrays to explode, in order (``arrays``: the path of each array
  relative to the enclosing element), and
* which leaves to read from the innermost element (``leaves``: relative
  path -> literal alternatives).

Objects are flattened into their parent (``a__b__c``), arrays become child
tables named by their full path.  Scalar array items live in ``_sdc_value``;
an array of arrays nests one more table under ``..._sdc_value``.

Plans are pure data: built once per schema change on the driver.
"""

from __future__ import annotations

from copy import deepcopy
from dataclasses import dataclass, field

from . import jsonschema as js

# Reserved metadata column names.
RECEIVED_AT = "_sdc_received_at"
BATCHED_AT = "_sdc_batched_at"
SEQUENCE = "_sdc_sequence"
TABLE_VERSION = "_sdc_table_version"
PRIMARY_KEY = "_sdc_primary_key"
SOURCE_KEY_PREFIX = "_sdc_source_key_"
LEVEL_FMT = "_sdc_level_{}_id"
VALUE = "_sdc_value"


@dataclass
class TablePlan:
    path: tuple[str, ...]                    # table path, stream name first
    level: int | None                        # None for root, 0.. for children
    key_properties: list[str]                # key columns of this table
    arrays: list[tuple[str, ...]]            # explode chain (relative array paths)
    leaves: dict[tuple[str, ...], list[dict]] = field(default_factory=dict)
    carried: dict[str, dict] = field(default_factory=dict)  # metadata columns (keys, seq, levels)

    @property
    def is_root(self) -> bool:
        return self.level is None

    def level_columns(self) -> list[str]:
        return [] if self.level is None else [LEVEL_FMT.format(i) for i in range(self.level + 1)]


def stream_schema(schema: dict, key_properties: list[str]) -> tuple[dict, list[str]]:
    """Simplify a declared stream schema and add the reserved columns (``update_schema``)."""
    js.check_schema(schema)
    simple = js.simplify(schema)
    if not js.is_object(simple):
        raise js.SchemaError("a stream schema must describe an object")
    props = simple.setdefault("properties", {})
    props.setdefault(RECEIVED_AT, {"type": ["null", "string"], "format": "date-time"})
    props.setdefault(SEQUENCE, {"type": ["null", "integer"]})
    props.setdefault(TABLE_VERSION, {"type": ["null", "integer"]})
    props.setdefault(BATCHED_AT, {"type": ["null", "string"], "format": "date-time"})
    keys = list(key_properties or [])
    if not keys:
        keys = [PRIMARY_KEY]
        props[PRIMARY_KEY] = {"type": ["string"]}
    return simple, keys


def _branches(node: dict) -> list[dict]:
    return list(node["anyOf"]) if js.has_anyof(node) else [node]


def plan_tables(stream: str, schema: dict, key_properties: list[str] | None = None) -> list[TablePlan]:
    """All table plans of a stream, root first."""
    simple, keys = stream_schema(schema, key_properties or [])
    for k in keys:
        if k not in simple["properties"]:
            raise js.SchemaError(f"unknown key property {k!r}")
    key_schemas = {k: simple["properties"][k] for k in keys}
    root = TablePlan(path=(stream,), level=None, key_properties=list(keys), arrays=[])
    out: list[TablePlan] = [root]
    _walk(simple, root, (), (), False, key_schemas, out)
    for k in keys:
        if (k,) not in root.leaves:
            raise js.SchemaError(f"key property {k!r} is not a literal column")
    return out


def _add_leaf(plan: TablePlan, path: tuple, alt: dict) -> None:
    plan.leaves.setdefault(path, []).append(alt)


def _walk(node: dict, plan: TablePlan, table_rel: tuple, leaf_rel: tuple, is_null: bool,
          key_schemas: dict, out: list[TablePlan]) -> None:
    """Visit the properties of object ``node`` that belongs to ``plan``."""
    for prop, sub in node.get("properties", {}).items():
        for alt in _branches(sub):
            if not (js.is_object(alt) or js.is_array(alt) or js.is_literal(alt)):
                continue  # null-only: no column at all
            if js.is_object(alt):
                _walk(alt, plan, table_rel + (prop,), leaf_rel + (prop,),
                      is_null or js.is_nullable(alt), key_schemas, out)
            elif js.is_array(alt):
                _child(alt["items"], plan, table_rel + (prop,), leaf_rel + (prop,), key_schemas, out)
            else:
                _add_leaf(plan, leaf_rel + (prop,), js.nullable(alt) if is_null else deepcopy(alt))


def _child(items: dict, parent: TablePlan, table_rel: tuple, array_rel: tuple,
           key_schemas: dict, out: list[TablePlan]) -> None:
    level = 0 if parent.level is None else parent.level + 1
    child = TablePlan(path=parent.path + table_rel, level=level,
                      key_properties=[js_key for js_key in (SOURCE_KEY_PREFIX + k for k in key_schemas)],
                      arrays=parent.arrays + [array_rel])
    for k, s in key_schemas.items():
        child.carried[SOURCE_KEY_PREFIX + k] = s
    child.carried[SEQUENCE] = {"type": ["null", "integer"]}
    for i in range(level + 1):
        child.carried[LEVEL_FMT.format(i)] = {"type": ["integer"]}
    out.append(child)
    # Object items give plain columns; other items live in `_sdc_value`
    # (decision Q11: objects inside an anyOf are unwrapped too).
    for alt in _branches(items):
        if js.is_object(alt):
            _walk(alt, child, (), (), js.is_nullable(alt), key_schemas, out)
        elif js.is_array(alt):
            _child(alt["items"], child, (VALUE,), (VALUE,), key_schemas, out)
        elif js.is_literal(alt):
            _add_leaf(child, (VALUE,), deepcopy(alt))


def element_path(plan: TablePlan, rel: tuple[str, ...]) -> tuple[str, ...]:
    """Path inside the current element: ``_sdc_value`` means the element itself."""
    if plan.level is not None and rel and rel[0] == VALUE:
        return rel[1:]
    return rel


def leaf_alternatives(alts: list[dict]) -> list[dict]:
    """De-duplicated simple alternatives of one leaf, in declaration order."""
    seen, out = set(), []
    for a in alts:
        s = js.simple_type(a)
        if "default" in a:
            s["default"] = a["default"]
        key = js.canonical(js.simple_type(a))
        if key not in seen:
            seen.add(key)
            out.append(s)
    return out
