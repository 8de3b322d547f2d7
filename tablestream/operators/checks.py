"""Record validation against the declared schema.

The declared (original, not simplified) Draft-4 schema is compiled once on
the driver into Column expressions; each record gets ``_reasons``, an
``array<string>`` of violated rules (empty = valid).  Arrays are checked with
``exists`` over their items, so no row is exploded to validate it.

Keywords: all of Draft 4's (type, enum, the number, text, array and object
rules, allOf, anyOf, oneOf, not, $ref), and ``format: date-time`` (text that
does not parse is set aside instead of failing the load later, Q3/Q17); other
formats are not checked.  An integer that no bigint column can hold is invalid
unless the field may also be a number (P9).
"""

from __future__ import annotations

import json
from decimal import Decimal
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as V
from ..functions.barrier import compute_once
from ..functions.scalars import parse_datetime
from ..plans import jsonschema as js

REASONS = "_reasons"


class InvalidRecordsError(ValueError):
    def __init__(self, msg: str, counts: dict):
        super().__init__(msg)
        self.counts = counts


def _type_ok(kind: Column, allowed: list[str]) -> Column:
    ok = F.lit(False)
    for t in allowed:
        if t == js.NUMBER:
            ok = ok | kind.isin(js.NUMBER, js.INTEGER)
        else:
            ok = ok | (kind == t)
    return ok


def _equals(x: Column, kind: Column, num: Column, value: object) -> Column:
    """JSON equality of a variant with a constant: kind and value (1 and 1.0 are equal, 1 and "1" are not)."""
    if value is None:
        return kind == js.NULL
    if isinstance(value, bool):
        return (kind == js.BOOLEAN) & (V.typed(x, js.BOOLEAN) == F.lit(value))
    if isinstance(value, (int, float)):
        is_num = kind.isin(js.NUMBER, js.INTEGER)
        exact = isinstance(value, float) or abs(value) < 2**53
        return is_num & (num == F.lit(float(value)) if exact else V.literal_of(x) == str(value))
    if isinstance(value, str):
        return (kind == js.STRING) & (V.typed(x, js.STRING) == F.lit(value))
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return kind.isin(js.OBJECT, js.ARRAY) & (F.to_json(x) == text)


def _no_multiple(x: Column, num: Column, step: float) -> Column:
    """Whether a number is no multiple of ``step``: exact in decimals at the step's own scale, where a
    value with more decimal places is none; numbers beyond 38 digits, which JSON parsing holds as
    doubles, by their quotient."""
    places = max(0, -Decimal(str(step)).normalize().as_tuple().exponent)
    quotient = num / F.lit(float(step))
    by_double = quotient != F.floor(quotient)
    if places > 37:
        return by_double
    exact = F.try_variant_get(x, "$", f"decimal(38,{places})")
    fraction = F.regexp_extract(V.literal_of(x), r"^-?[0-9]+\.([0-9]*?)0*$", 1)
    plain = V.literal_of(x).rlike(r"^-?[0-9]+(\.[0-9]+)?$") & exact.isNotNull()
    divisor = F.lit(format(Decimal(str(step)), "f")).cast(f"decimal(38,{places})")
    return F.when(plain, (F.length(fraction) > places) | (exact % divisor != 0)).otherwise(by_double)


ARRAY_RULES = ("items", "minItems", "maxItems", "uniqueItems")
NAME_RULES = ("additionalProperties", "patternProperties", "minProperties", "maxProperties")


def _entries(x: Column) -> Column:
    return F.map_entries(F.try_variant_get(x, "$", "map<string,variant>"))


class _Staged:
    """A value held as columns: itself, its type and, where rules look at them, its items and entries; its
    properties by name."""

    def __init__(self, value: Column, kind: Column, items: Column | None, entries: Column | None):
        self.value, self.kind, self.items, self.entries = value, kind, items, entries
        self.below: dict[str, _Staged] = {}


class _Compiler:
    def __init__(self, root: dict):
        self.root = root

    def resolve(self, node: dict) -> dict:
        followed: set[str] = set()
        while isinstance(node, dict) and "$ref" in node:
            if node["$ref"] in followed:
                raise js.SchemaError(f"$ref {node['$ref']!r} is recursive")
            followed.add(node["$ref"])
            node = js.resolve_ref(self.root, node["$ref"])
        return node

    def violations(self, node: dict, x: Column, where: str, staged: _Staged | None = None) -> list[Column]:
        """``when(<violated>, reason)`` columns for value ``x`` (present values only).

        ``staged`` may hold pre-computed columns of ``x`` (see :func:`validate`).
        """
        node = self.resolve(node)
        kind = V.json_type(x) if staged is None else staged.kind
        present = x.isNotNull()
        out: list[Column] = []
        label = where or "record"

        def rule(cond: Column, reason: str) -> None:
            out.append(F.when(present & cond, F.lit(f"{label}: {reason}")))

        if "type" in node:
            allowed = js.types_of(node)
            rule(~_type_ok(kind, allowed), f"type is not {'/'.join(allowed)}")
        num = F.try_variant_get(x, "$", "double")
        is_num = kind.isin(js.NUMBER, js.INTEGER)
        if js.INTEGER in js.types_of(node) and js.NUMBER not in js.types_of(node):
            # no column could hold it
            rule((kind == js.INTEGER) & V.typed(x, js.INTEGER).isNull(), "integer out of range")
        if "enum" in node:
            ok = F.lit(False)
            for v in node["enum"]:
                ok = ok | F.coalesce(_equals(x, kind, num, v), F.lit(False))
            rule(~ok, "not in enum")
        if "minimum" in node:
            op = num <= F.lit(node["minimum"]) if node.get("exclusiveMinimum") else num < F.lit(node["minimum"])
            rule(is_num & op, f"below minimum {node['minimum']}")
        if "maximum" in node:
            op = num >= F.lit(node["maximum"]) if node.get("exclusiveMaximum") else num > F.lit(node["maximum"])
            rule(is_num & op, f"above maximum {node['maximum']}")
        if "multipleOf" in node:
            rule(is_num & _no_multiple(x, num, node["multipleOf"]), f"not a multiple of {node['multipleOf']}")
        s = V.typed(x, js.STRING)
        is_str = kind == js.STRING
        if "maxLength" in node:
            rule(is_str & (F.char_length(s) > node["maxLength"]), f"longer than {node['maxLength']}")
        if "minLength" in node:
            rule(is_str & (F.char_length(s) < node["minLength"]), f"shorter than {node['minLength']}")
        if "pattern" in node:
            rule(is_str & ~s.rlike(node["pattern"]), f"does not match {node['pattern']}")
        if node.get("format") == js.DATE_TIME:
            # Q3: text that is no date-time cannot be placed; an anyOf with a
            # plain string branch still accepts it (that branch passes).
            rule(is_str & parse_datetime(s).isNull(), "not a date-time")
        is_obj = kind == js.OBJECT
        props = node.get("properties", {})
        for name in node.get("required", []):
            rule(is_obj & self._field(x, name, staged).isNull(), f"{name} is required")
        out.extend(self._object_rules(node, x, is_obj, label, staged))
        for name, sub in props.items():
            label_n = f"{where}.{name}" if where else name
            inner = self.violations(sub, self._field(x, name, staged), label_n, staged.below.get(name) if staged else None)
            out.extend(F.when(is_obj, c) for c in inner)
        out.extend(self._array_rules(node, x, kind == js.ARRAY, label, staged))
        for sub in node.get("allOf", []):
            out.extend(self.violations(sub, x, where, staged))
        def matches(sub: dict) -> Column:
            return ~self._any(self.violations(sub, x, where, staged))

        if "anyOf" in node:
            rule(~reduce(or_, map(matches, node["anyOf"])), "matches no anyOf branch")
        if "oneOf" in node:
            hits = reduce(add, [matches(sub).cast("int") for sub in node["oneOf"]])
            rule(hits != 1, "does not match exactly one oneOf branch")
        if "not" in node:
            rule(matches(node["not"]), "matches the schema under not")
        return out

    @staticmethod
    def _field(x: Column, name: str, staged: _Staged | None) -> Column:
        return staged.below[name].value if staged and name in staged.below else V.at(x, (name,))

    def _object_rules(self, node: dict, x: Column, is_obj: Column, label: str,
                      staged: _Staged | None = None) -> list[Column]:
        """Rules on the set of names an object holds and on undeclared fields."""
        declared, patterns = list(node.get("properties", {})), node.get("patternProperties", {})
        entries = _entries(x) if staged is None or staged.entries is None else staged.entries
        out: list[Column] = []

        def rule(cond: Column, reason: str) -> None:
            out.append(F.when(x.isNotNull() & is_obj & cond, F.lit(f"{label}: {reason}")))

        def bad(sub: dict, value: Column) -> Column:
            return self._any(self.violations(sub, value, f"{label}.*"))

        def undeclared(name: Column) -> Column:
            free = ~name.isin(*declared) if declared else F.lit(True)
            return reduce(and_, [~name.rlike(p) for p in patterns], free)

        extra = node.get("additionalProperties")
        if extra is False:
            rule(F.exists(entries, lambda e: undeclared(e["key"])), "has undeclared properties")
        elif extra and extra is not True:
            rule(F.exists(entries, lambda e: undeclared(e["key"]) & bad(extra, e["value"])),
                 "an undeclared property is invalid")
        for pattern, sub in patterns.items():
            rule(F.exists(entries, lambda e: e["key"].rlike(pattern) & bad(sub, e["value"])),
                 f"a property like {pattern} is invalid")
        if "minProperties" in node:
            rule(F.size(entries) < node["minProperties"], f"fewer than {node['minProperties']} properties")
        if "maxProperties" in node:
            rule(F.size(entries) > node["maxProperties"], f"more than {node['maxProperties']} properties")
        for name, needs in node.get("dependencies", {}).items():
            has = self._field(x, name, staged).isNotNull()
            if isinstance(needs, list):
                for other in needs:
                    rule(has & self._field(x, other, staged).isNull(), f"{name} needs {other}")
            else:
                rule(has & self._any(self.violations(needs, x, label, staged)), f"{name} needs what it depends on")
        return out

    def _array_rules(self, node: dict, x: Column, is_arr: Column, label: str,
                     staged: _Staged | None = None) -> list[Column]:
        """Rules on the items of an array and their number."""
        arr = V.as_array(x) if staged is None or staged.items is None else staged.items
        out: list[Column] = []

        def rule(cond: Column, reason: str) -> None:
            out.append(F.when(x.isNotNull() & is_arr & cond, F.lit(f"{label}: {reason}")))

        def some_bad(sub: dict, items: Column) -> Column:
            return F.exists(items, lambda e: self._any(self.violations(sub, e, f"{label}[]")))

        items = node.get("items")
        if isinstance(items, dict):
            rule(some_bad(items, arr), "an item is invalid")
        elif isinstance(items, list):   # one schema per place, the rest under additionalItems
            for i, sub in enumerate(items):
                rule(some_bad(sub, F.slice(arr, i + 1, 1)), f"item {i} is invalid")
            more = node.get("additionalItems")
            if more is False:
                rule(F.size(arr) > len(items), f"more than {len(items)} items")
            elif more and more is not True:
                rule((F.size(arr) > len(items)) & some_bad(more, F.slice(arr, len(items) + 1, F.greatest(
                    F.size(arr) - len(items), F.lit(0)))), "an additional item is invalid")
        if "minItems" in node:
            rule(F.size(arr) < node["minItems"], f"fewer than {node['minItems']} items")
        if "maxItems" in node:
            rule(F.size(arr) > node["maxItems"], f"more than {node['maxItems']} items")
        if node.get("uniqueItems"):
            texts = F.transform(arr, lambda e: F.coalesce(F.to_json(e), F.lit("null")))
            rule(F.size(F.array_distinct(texts)) < F.size(arr), "items are not unique")
        return out

    @staticmethod
    def _any(cols: list[Column]) -> Column:
        if not cols:
            return F.lit(False)
        if len(cols) == 1:
            return cols[0].isNotNull()
        return F.exists(F.array(*cols), lambda r: r.isNotNull())


def reasons(schema: dict, record: Column, staged: _Staged | None = None) -> Column:
    """``array<string>`` of violated rules for ``record`` (empty = valid)."""
    cols = _Compiler(schema).violations(schema, record, "", staged)
    if not cols:
        return F.array().cast("array<string>")
    return F.filter(F.array(*cols), lambda r: r.isNotNull())


def _stage(df: DataFrame, schema: dict, record: Column) -> tuple[DataFrame, _Staged]:
    """``df`` with the columns of :class:`_Staged` for the record and every property its schema declares, one
    level of nesting after the other.  The columns added start with ``__c``."""
    comp, top, n = _Compiler(schema), None, 0
    level = [(None, "", comp.resolve(schema), record)]
    while level:
        ids = range(n, n := n + len(level))
        df = df.select("*", *[x.alias(f"__cv{i}") for i, (*_, x) in zip(ids, level)])
        df = df.select("*", *[F.schema_of_variant(f"__cv{i}").alias(f"__cs{i}") for i in ids])
        kinds, below = [], []
        for i, (parent, name, node, _) in zip(ids, level):
            x, node = F.col(f"__cv{i}"), node if isinstance(node, dict) else {}
            kinds.append(V.json_type_of_schema(F.col(f"__cs{i}")).alias(f"__ck{i}"))
            items, entries = any(k in node for k in ARRAY_RULES), any(k in node for k in NAME_RULES)
            if items:
                kinds.append(V.as_array(x).alias(f"__ca{i}"))
            if entries:
                kinds.append(_entries(x).alias(f"__ce{i}"))
            held = _Staged(x, F.col(f"__ck{i}"), F.col(f"__ca{i}") if items else None, F.col(f"__ce{i}") if entries else None)
            if parent is None:
                top = held
            else:
                parent.below[name] = held
            below += [(held, p, comp.resolve(sub), V.at(x, (p,))) for p, sub in node.get("properties", {}).items()]
        df, level = df.select("*", *kinds), below
    return df, top


def validate(records: DataFrame, schema: dict, record_col: str = "record") -> DataFrame:
    """``records`` plus ``_reasons``; ``size(_reasons) == 0`` means valid.

    The values, runtime types, items and entries that rules look at are materialised
    as columns first, for declared properties at every depth: the rules are evaluated
    one by one inside an array, where nothing that two of them share is computed once.
    """
    df, staged = _stage(records, schema, F.col(record_col))
    out = df.withColumn(REASONS, reasons(schema, staged.value, staged)).select(*records.columns, REASONS)
    return compute_once(out)   # split_valid / counts filter on the reasons


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    ok = F.size(F.col(REASONS)) == 0
    return checked.filter(ok).drop(REASONS), checked.filter(~ok)


def invalid_counts(checked: DataFrame) -> DataFrame:
    """Invalid records per stream."""
    return checked.filter(F.size(F.col(REASONS)) > 0).groupBy("stream").agg(F.count("*").alias("invalid"))


def enforce_threshold(counts: DataFrame, detect: bool = True, threshold: int = 0) -> None:
    """Raise when a stream has ``>= threshold`` invalid records (0 and 1 both raise on the first).

    Only the per-stream counts (one row per stream) reach the driver.
    """
    if detect:
        rows = counts.filter(F.col("invalid") >= max(threshold, 1)).collect()
        refuse_invalid({r["stream"]: r["invalid"] for r in rows}, threshold)


def refuse_invalid(counts: dict[str, int], threshold: int = 0) -> None:
    """P2 on known counts, such as those of a whole run."""
    got = {stream: n for stream, n in counts.items() if n >= max(threshold, 1)}
    if got:
        raise InvalidRecordsError(f"invalid records detected above threshold {threshold}: {got}", got)


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows holding NULL in a NOT NULL column, with the offending column names."""
    bad = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]), lambda r: r.isNotNull())
    return df.withColumn("_null_columns", bad).filter(F.size("_null_columns") > 0)


def require_not_null(df: DataFrame, columns: list[str]) -> None:
    """Abort the batch when a NOT NULL column holds NULL (one-row probe)."""
    hit = not_null_violations(df, columns).limit(1).collect()
    if hit:
        raise ValueError(f"NULL in NOT NULL column(s) {hit[0]['_null_columns']}")
