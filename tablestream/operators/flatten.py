"""apply_schema: VARIANT records -> one typed DataFrame per table.

Input: a DataFrame with a VARIANT ``record`` column plus the stamped metadata
columns (see :mod:`tablestream.operators.stamp`).  Output: ``{table path:
DataFrame}``.  Everything is a projection or a ``posexplode`` over the input;
nothing leaves the executors.

* Objects flatten into ``a__b__c`` columns; undeclared fields are not read.
* Each array path explodes into its own child table; scalar items go to
  ``_sdc_value``; every level keeps a 0-based ``_sdc_level_<n>_id`` and the
  root keys (``_sdc_source_key_<k>``) and ``_sdc_sequence``.  Empty and null
  arrays give no rows; a null item gives a row of nulls.
* A value lands in the column whose type equals its runtime type; an integer
  falls back to the number column when the path has no integer column;
  strings of a date-time path are parsed (unparsable text goes to the
  string column when declared, else it is reported as unplaced).
* A declared default fills a missing or null value; the string ``NULL`` is
  stored as NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variant as V
from ..functions.scalars import NULL_LITERAL, null_literal, parse_datetime
from ..plans import jsonschema as js
from ..plans.evolve import Layout, evolve
from ..plans.naming import table_name
from ..plans.tables import (LEVEL_FMT, SEQUENCE, SOURCE_KEY_PREFIX, TablePlan,
                            element_path, leaf_alternatives)

ELEMENT = "__element"
UNPLACED = "_unplaced"


def default_layouts(plans: list[TablePlan]) -> dict[tuple, Layout]:
    """Layouts of fresh tables for ``plans`` (names per N5, columns per E1)."""
    names: dict[tuple, str] = {}
    out = {}
    for p in plans:
        names[p.path] = table_name(p.path, names)
        out[p.path] = evolve(None, p, names[p.path])[0]
    return out


def _spark_type(m: dict) -> str:
    return js.spark_type_name(m)


class _Leaf:
    """Per-leaf helper columns, materialised in stages so each expensive
    expression (sub-variant copy, schema string, text, date parse) runs once."""

    def __init__(self, i: int, path: tuple, alts: list[dict], layout: Layout):
        self.i, self.path, self.alts = i, path, alts
        self.maps = [m for m in layout.mappings if m["from"] == tuple(path)]
        self.by_suffix = {js.shorthand(m): m for m in self.maps}
        simple = leaf_alternatives(alts)
        self.has_dt = any(js.is_datetime(a) for a in simple) and "t" in self.by_suffix
        self.needs_text = "s" in self.by_suffix or self.has_dt
        self.default = next((a["default"] for a in alts if a.get("default") is not None), None)
        self.v, self.s, self.k = f"__v{i}", f"__s{i}", f"__k{i}"
        self.x, self.t = f"__x{i}", f"__t{i}"

    def stage_value(self, elem: Column, rel: tuple) -> list[Column]:
        return [V.at(elem, rel).alias(self.v)] if self.maps else []

    def stage_schema(self) -> list[Column]:
        if not self.maps:
            return []
        out = [F.schema_of_variant(F.col(self.v)).alias(self.s)]
        if self.needs_text:
            out.append(V.typed(F.col(self.v), js.STRING).alias(self.x))
        return out

    def stage_kind(self) -> list[Column]:
        if not self.maps:
            return []
        out = [V.json_type_of_schema(F.col(self.s)).alias(self.k)]
        if self.has_dt:
            out.append(parse_datetime(F.col(self.x)).alias(self.t))
        return out

    def columns(self, null_text: str | None) -> tuple[list[tuple[str, Column]], Column | None]:
        """Layout columns fed by this leaf, plus an 'unplaced' flag."""
        if not self.maps:
            return [], None
        x, kind, s = F.col(self.v), F.col(self.k), F.col(self.s)
        text = F.col(self.x) if self.needs_text else None
        parsed = F.col(self.t) if self.has_dt else None
        missing = kind == js.NULL
        cols: list[tuple[str, Column]] = []
        placed: list[Column] = []
        for suffix, m in self.by_suffix.items():
            if suffix == "i":
                val = F.when(V.is_integer(s), V.typed(x, js.INTEGER))
                cond = V.is_integer(s) & V.typed(x, js.INTEGER).isNotNull()
            elif suffix == "f":
                cond = V.is_numeric(s)
                if "i" in self.by_suffix:   # integers too wide for their own column come here
                    cond = cond & (~V.is_integer(s) | V.typed(x, js.INTEGER).isNull())
                val = F.when(cond, V.typed(x, js.NUMBER))
            elif suffix == "b":
                cond = V.is_kind(s, js.BOOLEAN)
                val = F.when(cond, V.typed(x, js.BOOLEAN))
            elif suffix == "t":
                cond = V.is_kind(s, js.STRING) & parsed.isNotNull()
                val = F.when(V.is_kind(s, js.STRING), parsed)
            elif suffix == "s":
                cond = V.is_kind(s, js.STRING)
                if parsed is not None:
                    cond = cond & parsed.isNull()
                val = null_literal(F.when(cond, text), null_text)
            else:
                continue
            placed.append(cond)
            if self.default is not None and _default_suffix(self.default) == suffix:
                val = F.when(missing, F.lit(self.default)).otherwise(val)
            cols.append((m["to"], val.cast(_spark_type(m))))
        ok = missing | kind.isin(js.OBJECT, js.ARRAY)   # structures go to fields / child tables
        for p in placed:
            ok = ok | p
        return cols, F.when(~ok, F.lit(".".join(self.path)))


def _project_leaves(df: DataFrame, keep_cols: list[Column], elem: Column, leaves: list["_Leaf"],
                    rel_of, null_text: str | None) -> tuple[DataFrame, list[tuple[str, Column]], list[Column]]:
    """Stage the helper columns of ``leaves`` on ``df``; return the final columns."""
    df = df.select(*keep_cols, *[c for lf in leaves for c in lf.stage_value(elem, rel_of(lf.path))])
    df = df.select("*", *[c for lf in leaves for c in lf.stage_schema()])
    df = df.select("*", *[c for lf in leaves for c in lf.stage_kind()])
    cols, flags = [], []
    for lf in leaves:
        c, f = lf.columns(null_text)
        cols.extend(c)
        if f is not None:
            flags.append(f)
    return df, cols, flags


def _default_suffix(value) -> str:
    if isinstance(value, bool):
        return "b"
    if isinstance(value, int):
        return "i"
    if isinstance(value, float):
        return "f"
    return "s"


def apply_schema(records: DataFrame, plans: list[TablePlan],
                 layouts: dict[tuple, Layout] | None = None,
                 record_col: str = "record", null_text: str | None = NULL_LITERAL,
                 with_unplaced: bool = False, keep: tuple[str, ...] = ()) -> dict[tuple, DataFrame]:
    """Typed DataFrames for every table of a stream, root first.

    ``records`` holds ``record_col`` (VARIANT) and the stamped metadata
    columns that exist (``_sdc_sequence`` ...).  Metadata columns win over
    record fields of the same name (stamping already applied precedence).
    ``keep`` names input columns copied unchanged onto every table (e.g. the
    record position, to break sequence ties).
    """
    layouts = layouts or default_layouts(plans)
    root = plans[0]
    rec = F.col(record_col)
    meta = [c for c in records.columns if c.startswith("_sdc_")]

    # Root key values (typed) and sequence are carried into every child.
    root_layout = layouts[root.path]
    carry: list[Column] = []
    carried_as = {SOURCE_KEY_PREFIX + k: f"__key{i}" for i, k in enumerate(root.key_properties)}
    for k in root.key_properties:
        m = next((m for m in root_layout.mappings if m["from"] == (k,)), None)
        if k in meta:
            src = F.col(k)
        else:   # typed only when the runtime type is the key's declared type
            kv, kind = V.at(rec, (k,)), _kind_of(m)
            src = F.when(V.is_kind(F.schema_of_variant(kv), kind), V.typed(kv, kind))
        carry.append(src.cast(_spark_type(m) if m else "string").alias(carried_as[SOURCE_KEY_PREFIX + k]))
    seq = (F.col(SEQUENCE) if SEQUENCE in meta else V.typed(V.at(rec, (SEQUENCE,)), js.INTEGER)).cast("bigint")

    out: dict[tuple, DataFrame] = {}
    for plan in plans:
        layout = layouts[plan.path]
        if plan.is_root:
            cols = []
            leaves = []
            for i, (path, alts) in enumerate(plan.leaves.items()):
                if len(path) == 1 and path[0] in meta:
                    for m in layout.mappings:
                        if m["from"] == path:
                            cols.append((m["to"], F.col(path[0]).cast(_spark_type(m))))
                else:
                    leaves.append(_Leaf(i, path, alts, layout))
            base = [F.col(c) for c in dict.fromkeys([*meta, *keep])] + [rec.alias(ELEMENT)]
            df, lcols, flags = _project_leaves(records, base, F.col(ELEMENT), leaves,
                                               lambda p: p, null_text)
            df = df.select(*_order(cols + lcols, layout), *_flag(flags, with_unplaced), *keep)
        else:
            df = records.select(*carry, seq.alias(SEQUENCE), *keep, rec.alias(ELEMENT))
            for i, rel in enumerate(plan.arrays):
                rel_in = rel if i == 0 else element_path(plan, rel)
                lvl = LEVEL_FMT.format(i)
                df = df.select(*[F.col(c) for c in df.columns if c != ELEMENT],
                               F.posexplode(V.as_array(F.col(ELEMENT), rel_in)).alias(lvl, ELEMENT))
                df = df.withColumn(lvl, F.col(lvl).cast("bigint"))
            cols = []
            for name in plan.carried:
                for m in layout.mappings:
                    if m["from"] == (name,):
                        cols.append((m["to"], F.col(carried_as.get(name, name)).cast(_spark_type(m))))
            leaves = [_Leaf(i, path, alts, layout) for i, (path, alts) in enumerate(plan.leaves.items())]
            base = [F.col(c) for c in df.columns]
            df, lcols, flags = _project_leaves(df, base, F.col(ELEMENT), leaves,
                                               lambda p: element_path(plan, p), null_text)
            df = df.select(*_order(cols + lcols, layout), *_flag(flags, with_unplaced), *keep)
        out[plan.path] = df
    return out


def _kind_of(m: dict | None) -> str:
    if m is None:
        return js.STRING
    kinds = [t for t in js.types_of(m) if t != js.NULL]
    return kinds[0] if kinds else js.STRING


def _order(cols: list[tuple[str, Column]], layout: Layout) -> list[Column]:
    """Pad to the full layout (P13) in layout order; first value wins."""
    by_name: dict[str, Column] = {}
    for name, c in cols:
        by_name[name] = F.coalesce(by_name[name], c) if name in by_name else c
    return [by_name.get(name, F.lit(None)).cast(t).alias(name) for name, t, _ in layout.columns()]


def _flag(flags: list[Column], on: bool) -> list[Column]:
    if not on:
        return []
    arr = F.filter(F.array(*flags), lambda x: x.isNotNull()) if flags else F.array().cast("array<string>")
    return [arr.alias(UNPLACED)]
