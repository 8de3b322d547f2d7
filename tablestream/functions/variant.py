"""Column expressions over VARIANT values (all JVM-side, codegen friendly).

``parse_json`` keeps JSON numbers exact (DECIMAL up to 38 digits), so the
runtime type of a value is read from ``schema_of_variant`` *before* the value
is extracted; ``try_variant_get`` alone would coerce (``true`` -> 1).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans import jsonschema as js

# Runtime tags reported by schema_of_variant, by JSON Schema type.
INTEGER_TAGS = ("BIGINT", "INT", "SMALLINT", "TINYINT")
NUMBER_TAGS = ("DECIMAL", "DOUBLE", "FLOAT")
BOOLEAN_TAGS = ("BOOLEAN",)
STRING_TAGS = ("STRING",)
NULL_TAGS = ("VOID",)
WIDE_INTEGER = r"^DECIMAL\((19|[2-3][0-9]),0\)$"


def json_path(path: tuple[str, ...] | list[str]) -> str:
    """``$["a"]["b"]`` for a path of raw field names (quotes picked per name)."""
    out = "$"
    for part in path:
        if '"' not in part:
            out += f'["{part}"]'
        elif "'" not in part:
            out += f"['{part}']"
        else:
            raise ValueError(f"field name holds both quote kinds: {part!r}")
    return out


def at(v: Column, path: tuple[str, ...]) -> Column:
    """The variant at ``path`` (SQL NULL when absent)."""
    if not path:
        return v
    return F.try_variant_get(v, json_path(path), "variant")


def json_type(v: Column) -> Column:
    """JSON Schema type name of a variant value (``null`` when absent or JSON null)."""
    return json_type_of_schema(F.schema_of_variant(v))


def json_type_of_schema(s: Column) -> Column:
    """JSON Schema type name from a ``schema_of_variant`` string.

    Callers that test the type several times should materialise ``s`` (or
    this result) as a column first, so the schema is computed once per value.
    A JSON integer wider than bigint parses as DECIMAL(n,0) with n > 18; it is
    reported as an integer, so it is rejected by range rather than silently
    stored as a number.
    """
    wide = s.startswith("DECIMAL") & s.rlike(WIDE_INTEGER)
    tag = F.substring_index(F.substring_index(s, "<", 1), "(", 1)
    return F.coalesce(F.when(wide, F.lit(js.INTEGER)), F.element_at(_types_by_tag(), tag), F.lit(js.NULL))


def _types_by_tag() -> Column:
    """One literal map (a loop in generated code) instead of a branch per tag; see :func:`is_integer`."""
    names = {js.INTEGER: INTEGER_TAGS, js.NUMBER: NUMBER_TAGS, js.BOOLEAN: BOOLEAN_TAGS, js.STRING: STRING_TAGS,
             js.ARRAY: ("ARRAY",), js.OBJECT: ("OBJECT",)}
    return F.create_map(*[F.lit(x) for kind, tags in names.items() for tag in tags for x in (tag, kind)])


def is_integer(s: Column) -> Column:
    """Whether a ``schema_of_variant`` string is that of an integer (as in :func:`json_type_of_schema`, in far
    less generated code: methods above 8000 bytes are never compiled by the JVM)."""
    return s.isin(*INTEGER_TAGS) | s.rlike(WIDE_INTEGER)


def is_numeric(s: Column) -> Column:
    """Whether a ``schema_of_variant`` string is that of a number or an integer."""
    return s.isin(*INTEGER_TAGS, "DOUBLE", "FLOAT") | s.startswith("DECIMAL")


def is_kind(s: Column, kind: str) -> Column:
    """Whether a ``schema_of_variant`` string is of a literal type; integers are numbers too."""
    if kind == js.INTEGER:
        return is_integer(s)
    if kind == js.NUMBER:
        return is_numeric(s)
    if kind in (js.BOOLEAN, js.STRING):
        return s == kind.upper()
    return json_type_of_schema(s) == kind


def as_array(v: Column, path: tuple[str, ...] = ()) -> Column:
    """``array<variant>`` when the value (at ``path``) is a JSON array, else NULL."""
    return F.try_variant_get(v, json_path(path), "array<variant>")


def typed(v: Column, kind: str) -> Column:
    """Value of a variant extracted as one JSON Schema literal type (no guard)."""
    if kind == js.INTEGER:
        return F.try_variant_get(v, "$", "bigint")
    if kind == js.NUMBER:
        return F.try_variant_get(v, "$", "double")
    if kind == js.BOOLEAN:
        return F.try_variant_get(v, "$", "boolean")
    return F.try_variant_get(v, "$", "string")


def literal_of(v: Column) -> Column:
    """Text of a literal value, for rules that look at strings."""
    return F.try_variant_get(v, "$", "string")
