"""Property tests on the plan-time rules (no Spark)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tablestream.plans import jsonschema as js
from tablestream.plans.naming import MAX_IDENTIFIER, canonicalize, column_name, table_name, validate_identifier

LITS = st.sampled_from(["integer", "number", "boolean", "string", "null"])


def schemas():
    leaf = st.one_of(
        st.builds(lambda t: {"type": t}, LITS),
        st.builds(lambda ts: {"type": sorted(set(ts))}, st.lists(LITS, min_size=1, max_size=3)),
        st.just({"type": ["string", "null"], "format": "date-time"}),
    )
    return st.recursive(leaf, lambda kids: st.one_of(
        st.builds(lambda p: {"type": "object", "properties": p},
                  st.dictionaries(st.sampled_from(list("abcde")), kids, max_size=3)),
        st.builds(lambda i: {"type": ["array", "null"], "items": i}, kids),
        st.builds(lambda a: {"anyOf": a}, st.lists(kids, min_size=1, max_size=3)),
        st.builds(lambda a: {"allOf": a}, st.lists(kids, min_size=1, max_size=2)),
    ), max_leaves=8)


@settings(max_examples=200, deadline=None)
@given(schemas())
def test_simplify_is_idempotent(schema):
    once = js.simplify(schema)
    assert js.simplify(once) == once


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(min_size=0, max_size=80), min_size=1, max_size=4))
def test_column_names_fit_and_are_unique(parts):
    maps = []
    seen = set()
    for i in range(3):
        path = tuple(parts) + (str(i),) * (i > 0)
        for suffix in ("i", "s"):
            name = column_name(path, suffix, maps)
            maps.append({"from": path, "suffix": suffix, "to": name})
            assert len(name) <= MAX_IDENTIFIER and name == canonicalize(name)
            assert name not in seen
            seen.add(name)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.from_regex(r"[A-Za-z][A-Za-z0-9 _#!-]{0,90}", fullmatch=True), min_size=1, max_size=5))
def test_table_names_are_valid_identifiers(paths):
    names = {}
    for p in paths:
        names[(p,)] = table_name((p,), names)
        validate_identifier(names[(p,)])
    assert len(set(names.values())) == len(names)
