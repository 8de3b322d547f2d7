"""Schemas and records of the tests, after the driver's orders, conversations and documents."""

import functools

import duckdb

INT, TEXT, FLAG = {"type": "integer"}, {"type": "string"}, {"type": "boolean"}
WHEN = {"type": "string", "format": "date-time"}


def maybe(s: dict) -> dict:
    return {**s, "type": ["null", s["type"]]}


# Orders with their lines: a key, NOT NULL and nullable columns, one child table.
ORDERS = {"type": "object", "properties": {
    "o_orderkey": INT, "o_orderstatus": TEXT, "o_comment": maybe(TEXT),
    "lines": {"type": "array", "items": {"type": "object", "properties": {
        "l_partkey": INT, "l_returnflag": maybe(TEXT)}}}}}
LINES = ("orders", "lines")

# A conversation: defaults, a nested nullable object with a list of its own, lists in objects in lists.
CONVERSATION = {"type": "object", "properties": {
    "conv_id": INT,
    "channel": {"type": "string", "default": "web"},
    "n_turns": {"type": "integer", "default": 1},
    "opened": WHEN,
    "ended": {"type": ["object", "null"], "properties": {
        "at": maybe(WHEN), "solved": FLAG, "tags": {"type": "array", "items": TEXT}}},
    "turns": {"type": ["array", "null"], "items": {"type": ["object", "null"], "properties": {
        "role": maybe(TEXT), "scores": {"type": ["array", "null"], "items": {"type": "number"}}}}}}}

# A crawled document: lists of lists, and a path longer than an identifier.
DEEP = ("crawl_of_the_document", "response_of_the_server", "headers_in_the_order_they_came")
DOCUMENT = {"type": "object", "properties": {
    "doc_id": INT,
    "grid": {"type": "array", "items": {"type": "array", "items": INT}},
    DEEP[0]: {"type": "object", "properties": {
        DEEP[1]: {"type": "object", "properties": {"status": INT, DEEP[2]: {"type": "array", "items": TEXT}}}}}}}


def document(i: int) -> dict:
    """Rows of 0 to 3 numbers, ``i % 4`` of them, and two headers for every odd document."""
    return {"doc_id": i, "grid": [list(range(k)) for k in range(i % 4)],
            DEEP[0]: {DEEP[1]: {"status": 200 + i, DEEP[2]: ["a", "b"] if i % 2 else []}}}


# One field of many types; its object has a field whose column name a typed column takes.
MANY = {"type": "object", "properties": {
    "value": {"type": ["null", "integer", "boolean", "string", "object", "array"], "format": "date-time",
              "items": TEXT, "properties": {"b": TEXT, "n": INT}},
    "price": {"type": "number"}}}


@functools.cache
def order_rows(n: int) -> list[tuple]:
    """The first orders of the smallest driver tables: key, status, and part and flag of each line."""
    return duckdb.sql(f"""
        select o_orderkey, o_orderstatus, list([l_partkey::varchar, l_returnflag] order by l_partkey, l_returnflag)
        from '/root/testdata/sf0.001/orders.parquet' join '/root/testdata/sf0.001/lineitem.parquet' on l_orderkey = o_orderkey
        group by all order by 1 limit {n}""").fetchall()
