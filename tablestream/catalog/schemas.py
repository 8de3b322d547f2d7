"""Declared stream schemas used by the query catalogue (fixed test inputs)."""

from __future__ import annotations

INT = {"type": "integer"}
NUM = {"type": "number"}
STR = {"type": "string"}
DT = {"type": "string", "format": "date-time"}


def nullable(s: dict) -> dict:
    return {**s, "type": [s["type"], "null"]}


LINE = {
    "type": "object",
    "properties": {
        "l_orderkey": INT, "l_partkey": INT, "l_suppkey": INT, "l_linenumber": INT,
        "l_quantity": NUM, "l_extendedprice": NUM, "l_discount": NUM, "l_tax": NUM,
        "l_returnflag": STR, "l_linestatus": STR, "l_shipdate": DT,
    },
}

ORDERS = {
    "type": "object",
    "properties": {
        "o_orderkey": INT,
        "o_totalprice": NUM,
        "o_orderdate": DT,
        "customer": {"type": ["object", "null"], "properties": {
            "c_name": STR, "c_mktsegment": STR, "c_nationkey": INT}},
        "lines": {"type": "array", "items": LINE},
    },
}

EVENTS = {
    "type": "object",
    "properties": {
        "event_id": INT, "user_id": INT, "event_type": STR, "ts": DT,
        "value": NUM, "props": STR,
    },
}

# Rules checked by validate_records / invalid_by_stream.
EVENT_RULES = {
    "type": "object",
    "properties": {
        "event_id": {"type": "integer"},
        "user_id": {"type": "integer", "minimum": 0, "maximum": 140},
        "event_type": {"type": "string", "enum": ["click", "view", "purchase", "signup"]},
        "value": {"type": "number", "minimum": 1, "maximum": 90, "multipleOf": 0.05},
        "props": {"type": "string", "maxLength": 8},
    },
}

MIXED = {
    "type": "object",
    "properties": {
        "event_id": INT,
        "v": {"anyOf": [
            {"type": ["integer", "null"]},
            {"type": ["number", "null"]},
            {"type": ["boolean", "null"]},
            {"type": ["string", "null"], "format": "date-time"},
            {"type": ["string", "null"]},
        ]},
    },
}

NUMBER_ONLY = {"type": "object", "properties": {"event_id": INT, "v": nullable(NUM)}}

WITH_DEFAULT = {"type": "object",
                "properties": {"event_id": INT, "v": {"type": ["integer", "null"], "default": 7}}}

REQUIRED_V = {"type": "object", "properties": {"event_id": INT, "v": INT}}

DATETIME = {"type": "object", "properties": {"event_id": INT, "ts": DT}}

TEXT = {"type": "object", "properties": {"event_id": INT, "event_type": nullable(STR)}}

EMBEDDINGS = {
    "type": "object",
    "properties": {"vec_id": INT, "label": INT, "embedding": {"type": "array", "items": NUM}},
}

CONVERSATIONS = {
    "type": "object",
    "properties": {
        "conv_id": INT,
        "turns": {"type": "array", "items": {"type": "array", "items": STR}},
    },
}

DOCUMENTS = {"type": "object", "properties": {"doc_id": INT, "lang": STR, "source": STR,
                                              "_sdc_primary_key": nullable(STR)}}

CUSTOMER_V1 = {"type": "object", "properties": {"c_custkey": INT, "c_name": STR, "c_nationkey": INT}}
CUSTOMER_V2 = {"type": "object", "properties": {"c_custkey": INT, "c_name": STR, "c_nationkey": INT,
                                                "c_acctbal": NUM}}

SPLIT_INT = {"type": "object", "properties": {"event_id": INT, "v": nullable(INT)}}
SPLIT_STR = {"type": "object", "properties": {"event_id": INT, "v": nullable(STR)}}
SPLIT_BOOL = {"type": "object", "properties": {"event_id": INT, "v": nullable({"type": "boolean"})}}

ORDERS_VERSIONED = {"type": "object", "properties": {"o_orderkey": INT, "o_orderstatus": STR}}

EVENTS_KEYED = {"type": "object", "properties": {
    "event_id": INT, "user_id": INT, "event_type": STR, "value": NUM}}

DOCUMENT_TEXTS = {
    "type": "object",
    "properties": {
        "doc_id": INT, "text": STR, "lang": STR, "source": STR, "n_chars": INT,
        "labels": {"type": ["object", "null"], "properties": {"quality": INT, "toxic": INT}},
    },
}

EVENTS_WIDER = {"type": "object", "properties": {**EVENTS_KEYED["properties"], "note": nullable(STR)}}

ORDERS_TOTAL = {"type": "object", "properties": {"o_orderkey": INT, "o_orderstatus": STR, "o_totalprice": NUM}}

ODD_KEYS = {"type": "object", "properties": {
    "ID": INT, "account-id": STR, "Name": STR, "Words": {"type": "array", "items": STR}}}

# Rules of validate_keywords: every kind of keyword on order documents.
ORDER_RULES = {
    "type": "object",
    "required": ["o_orderkey", "customer"],
    "minProperties": 2,
    "maxProperties": 6,
    "additionalProperties": False,
    "patternProperties": {"^o_": {}},
    "properties": {
        "o_orderkey": {"type": "integer", "minimum": 0, "exclusiveMinimum": True},
        "o_totalprice": {"allOf": [{"type": "number"}, {"maximum": 400000}], "not": {"maximum": 1500}},
        "customer": {
            "type": "object",
            "dependencies": {"c_name": ["c_mktsegment"]},
            "properties": {"c_name": {"type": "string", "minLength": 5, "pattern": "[0-8]$"},
                           "c_mktsegment": {"oneOf": [{"enum": ["BUILDING", "MACHINERY"]}, {"enum": ["HOUSEHOLD", "BUILDING"]},
                                                      {"enum": ["AUTOMOBILE"]}]},
                           "c_nationkey": {"anyOf": [{"maximum": 15}, {"multipleOf": 2}]}},
        },
        "lines": {"type": "array", "minItems": 1, "maxItems": 8, "uniqueItems": True},
    },
}
