"""DuckDB SQL oracles, one per query, written against the *original* tables.

None of them repeats the JSON path: each states the expected result
directly from the relational source (see SURVEY 7.3).
"""

from __future__ import annotations

# 100-microsecond truncation of a timestamp (stored date-time resolution).
def _t100(col: str) -> str:
    return f"make_timestamp(CAST(floor(epoch_us({col}) / 100) * 100 AS BIGINT))"


SEQ = "((event_id * 7919) % 10007)"
LINE_ORDER = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
              "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")
LINE_SELECT = ("l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, "
               "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus")

RULES = {
    "user_id_max": "CASE WHEN user_id > 140 THEN 'user_id: above maximum 140' END",
    "enum": "CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup') THEN 'event_type: not in enum' END",
    "vmin": "CASE WHEN value < 1 THEN 'value: below minimum 1' END",
    "vmax": "CASE WHEN value > 90 THEN 'value: above maximum 90' END",
    "vmul": "CASE WHEN CAST(CAST(value AS VARCHAR) AS DECIMAL(38,18)) % 0.05 <> 0 "
            "THEN 'value: not a multiple of 0.05' END",
    "props": "CASE WHEN length(props) > 8 THEN 'props: longer than 8' END",
}
REASONS = "concat_ws('; ', " + ", ".join(RULES.values()) + ")"


# batch of an event in a load of two batches
PART = "CAST(least(floor(event_id * 2.0 / (SELECT max(event_id) + 1 FROM events)), 1) AS BIGINT)"


def _latest(where: str) -> str:
    return f"""SELECT * FROM (
      SELECT user_id, event_id, event_type, value, {SEQ} AS seq,
             row_number() OVER (PARTITION BY user_id ORDER BY {SEQ} DESC NULLS FIRST, event_id DESC) AS rn
      FROM events WHERE {where}) WHERE rn = 1"""


STORED = _latest("event_id % 3 <> 0 AND user_id % 5 <> 0")
INCOMING = _latest("NOT (event_id % 3 <> 0 AND user_id % 5 <> 0)")
SPLIT = f"WITH s AS ({STORED}), i AS ({INCOMING})"

UPSERT = f"""{SPLIT}
SELECT coalesce(i.user_id, s.user_id) AS user_id,
       CASE WHEN i.user_id IS NOT NULL AND (s.user_id IS NULL OR i.seq >= s.seq) THEN i.event_id ELSE s.event_id END AS event_id,
       CASE WHEN i.user_id IS NOT NULL AND (s.user_id IS NULL OR i.seq >= s.seq) THEN i.event_type ELSE s.event_type END AS event_type,
       CASE WHEN i.user_id IS NOT NULL AND (s.user_id IS NULL OR i.seq >= s.seq) THEN i.value ELSE s.value END AS value,
       CAST(CASE WHEN i.user_id IS NOT NULL AND (s.user_id IS NULL OR i.seq >= s.seq) THEN i.seq ELSE s.seq END AS BIGINT) AS _sdc_sequence
FROM s FULL OUTER JOIN i ON s.user_id = i.user_id"""

ORACLES: dict[str, str] = {
    "read_messages": """
SELECT event_id * 10 AS pos,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'RECORD' END AS msg_type,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_type END AS stream,
       CASE WHEN event_id % 97 = 0 THEN 'unparsable' END AS bad_reason
FROM events""",

    "route_messages": """
SELECT 'RECORD' AS msg_type, event_type AS stream, count(*) AS n FROM events GROUP BY event_type
UNION ALL SELECT 'SCHEMA', event_type, CAST(1 AS BIGINT) FROM events GROUP BY event_type
UNION ALL SELECT 'STATE', NULL, count(*) FROM events WHERE event_id % 100 = 99""",

    "orphan_records": """
SELECT e.event_id * 10 AS pos, e.event_type AS stream
FROM events e JOIN (SELECT event_type, min(event_id) AS m FROM events GROUP BY event_type) f
  ON e.event_type = f.event_type
WHERE e.event_id < f.m + 50""",

    "schema_in_force": """
SELECT e.event_id * 10 AS pos, e.event_type AS stream, f.m * 10 - 5 AS schema_pos
FROM events e JOIN (SELECT event_type, event_id // 1000 AS b, min(event_id) AS m
                    FROM events GROUP BY event_type, event_id // 1000) f
  ON e.event_type = f.event_type AND e.event_id // 1000 = f.b""",

    "validate_records": f"""
SELECT event_id * 10 AS pos, event_type AS stream, {REASONS} = '' AS is_valid, {REASONS} AS reasons
FROM events""",

    "invalid_by_stream": f"""
SELECT event_type AS stream, count(*) AS invalid FROM events WHERE {REASONS} <> '' GROUP BY event_type""",

    "latest_version_rows": """
SELECT e.event_id * 10 AS pos, e.event_type AS stream, e.event_id // 4000 AS version
FROM events e JOIN (SELECT event_type, max(event_id // 4000) AS mv FROM events GROUP BY event_type) m
  ON e.event_type = m.event_type
WHERE e.event_id // 4000 = m.mv""",

    "load_metadata": f"""
SELECT event_id * 10 AS pos,
       CAST(CASE WHEN event_id % 3 <> 0 THEN {SEQ} ELSE 1706745600 END AS BIGINT) AS _sdc_sequence,
       CASE WHEN event_id % 4 = 0 THEN event_id // 1000 END AS _sdc_table_version,
       CASE WHEN event_id % 5 = 0 THEN TIMESTAMP '2024-03-01 00:00:00'
            WHEN event_id % 2 = 0 THEN {_t100('ts')} END AS _sdc_received_at,
       TIMESTAMP '2024-02-01 00:00:00' AS _sdc_batched_at
FROM events""",

    "surrogate_key": """
SELECT doc_id,
       CASE WHEN doc_id % 10 = 0 THEN 'pk-' || CAST(doc_id AS VARCHAR)
            ELSE sha256('documents|' || CAST(doc_id AS VARCHAR)) END AS _sdc_primary_key
FROM documents""",

    "flatten_objects": """
SELECT o_orderkey, o_totalprice, o_orderdate, c_name AS customer__c_name,
       c_mktsegment AS customer__c_mktsegment, CAST(c_nationkey AS BIGINT) AS customer__c_nationkey
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",

    "load_documents": """
SELECT d.doc_id, nullif(d.text, 'NULL') AS text, nullif(d.lang, 'NULL') AS lang,
       nullif(d.source, 'NULL') AS source, d.n_chars,
       CAST(l.quality AS BIGINT) AS labels__quality, CAST(l.toxic AS BIGINT) AS labels__toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",

    "type_split": f"""
SELECT event_id,
       CASE WHEN event_type = 'click' THEN CAST(floor(value) AS BIGINT) END AS v__i,
       CASE WHEN event_type = 'view' THEN value END AS v__f,
       CASE WHEN event_type = 'error' THEN value > 25 END AS v__b,
       CASE WHEN event_type = 'purchase' THEN 'u' || CAST(user_id AS VARCHAR) END AS v__s,
       CASE WHEN event_type = 'signup' AND event_id % 2 = 0 THEN {_t100('ts')} END AS v__t
FROM events""",

    "int_to_number": """
SELECT event_id, CASE WHEN event_type = 'click' THEN CAST(floor(value) AS DOUBLE) ELSE value END AS v
FROM events""",

    "default_fill": """
SELECT event_id, CAST(CASE WHEN event_id % 2 = 1 OR event_id % 4 = 2 THEN 7 ELSE floor(value) END AS BIGINT) AS v
FROM events""",

    "datetime_norm": f"SELECT event_id, {_t100('ts')} AS ts FROM events",

    "null_literal": """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type FROM events""",

    "not_null_check": "SELECT event_id FROM events WHERE event_type = 'signup' AND event_id % 2 = 1",

    "unnest_lines": f"""
SELECT l_orderkey AS _sdc_source_key_o_orderkey,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) - 1 AS BIGINT) AS _sdc_level_0_id,
       {LINE_SELECT}, {_t100('l_shipdate')} AS l_shipdate
FROM lineitem""",

    "unnest_scalars": """
SELECT vec_id AS _sdc_source_key_vec_id, CAST(i - 1 AS BIGINT) AS _sdc_level_0_id,
       CAST(embedding[i] AS DOUBLE) AS _sdc_value
FROM embeddings, range(1, len(embedding) + 1) AS r(i)""",

    "unnest_nested": """
WITH t AS (SELECT conv_id,
                  CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS l0,
                  string_split(text, ' ') AS w
           FROM conversations)
SELECT conv_id AS _sdc_source_key_conv_id, l0 AS _sdc_level_0_id,
       CAST(i - 1 AS BIGINT) AS _sdc_level_1_id, w[i] AS _sdc_value
FROM t, range(1, len(w) + 1) AS r(i)""",

    "flatten_all_counts": """
SELECT 'orders' AS table_name, count(*) AS n FROM orders
UNION ALL SELECT 'orders__lines', count(*) FROM lineitem
UNION ALL SELECT 'conversations', count(DISTINCT conv_id) FROM conversations
UNION ALL SELECT 'conversations__turns', count(*) FROM conversations
UNION ALL SELECT 'conversations__turns___sdc_value', CAST(sum(len(string_split(text, ' '))) AS BIGINT)
          FROM conversations""",

    "latest_per_key": f"""
SELECT user_id, event_id, CAST(seq AS BIGINT) AS _sdc_sequence FROM ({_latest('TRUE')})""",

    "latest_child_rows": f"""
WITH l AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, o_orderstatus,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) - 1 AS idx,
         count(*) OVER (PARTITION BY l_orderkey) AS n
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT l_orderkey AS _sdc_source_key_o_orderkey,
       CAST(CASE WHEN o_orderstatus = 'F' THEN n - 1 - idx ELSE idx END AS BIGINT) AS _sdc_level_0_id,
       l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS BIGINT) AS _sdc_sequence
FROM l""",

    "replaceable_keys": f"""{SPLIT}
SELECT i.user_id FROM i JOIN s ON i.user_id = s.user_id AND i.seq >= s.seq""",

    "insert_new_keys": f"""{SPLIT}
SELECT i.user_id, i.event_id, CAST(i.seq AS BIGINT) AS _sdc_sequence
FROM i LEFT JOIN s ON i.user_id = s.user_id
WHERE s.user_id IS NULL OR i.seq >= s.seq""",

    "upsert_latest": UPSERT,

    "upsert_stats": f"""{SPLIT}
SELECT CASE WHEN i.user_id IS NULL OR (s.user_id IS NOT NULL AND i.seq < s.seq) THEN 'kept'
            WHEN s.user_id IS NOT NULL THEN 'replaced' ELSE 'inserted' END AS _action,
       count(*) AS n
FROM s FULL OUTER JOIN i ON s.user_id = i.user_id GROUP BY 1""",

    "late_rows": f"""{SPLIT}
SELECT i.user_id, i.event_id, CAST(i.seq AS BIGINT) AS _sdc_sequence
FROM i JOIN s ON i.user_id = s.user_id AND i.seq < s.seq""",

    "upsert_children": f"""
WITH base AS (
  SELECT l.*, o_orderpriority,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) - 1 AS idx
  FROM lineitem l JOIN orders ON o_orderkey = l_orderkey),
re AS (
  SELECT l.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) - 1 AS idx
  FROM lineitem l JOIN orders ON o_orderkey = l_orderkey
  WHERE o_orderpriority = '1-URGENT' AND l_linestatus = 'O')
SELECT l_orderkey AS _sdc_source_key_o_orderkey, CAST(idx AS BIGINT) AS _sdc_level_0_id, l_partkey,
       CAST(l_linenumber AS BIGINT) AS l_linenumber, l_linestatus, CAST(1 AS BIGINT) AS _sdc_sequence
FROM base WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
UNION ALL
SELECT l_orderkey, CAST(idx AS BIGINT), l_partkey, CAST(l_linenumber AS BIGINT), l_linestatus,
       CAST(2 AS BIGINT)
FROM re""",

    "stale_version_skip": f"""
SELECT user_id, event_id, CAST(2 AS BIGINT) AS _sdc_table_version FROM ({_latest('TRUE')})""",

    "activate_version": """
SELECT o_orderkey, o_orderstatus, CAST(2 AS BIGINT) AS _sdc_table_version FROM orders WHERE o_orderstatus = 'O'""",

    "evolve_union": """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END AS c_acctbal
FROM customer""",

    "split_column": """
SELECT event_id,
       CASE WHEN event_type <> 'purchase' THEN CAST(floor(value) AS BIGINT) END AS v__i,
       CASE WHEN event_type = 'purchase' THEN 'u' || CAST(user_id AS VARCHAR) END AS v__s
FROM events""",

    "split_column_third": """
SELECT event_id,
       CASE WHEN event_type NOT IN ('purchase', 'error') THEN CAST(floor(value) AS BIGINT) END AS v__i,
       CASE WHEN event_type = 'purchase' THEN 'u' || CAST(user_id AS VARCHAR) END AS v__s,
       CASE WHEN event_type = 'error' THEN value > 25 END AS v__b
FROM events""",

    "canonical_names": """
SELECT 'part' AS source, p_partkey AS id, p_name AS raw,
       substr(regexp_replace(lower(CASE WHEN p_name = '' THEN '_' ELSE p_name END), '[^a-z0-9_$]', '_', 'g'), 1, 63) AS name
FROM part
UNION ALL
SELECT 'pages', page_id, url,
       substr(regexp_replace(lower(CASE WHEN url = '' THEN '_' ELSE url END), '[^a-z0-9_$]', '_', 'g'), 1, 63)
FROM pages""",

    "name_collisions": """
WITH raw AS (
  SELECT raw, min(arrival) AS arrival FROM (
    SELECT p_brand AS raw, p_partkey * 2 AS arrival FROM part
    UNION ALL SELECT upper(p_brand), p_partkey * 2 + 1 FROM part) GROUP BY raw),
c AS (SELECT raw, arrival, substr(regexp_replace(lower(raw), '[^a-z0-9_$]', '_', 'g'), 1, 63) AS canon FROM raw),
n AS (SELECT raw, canon, row_number() OVER (PARTITION BY canon ORDER BY arrival, raw) - 1 AS k FROM c)
SELECT raw, CASE WHEN k = 0 THEN canon
                 ELSE substr(canon, 1, 63 - length('__' || CAST(k AS VARCHAR))) || '__' || CAST(k AS VARCHAR) END AS name
FROM n""",

    "name_collisions_hot": """
WITH raw AS (SELECT raw, min(arrival) AS arrival FROM (
    SELECT CASE WHEN l_orderkey % 3 = 0 THEN '-' ELSE 'a' END
             || translate(concat_ws('/', l_orderkey, l_linenumber, l_partkey, l_suppkey), '0123456789', '+,-.:;=!?*') AS raw,
           l_orderkey * 1000 + l_partkey % 1000 AS arrival FROM lineitem) GROUP BY raw),
c AS (SELECT raw, arrival, substr(regexp_replace(lower(raw), '[^a-z0-9_$]', '_', 'g'), 1, 63) AS canon FROM raw),
n AS (SELECT raw, canon, row_number() OVER (PARTITION BY canon ORDER BY arrival, raw) - 1 AS k FROM c)
SELECT raw, CASE WHEN k = 0 THEN canon
                 ELSE substr(canon, 1, 63 - length('__' || CAST(k AS VARCHAR))) || '__' || CAST(k AS VARCHAR) END AS name
FROM n""",

    "load_counts": """
SELECT (SELECT count(*) FROM orders) AS records_persisted,
       (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem) AS rows_persisted""",

    "safe_bookmarks": f"""
WITH c AS (SELECT {PART} AS batch, event_type AS stream, min(event_id) * 10 AS first_pos FROM events GROUP BY 1, 2),
n AS (SELECT stream, first_pos, row_number() OVER (ORDER BY batch, stream) AS n FROM c),
t AS (SELECT *, min(first_pos) OVER (ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS threshold FROM n)
SELECT n, stream, threshold,
       (SELECT max(event_id * 10 + 5) FROM events
        WHERE event_id % 100 = 99 AND (threshold IS NULL OR event_id * 10 + 5 < threshold)) AS state_pos
FROM t""",

    "load_metrics": f"""
SELECT {PART} AS batch, CASE WHEN {PART} = 0 THEN 1 ELSE 0 END AS segment, event_type AS table_name,
       count(DISTINCT user_id) AS rows, min(event_id) * 10 AS first_pos, max(event_id) * 10 AS last_pos
FROM events GROUP BY 1, 2, 3""",

    "bookmark_changes": """
WITH s AS (
  SELECT event_id * 10 + 5 AS pos, '{"bookmark":' || CAST(event_id // 300 AS VARCHAR) || '}' AS value
  FROM events WHERE event_id % 100 = 99),
l AS (SELECT pos, value, lag(value) OVER (ORDER BY pos) AS prev FROM s)
SELECT pos, value FROM l WHERE prev IS NULL OR prev <> value""",

    "stream_upsert": UPSERT,

    "scan_stored": """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 2 END AS _sdc_sequence FROM orders""",

    "lookup_keys": """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 2 END AS _sdc_sequence
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 49)""",

    "split_stored": """
SELECT event_id,
       CASE WHEN event_type NOT IN ('purchase', 'error') THEN CAST(floor(value) AS BIGINT) END AS v__i,
       CASE WHEN event_type = 'purchase' THEN 'u' || CAST(user_id AS VARCHAR) END AS v__s,
       CASE WHEN event_type = 'error' THEN value > 25 END AS v__b
FROM events""",

    "upsert_odd_keys": """
SELECT c_custkey AS id, 'a' || CAST(c_custkey % 7 AS VARCHAR) AS account_id, 0 AS level,
       CASE WHEN c_custkey % 2 = 0 THEN upper(c_name) ELSE c_mktsegment END AS word,
       CASE WHEN c_custkey % 2 = 0 THEN 2 ELSE 1 END AS _sdc_sequence FROM customer
UNION ALL
SELECT c_custkey, 'a' || CAST(c_custkey % 7 AS VARCHAR), 1, c_name, 1 FROM customer WHERE c_custkey % 2 = 1""",

    "unplaced_values": """
SELECT event_id, CASE WHEN event_type = 'error' THEN event_id * 10 END AS pos,
       CASE WHEN event_type = 'error' THEN 'v' END AS path,
       CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(floor(value) AS BIGINT) END AS v
FROM events""",

    "upsert_children_hot": """
WITH base AS (SELECT DISTINCT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS k, l_orderkey AS a,
                     CAST(l_linenumber AS BIGINT) AS b FROM lineitem),
inc AS (SELECT * FROM base WHERE b = 1 AND (k = 0 OR k % 5 = 1))
SELECT k AS _sdc_source_key_k, a AS _sdc_level_0_id, b AS _sdc_level_1_id, 1 AS _sdc_sequence
FROM base WHERE k NOT IN (SELECT k FROM inc)
UNION ALL SELECT k, a, b, 2 FROM inc""",

    "stream_two_loads": f"SELECT user_id, event_id, _sdc_sequence FROM ({UPSERT})",

    "stream_versions": f"""
SELECT user_id, event_id, event_type, 2 AS _sdc_table_version FROM ({_latest("event_type <> 'view'")})""",

    "stream_schema_repeats": """
SELECT CASE WHEN event_id <= 300 THEN 1 ELSE 2 END AS segment, min(event_id) * 10 AS first_pos,
       max(event_id) * 10 AS last_pos, count(DISTINCT user_id) AS rows
FROM events GROUP BY 1""",

    "validate_keywords": f"""
WITH l AS (SELECT l_orderkey, count(*) AS n,
                  count(DISTINCT row({LINE_ORDER})) AS u FROM lineitem GROUP BY 1)
SELECT o_orderkey,
       coalesce(o_orderkey > 0 AND o_totalprice > 1500 AND o_totalprice <= 400000 AND right(c_name, 1) <> '9'
                AND length(c_name) >= 5 AND c_mktsegment IN ('MACHINERY', 'HOUSEHOLD', 'AUTOMOBILE')
                AND (c_nationkey <= 15 OR c_nationkey % 2 = 0) AND n BETWEEN 1 AND 8 AND n = u, false) AS is_valid
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN l ON l_orderkey = o_orderkey""",
}
