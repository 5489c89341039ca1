"""Oracle SQL (DuckDB dialect) for every sample query in :mod:`quarry.plans.samples`.

The same derivation rules are stated here in SQL, so the comparison covers
the parsing, splitting and change-set logic, not only the final numbers.
Rules that keep the two engines comparable: types written out, means rounded,
NULL order explicit, ``regexp_replace`` with the ``'g'`` flag, and integer
parsing by truncation (DuckDB's cast from double rounds).
"""

from __future__ import annotations

from quarry.functions.numbers import NUMBER_PATTERN
from quarry.plans.samples import LINE_KEY, LOOKUP_CUSTOMER, LOOKUP_NATION, ORDER_LINE_NAMES, PART_RENAMES


def _parse_double(expr: str, strip: str = "") -> str:
    s = f"regexp_replace({expr}, '[{strip}]', '', 'g')" if strip else expr
    s = f"trim({s})"
    return (f"(CASE WHEN regexp_full_match({s}, '{NUMBER_PATTERN}') "
            f"AND isfinite(TRY_CAST({s} AS DOUBLE)) THEN TRY_CAST({s} AS DOUBLE) END)")


def _parse_bigint(expr: str, strip: str = "") -> str:
    return f"TRY_CAST(trunc({_parse_double(expr, strip)}) AS BIGINT)"


def exact_mean(col: str, digits: int, places: int) -> str:
    """Mean of a column of decimals with ``places`` places: integer division, half away from zero."""
    total = f"CAST(sum(CAST({col} AS DECIMAL(28, {places}))) * {10 ** places} AS HUGEINT)"
    n = f"(CAST(count({col}) AS HUGEINT) * {10 ** max(0, places - digits)})"
    up = 10 ** max(0, digits - places)
    return (f"(CASE WHEN count({col}) > 0 THEN CAST(sign({total}) * ((2 * abs({total}) * {up} + {n}) // (2 * {n})) AS DOUBLE) "
            f"/ {10 ** digits} END)")


def _cents(c: str) -> str:
    return f"CAST(round({c} * 100) AS BIGINT)"


def _decimal_text(c: str, thousands: bool) -> str:
    whole = f"({_cents(c)} // 100)"
    head = f"format('{{:,}}', {whole})" if thousands else f"CAST({whole} AS VARCHAR)"
    return f"({head} || '.' || lpad(CAST({_cents(c)} % 100 AS VARCHAR), 2, '0'))"


_ORDER_LINES = f"""
lines AS (
  SELECT '{",".join(ORDER_LINE_NAMES)}' AS value
  UNION ALL
  SELECT CASE
    WHEN o_orderkey % 5 = 0 THEN concat_ws(',', CAST(o_orderkey AS VARCHAR), o_orderstatus,
                                           o_orderpriority, '')
    WHEN o_orderkey % 7 = 0 THEN concat_ws(',', CAST(o_orderkey AS VARCHAR), o_orderstatus,
                                           '"' || o_orderpriority || ',x"')
    ELSE concat_ws(',', CAST(o_orderkey AS VARCHAR), o_orderstatus, o_orderpriority) END
  FROM orders)"""

_DELTA_INPUTS = """
s AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  FROM orders),
t AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 11 = 0 THEN 'Z'
              WHEN o_orderkey % 13 = 0 OR o_orderkey % 34 = 0 THEN NULL
              ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice,
         CASE WHEN o_orderkey % 19 = 0 THEN o_orderdate - INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate,
         o_orderpriority
  FROM orders WHERE o_orderkey % 10 <> 3)"""

_VALUES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_NULL_SAFE = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in _VALUES)
_REFERENCE_RULE = " OR ".join(f"(t.{c} IS NULL OR t.{c} <> s.{c})" for c in _VALUES)
_DELTA = f"""
d AS (
  SELECT s.* FROM s LEFT JOIN t ON s.o_orderkey = t.o_orderkey
  WHERE t.o_orderkey IS NULL OR {_NULL_SAFE})"""

_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _first_per_key(src: str, key: list[str], cols: list[str]) -> str:
    order = ", ".join(f"{c} NULLS LAST" for c in cols if c not in key)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {', '.join(key)} ORDER BY {order}) AS rn FROM {src}) WHERE rn = 1")


def _extreme(qt: str) -> str:
    fn = "max" if qt == "highest" else "min"
    return (f"SELECT c_name AS country, c_acctbal AS internet_users, '{qt}' AS query_type "
            f"FROM customer WHERE c_acctbal = (SELECT {fn}(c_acctbal) FROM customer) "
            f"ORDER BY c_name LIMIT 1")


def _group_avg(qt: str) -> str:
    col = "l_extendedprice" if qt == "highest" else "l_discount"
    d = "DESC" if qt == "highest" else "ASC"
    return (f"SELECT l_returnflag AS region, round(favg({col}), 3) AS price, "
            f"'{qt}' AS query_type FROM lineitem GROUP BY l_returnflag "
            f"HAVING count({col}) > 0 ORDER BY favg({col}) {d}, l_returnflag LIMIT 1")


def _group_avg_join(qt: str, k: int = 1) -> str:
    d = "DESC" if qt == "highest" else "ASC"
    return (f"SELECT n_name AS region, {exact_mean('s_acctbal', 3, 2)} AS internet_speed, "
            f"'{qt}' AS query_type FROM supplier JOIN nation ON s_nationkey = n_nationkey "
            f"GROUP BY n_name HAVING count(s_acctbal) > 0 "
            f"ORDER BY favg(s_acctbal) {d}, n_name LIMIT {k}")


ORACLE = {
    "src_csv": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",

    "src_csv_by_name": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",

    "src_csv_folder": """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 <> 2 THEN c_nationkey END AS c_nationkey, c_acctbal FROM customer""",

    "src_nested_documents": """
SELECT CAST(event_id AS VARCHAR) AS id, ts, user_id, event_type, value,
       CAST(regexp_extract(props, '"k"\\s*:\\s*(-?[0-9]+)', 1) AS INTEGER) AS k
FROM events""",

    "src_mixed_documents": """
WITH e AS (
  SELECT event_id, user_id, event_type, CAST(event_id AS VARCHAR) AS id FROM events)
SELECT id, CAST(user_id AS BIGINT) AS user_id, event_type, CAST(NULL AS VARCHAR) AS line FROM e WHERE event_id % 11 <> 0
UNION ALL
SELECT NULL, NULL, NULL,
  '{"_id":' || CASE WHEN event_id % 3 = 0 THEN '{"oid":"' || id || '"}' WHEN event_id % 2 = 0 THEN '"' || id || '"' ELSE id END
  || ',"user_id":' || coalesce(CASE WHEN event_id % 5 = 0 THEN '"' || user_id || '"' ELSE CAST(user_id AS VARCHAR) END, 'null')
  || ',"event_type":' || coalesce('"' || event_type || '"', 'null')
FROM e WHERE event_id % 11 = 0""",

    "src_delimited_lines": f"""
WITH {_ORDER_LINES},
parts AS (SELECT string_split(value, ',') AS p FROM lines
          WHERE value <> '{",".join(ORDER_LINE_NAMES)}')
SELECT p[1] AS order_key, p[2] AS status, p[3] AS priority FROM parts WHERE len(p) = 3""",

    "src_delimited_rejects": f"""
WITH {_ORDER_LINES}
SELECT value AS line FROM lines
WHERE value <> '{",".join(ORDER_LINE_NAMES)}' AND len(string_split(value, ',')) <> 3""",

    "src_payload_rejects": """
SELECT CASE WHEN c_custkey % 11 = 0 THEN '["name,id","' || c_name || ',' || c_custkey || '"'
            ELSE c_name || ',' || c_custkey END AS line, c_custkey % 11 = 0 AS rejected
FROM customer""",

    "proj_rename": "SELECT " + ", ".join(f"{k} AS {v}" for k, v in PART_RENAMES.items())
                   + " FROM part",

    "filter_required_not_blank": """
WITH c AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 13 = 0 THEN ' ' ELSE c_name END AS c_name,
         c_nationkey, c_acctbal,
         CASE WHEN c_custkey % 11 = 0 THEN NULL
              WHEN c_custkey % 9 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment
  FROM customer)
SELECT * FROM c
WHERE c_name IS NOT NULL AND c_name <> '' AND c_mktsegment IS NOT NULL AND c_mktsegment <> ''""",

    "filter_drop_any_null": """
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.doc_id IS NOT NULL AND d.text IS NOT NULL AND d.lang IS NOT NULL
  AND d.source IS NOT NULL AND d.n_chars IS NOT NULL
  AND l.quality IS NOT NULL AND l.toxic IS NOT NULL""",

    "clean_numbers_thousands": f"""
WITH t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 7 = 0 THEN 'NA' WHEN o_orderkey % 11 = 0 THEN ''
              ELSE {_decimal_text('o_totalprice', True)} END AS txt
  FROM orders)
SELECT o_orderkey, {_parse_bigint('txt', ',')} AS total_units FROM t""",

    "clean_numbers_money": f"""
WITH t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 7 = 0 THEN '$'
              WHEN o_orderkey % 11 = 0 THEN '$NaN' || chr(10)
              WHEN o_orderkey % 13 = 0 THEN '$ ' || {_decimal_text('o_totalprice', False)} || chr(10)
              ELSE '$' || {_decimal_text('o_totalprice', False)} || chr(10) END AS txt
  FROM orders)
SELECT o_orderkey, {_parse_double('txt', '$' + chr(13) + chr(10))} AS price FROM t""",

    "clean_numbers_int_text": f"""
WITH t AS (
  SELECT p_partkey,
         CASE WHEN p_partkey % 10 = 0 THEN ''
              WHEN p_partkey % 10 = 1 THEN CAST(p_size AS VARCHAR) || '.7'
              WHEN p_partkey % 10 = 2 THEN CAST(p_size AS VARCHAR) || '000000000'
              ELSE CAST(p_size AS VARCHAR) END AS txt
  FROM part)
SELECT p_partkey, {_parse_bigint('txt')} AS size FROM t""",

    "dedupe_one_key": (
        "SELECT doc_id, text, lang, source, n_chars FROM (SELECT *, row_number() OVER "
        "(PARTITION BY text ORDER BY doc_id NULLS LAST, lang NULLS LAST, source NULLS LAST, "
        "n_chars NULLS LAST) AS rn FROM documents) WHERE rn = 1"),

    "dedupe_two_keys": f"""
WITH li AS (SELECT {', '.join(_LI_COLS)} FROM lineitem),
s1 AS ({_first_per_key('li', ['l_orderkey', 'l_linenumber'], _LI_COLS)}),
s2 AS ({_first_per_key('s1', ['l_partkey', 'l_suppkey'], _LI_COLS)})
SELECT * FROM s2""",

    "dedupe_hot_keys": f"""
WITH li AS (SELECT {', '.join(_LI_COLS)} FROM lineitem)
{_first_per_key('li', ['l_returnflag', 'l_linestatus'], _LI_COLS)}""",

    "agg_group_mean_int": f"""
SELECT l_returnflag,
       CAST(round(favg(l_quantity)) AS BIGINT) AS avg_l_quantity,
       CAST(round(favg(l_extendedprice)) AS BIGINT) AS avg_l_extendedprice
FROM lineitem GROUP BY l_returnflag""",

    "agg_group_mean_2dp": "SELECT l_returnflag, " + ", ".join(
        f"{exact_mean(c, 2, 2)} AS avg_{c}"
        for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
        + " FROM lineitem GROUP BY l_returnflag",

    "impute_group_mean": f"""
WITH src AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice
  FROM orders),
m AS (SELECT o_orderpriority, {exact_mean('o_totalprice', 2, 2)} AS m
      FROM src GROUP BY o_orderpriority)
SELECT s.o_orderkey, s.o_orderpriority, coalesce(s.o_totalprice, m.m) AS o_totalprice
FROM src s LEFT JOIN m ON s.o_orderpriority = m.o_orderpriority""",

    "impute_group_mean_joined": f"""
WITH src AS (
  SELECT d.doc_id, d.lang, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
m AS (SELECT lang, CAST({exact_mean('quality', 0, 0)} AS BIGINT) AS mq,
             {exact_mean('toxic', 2, 0)} AS mt
      FROM src GROUP BY lang)
SELECT s.doc_id, s.lang, coalesce(s.quality, m.mq) AS quality, coalesce(s.toxic, m.mt) AS toxic
FROM src s LEFT JOIN m ON s.lang = m.lang""",

    "delta_changed_rows": f"WITH {_DELTA_INPUTS}, {_DELTA} SELECT * FROM d",

    "delta_changed_rows_null_as_changed": f"""
WITH {_DELTA_INPUTS}
SELECT s.* FROM s LEFT JOIN t ON s.o_orderkey = t.o_orderkey
WHERE coalesce({_REFERENCE_RULE}, false)""",

    "agg_delta_count": f"WITH {_DELTA_INPUTS}, {_DELTA} SELECT count(*) AS changed_rows FROM d",

    "sink_overwrite_roundtrip": "SELECT r_regionkey, r_name FROM region",

    "sink_update_upsert": f"""
WITH {_DELTA_INPUTS}, {_DELTA}
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM d""",

    "sink_update_replace": f"WITH {_DELTA_INPUTS} SELECT * FROM s",

    "sink_update_table": f"""
WITH {_DELTA_INPUTS}, {_DELTA}
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM d""",

    "sink_update_deletions": f"WITH {_DELTA_INPUTS} SELECT * FROM t WHERE o_orderkey % 10 <> 4",

    "sink_update_parts": f"WITH {_DELTA_INPUTS} SELECT * FROM s WHERE o_orderkey % 10 <> 4",

    "sink_update_carries_columns": "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders",

    "sink_version_history": f"""
WITH {_DELTA_INPUTS}, {_DELTA}
SELECT CAST(1 AS BIGINT) AS version, * FROM t
UNION ALL SELECT CAST(2 AS BIGINT), * FROM t WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.o_orderkey = t.o_orderkey)
UNION ALL SELECT CAST(2 AS BIGINT), * FROM d""",

    "sink_update_snapshot": f"""
WITH once AS (SELECT DISTINCT {', '.join(LINE_KEY)} FROM lineitem),
n AS (SELECT count(*) AS table_rows, count(*) FILTER (WHERE l_orderkey % 3 = 0) AS changed FROM once)
SELECT CAST(run AS BIGINT) AS run, table_rows AS rows_read, CASE run WHEN 1 THEN changed ELSE 0 END AS rows_written,
       run = 1 AS compared, run = 1 AS wrote, table_rows
FROM n, (SELECT unnest([1, 2]) AS run)""",

    "sink_landed_payloads": f"""
SELECT c_custkey, c_name, {_cents("c_acctbal")} + CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 <> 0 THEN 1 ELSE 0 END AS cents,
  count(*) FILTER (WHERE c_custkey % 2 = 0) OVER () AS rows_1,
  count(*) FILTER (WHERE c_custkey % 2 = 1 OR c_custkey % 3 = 0) OVER () AS rows_2, CAST(0 AS BIGINT) AS rows_3
FROM customer""",

    "sink_overwrite_lines": "SELECT * FROM lineitem",

    "sink_update_lines": _first_per_key(
        "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice"], _LI_COLS),

    "sink_update_noop": f"""
WITH {_DELTA_INPUTS}
SELECT CAST(0 AS BIGINT) AS rows_written, false AS wrote, count(*) AS target_rows FROM t""",

    "report_lookup_files": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, true AS few_files
FROM orders WHERE o_custkey = {LOOKUP_CUSTOMER}""",

    "report_lookup": f"""
WITH speed AS (
  SELECT n.n_name AS country, {exact_mean('s.s_acctbal', 2, 2)} AS avg_speed
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name),
prices AS (
  SELECT n.n_name AS name, {exact_mean('c.c_acctbal', 2, 2)} AS avg_price
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name)
SELECT speed.country AS country, speed.avg_speed AS mbit_per_s, prices.avg_price AS price_1gb_usd
FROM prices JOIN speed ON prices.name = speed.country
WHERE speed.country = '{LOOKUP_NATION}'
ORDER BY 1, 2, 3 LIMIT 1""",

    "report_extreme_high": _extreme("highest"),
    "report_extreme_low": _extreme("lowest"),
    "report_group_avg_high": _group_avg("highest"),
    "report_group_avg_low": _group_avg("lowest"),
    "report_group_avg_join_high": _group_avg_join("highest"),
    "report_group_avg_join_low": _group_avg_join("lowest"),
    "report_group_avg_join_top3": _group_avg_join("highest", 3),
}
