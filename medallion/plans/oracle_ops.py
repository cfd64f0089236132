"""DuckDB SQL for the operator queries, one string per key of
``medallion.plans.queries.OPERATOR_QUERIES``; column names and types match.

The literals are the fixed values of the test mappings (see ``queries``).
"""

from __future__ import annotations

from medallion.plans.queries import (
    ADVANCE_SLICE_MARK,
    PLAN_SOURCE_SYSTEM,
    RESCUE_SEGMENT,
    SPLIT_DATE,
    UPDATE_FROM,
    UPDATED_AT,
    WATERMARK_MARK,
)

INITIAL_MARK = "1900-01-01 00:00:00"

# events as run-audit rows: begins = every event, end = latest SUCCESS / FAILED event.
RUNS = """
ev AS (
  SELECT user_id AS run_id, CAST(event_id % 51 + 1 AS INTEGER) AS table_id, event_id, ts, props,
         CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'INPROGRESS'
                         WHEN 'view' THEN NULL ELSE 'SUCCESS' END AS status
  FROM events),
b AS (SELECT run_id, table_id, max(ts) AS start_time FROM ev GROUP BY run_id, table_id),
e AS (
  SELECT run_id, table_id, ts AS end_time, status, event_id AS number_of_records,
         CASE WHEN status = 'FAILED' THEN props END AS error_message
  FROM (SELECT *, row_number() OVER (PARTITION BY run_id, table_id
                                     ORDER BY ts DESC, status DESC, event_id DESC, props DESC) AS rn
        FROM ev WHERE status IN ('SUCCESS', 'FAILED'))
  WHERE rn = 1),
runs AS (
  SELECT b.run_id, b.table_id, 'Silver' AS layer, b.start_time, e.end_time,
         COALESCE(e.status, 'INPROGRESS') AS status, e.number_of_records, e.error_message
  FROM b LEFT JOIN e ON b.run_id = e.run_id AND b.table_id = e.table_id)"""

RUN_ROWS = f"WITH {RUNS} SELECT * FROM runs"

ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

OPS_SQL: dict[str, str] = {
    "latest_row_per_key": """
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM events) WHERE rn = 1""",
    "hours_between": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, date_sub('hour', o_orderdate, l_shipdate) AS ship_hours
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "safe_percent": """
SELECT o_orderkey,
       CAST(count(l_orderkey) AS BIGINT) AS line_count,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned_lines,
       CAST(round(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) * 100.0
                  / NULLIF(count(l_orderkey), 0), 2) AS DOUBLE) AS returned_percent
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY o_orderkey""",
    "table_plan": f"""
SELECT c_custkey AS table_id, c_name AS table_name, c_mktsegment AS source_system,
       c_acctbal > 0 AS active_flag, c_nationkey AS load_order
FROM customer
WHERE c_acctbal > 0 AND lower(c_mktsegment) = lower('{PLAN_SOURCE_SYSTEM}')""",
    "table_params": """
SELECT user_id AS table_id,
       arg_max(value, {'t': ts, 'v': value}) FILTER (WHERE event_type = 'view') AS "view",
       arg_max(value, {'t': ts, 'v': value}) FILTER (WHERE event_type = 'signup') AS "signup",
       arg_max(value, {'t': ts, 'v': value}) FILTER (WHERE event_type = 'click') AS "click",
       arg_max(value, {'t': ts, 'v': value}) FILTER (WHERE event_type = 'error') AS "error",
       arg_max(value, {'t': ts, 'v': value}) FILTER (WHERE event_type = 'purchase') AS "purchase"
FROM events GROUP BY user_id""",
    "load_type_listing": """
SELECT c_name AS table_name, o_orderstatus AS load_type
FROM customer, orders
WHERE c_custkey = o_custkey AND o_orderpriority = '1-URGENT'""",
    "schema_latest": """
SELECT o_custkey AS table_name, max(o_orderkey) AS schema_version, arg_max(o_orderpriority, o_orderkey) AS schema_json
FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_custkey""",
    "metadata_counts": """
SELECT 'tables' AS table_name, count(*) AS row_count FROM customer
UNION ALL SELECT 'table_parameters', count(*) FROM events
UNION ALL SELECT 'table_watermarks', count(*) FROM supplier""",
    "bronze_file_stream": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "bronze_rescued_rows": f"""
SELECT c_custkey,
       CASE WHEN c_mktsegment = '{RESCUE_SEGMENT}' THEN NULL ELSE c_nationkey END AS c_nationkey,
       COALESCE(c_mktsegment = '{RESCUE_SEGMENT}', false) AS rescued
FROM customer""",
    "csv_batch_header": """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
       CAST(s_acctbal AS VARCHAR) AS s_acctbal
FROM supplier""",
    "csv_batch_no_header": """
SELECT CAST(s_suppkey AS VARCHAR) AS _c0, s_name AS _c1, CAST(s_nationkey AS VARCHAR) AS _c2,
       CAST(s_acctbal AS VARCHAR) AS _c3
FROM supplier""",
    "bronze_bounded_full": f"SELECT {ORDERS_COLS} FROM orders",
    "bronze_bounded_incremental": f"SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate > TIMESTAMP '{WATERMARK_MARK}'",
    "watermark_filter": f"SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate > TIMESTAMP '{WATERMARK_MARK}'",
    "watermark_advance": f"""
WITH old AS (SELECT o_custkey, CAST(min(o_orderdate) AS VARCHAR) AS mark FROM orders GROUP BY o_custkey),
new AS (SELECT o_custkey, CAST(max(o_orderdate) AS VARCHAR) AS mark FROM orders
        WHERE o_orderdate > TIMESTAMP '{ADVANCE_SLICE_MARK}' GROUP BY o_custkey)
SELECT old.o_custkey, COALESCE(new.mark, old.mark) AS last_watermark_value
FROM old LEFT JOIN new ON old.o_custkey = new.o_custkey""",
    "silver_first_load": f"SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate > TIMESTAMP '{INITIAL_MARK}'",
    "silver_full": f"SELECT {ORDERS_COLS} FROM orders",
    "silver_append": f"SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate > TIMESTAMP '{INITIAL_MARK}'",
    "silver_merge": f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderdate >= TIMESTAMP '{UPDATE_FROM}' THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority,
       CASE WHEN o_orderdate >= TIMESTAMP '{UPDATE_FROM}' THEN TIMESTAMP '{UPDATED_AT}' ELSE o_orderdate END AS updated_at
FROM orders
WHERE o_orderdate > TIMESTAMP '{INITIAL_MARK}'
  AND (o_orderdate < TIMESTAMP '{SPLIT_DATE}' OR o_orderdate >= TIMESTAMP '{UPDATE_FROM}')""",
    "silver_merge_composite": f"""
WITH base AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{SPLIT_DATE}'),
upd AS (SELECT * REPLACE (l_quantity + 1.0 AS l_quantity) FROM lineitem WHERE l_shipdate >= TIMESTAMP '{UPDATE_FROM}')
SELECT * FROM base b
WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE {' AND '.join(f'u.{k} = b.{k}' for k in LINE_KEY)})
UNION ALL SELECT * FROM upd""",
    "audit_lifecycle": """
WITH ev AS (
  SELECT user_id AS run_id, CAST(event_id % 51 + 1 AS INTEGER) AS table_id, event_id, ts, props,
         event_type NOT IN ('signup', 'view') AS done, event_type = 'error' AS failed
  FROM events),
opened AS (
  SELECT run_id, table_id, max({'t': ts, 'e': event_id}) FILTER (WHERE NOT done) AS begun, min({'t': ts, 'e': event_id}) FILTER (WHERE done) AS joined
  FROM ev GROUP BY run_id, table_id),
closed AS (
  SELECT ev.run_id, ev.table_id, arg_max(ev, {'t': ts, 'e': event_id}) AS last
  FROM ev JOIN opened o ON ev.run_id = o.run_id AND ev.table_id = o.table_id
  WHERE done AND (begun IS NULL OR {'t': ts, 'e': event_id} >= begun) GROUP BY ev.run_id, ev.table_id)
SELECT o.run_id, o.table_id, CASE WHEN begun IS NULL THEN 'Silver' ELSE 'Bronze' END AS layer,
       COALESCE(begun, joined).t AS start_time, last.ts AS end_time,
       CASE WHEN last IS NULL THEN 'INPROGRESS' WHEN last.failed THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       last.event_id AS number_of_records, CASE WHEN last.failed THEN last.props END AS error_message
FROM opened o LEFT JOIN closed c ON o.run_id = c.run_id AND o.table_id = c.table_id""",
    "bronze_rescued_fields": """
SELECT c_custkey, c_name, CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(c_nationkey AS INTEGER) END AS c_nationkey, c_mktsegment,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN '{"c_nationkey":"N' || c_nationkey || '"}' END AS rescued
FROM customer""",
    "silver_merge_no_mark": """
SELECT l_orderkey, b.n AS l_linenumber, b.p AS l_partkey, b.s AS l_suppkey, b.q AS l_quantity
FROM (SELECT l_orderkey, max({'n': l_linenumber, 'p': l_partkey, 's': l_suppkey, 'q': l_quantity}) AS b FROM lineitem GROUP BY l_orderkey)""",
    "silver_zoned_mark": "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS ordered_at FROM orders",
    "silver_file_lineage": "SELECT 'customer' AS landing_folder, count(*) AS customers, CAST(0 AS BIGINT) AS unstamped FROM customer",
    "run_history": RUN_ROWS,
    "run_summary": f"""
WITH {RUNS}
SELECT r.run_id AS Run_ID, r.table_id AS Table_ID, c.c_name AS Table_Name, r.layer AS Layer,
       r.start_time AS Start_Time, r.end_time AS End_Time, r.status AS Status,
       r.number_of_records AS Number_Of_Records, r.error_message AS Error_Message
FROM runs r LEFT JOIN customer c ON r.table_id = c.c_custkey""",
    "run_status": f"""
WITH {RUNS}
SELECT run_id, count(*) AS total_tables, count(*) FILTER (WHERE status <> 'SUCCESS') AS failed_tables,
       CASE WHEN count(*) FILTER (WHERE status <> 'SUCCESS') > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS overall_status
FROM runs GROUP BY run_id""",
}
