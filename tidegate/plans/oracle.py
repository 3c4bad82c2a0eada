"""What the registered queries must return, as SQL over the same tables.

Amounts go through text on their way from and to double: DuckDB scales a double by a power of ten when
it casts it to a decimal, which is off in the last digits, while its text has exactly the digits meant.
"""

from __future__ import annotations

LANDING = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
       o_totalprice AS amount, strftime(o_orderdate, '%Y%m%d') AS order_day,
       o_orderpriority AS priority
FROM orders
"""

CONTRACT_TOTALS = """
SELECT CAST(o_orderkey AS VARCHAR) AS contract_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(CAST(SUM(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) AS valor,
       'MAINFRAME' AS fonte, '20240201' AS data_processamento
FROM orders GROUP BY o_orderkey, o_custkey
UNION
SELECT CAST(l_orderkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
       CAST(CAST(SUM(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE),
       'MOBILE', '20240201'
FROM lineitem GROUP BY l_orderkey, l_suppkey
UNION
SELECT CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR),
       CAST(CAST(SUM(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE),
       'EXTERNOS', strftime(ts, '%Y%m%d')
FROM events GROUP BY event_id, user_id, strftime(ts, '%Y%m%d')
"""


def _outcome(rule: str, actual: str, passed: str, reason: str, source: str) -> str:
    return f"""
SELECT '{rule}' AS rule, CASE WHEN {passed} THEN 'Passed' ELSE 'Failed' END AS outcome,
       CAST({actual} AS DOUBLE) AS actual,
       CASE WHEN {passed} THEN NULL ELSE CAST({actual} AS VARCHAR) || '{reason}' END AS failure_reason
FROM {source}
"""


def _rows(comparator: str, bound: int, source: str) -> str:
    return _outcome(
        f"RowCount {comparator} {bound}",
        "COUNT(*)",
        f"COUNT(*) {comparator} {bound}",
        f" is not {comparator} {bound}",
        source,
    )


def _distinct(column: str, comparator: str, bound: int, source: str) -> str:
    return _outcome(
        f'DistinctValuesCount "{column}" {comparator} {bound}',
        f"COUNT(DISTINCT {column})",
        f"COUNT(DISTINCT {column}) {comparator} {bound}",
        f" is not {comparator} {bound}",
        source,
    )


def _values(column: str, values: list[str], source: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    quoted = ", ".join(f'"{v}"' for v in values)
    outside = f"SUM(CASE WHEN {column} IN ({listed}) THEN 0 ELSE 1 END)"
    return _outcome(
        f'ColumnValues "{column}" in [{quoted}]',
        outside,
        f"{outside} = 0",
        " rows outside the listed values",
        source,
    )


def _all(*selects: str) -> str:
    return " UNION ALL ".join(selects)


_ORDERS = _all(
    _rows(">", 100, "orders"),
    _distinct("o_orderkey", ">", 1, "orders"),
    _distinct("o_custkey", ">", 1, "orders"),
    _values("o_orderstatus", ["F", "O", "P"], "orders"),
    _values("o_orderpriority", ["1-URGENT", "2-HIGH"], "orders"),
)
_EVENTS = _all(
    _rows(">", 100, "events"),
    _rows("<", 10, "events"),
    _distinct("event_id", ">", 1, "events"),
    _values("event_type", ["click", "error", "purchase", "signup", "view"], "events"),
)

STORED_OUTCOMES = f"""
WITH stored AS (
  SELECT *, 'orders' AS table_name FROM ({_ORDERS})
  UNION ALL
  SELECT *, 'events' AS table_name FROM ({_EVENTS})
)
SELECT rule, outcome, actual, failure_reason, '20240201' AS anomesdia, table_name,
       SUM(CASE WHEN outcome = 'Failed' THEN 1 ELSE 0 END) OVER (PARTITION BY table_name) AS failed
FROM stored
"""

GATE_ACTIONS = f"""
WITH rows AS (
  SELECT 'orders_full' AS rule_set, outcome FROM ({_ORDERS})
  UNION ALL SELECT 'orders_base', outcome FROM ({_rows(">", 100, "orders")})
  UNION ALL SELECT 'events_full', outcome FROM ({_EVENTS})
  UNION ALL SELECT 'events_base', outcome FROM ({_rows(">", 100, "events")})
),
folded AS (
  SELECT rule_set, COUNT(*) FILTER (outcome = 'Failed') AS failed_rules,
         bool_and(outcome = 'Passed') AS passed
  FROM rows GROUP BY rule_set
),
cased AS (
  SELECT *, unnest(
    [{{'policy': 'strict', 'flag': true}}, {{'policy': 'strict', 'flag': false}},
     {{'policy': 'flags', 'flag': true}}, {{'policy': 'flags', 'flag': false}}],
    recursive := true
  ) FROM folded
)
SELECT rule_set, failed_rules, passed, policy, flag,
       CASE WHEN passed OR (policy = 'flags' AND flag) THEN 'read' ELSE 'stop' END AS on_read,
       CASE WHEN passed OR (policy = 'flags' AND flag) THEN 'write' ELSE 'skip' END AS on_write,
       passed OR (policy = 'flags' AND flag) AS recorded
FROM cased
"""

MERGE_JOB = f"""
WITH known AS (SELECT CAST(o_orderkey AS VARCHAR) AS contract_id FROM orders WHERE o_orderstatus = 'F'),
incoming AS ({CONTRACT_TOTALS})
SELECT contract_id, CAST(NULL AS VARCHAR) AS customer_id, CAST(0 AS DOUBLE) AS valor,
       'KNOWN' AS fonte, '20240101' AS data_processamento
FROM known
UNION ALL
SELECT contract_id, customer_id, valor, fonte, data_processamento FROM incoming
WHERE contract_id NOT IN (SELECT contract_id FROM known)
"""

ORACLE: dict[str, str] = {
    "q01_csv_scan": LANDING,
    "q02_dated_file": LANDING,
    "q03_catalog_scan": """
        SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '2001-06-02' THEN 'recent' ELSE 'old' END AS side
        FROM orders""",
    "q04_parquet_scan": "SELECT p_partkey, p_brand, p_size FROM part",
    "q06_views": """
        SELECT n_name, COUNT(*) AS n_customers FROM customer
        JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    "q07_partitioned_write": """
        SELECT o_orderkey, o_totalprice, o_orderstatus, '2024-02-01 00:00:00' AS written_at
        FROM orders""",
    "q08_partition_overwrite": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'NEW' ELSE o_orderpriority END AS o_orderpriority,
               o_orderstatus
        FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')""",
    "q09_keyed_upsert": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
               CAST(user_id AS VARCHAR) AS user_id, event_type,
               CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS value, props
        FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "q10_partition_registration": """
        SELECT o_orderstatus, COUNT(*) AS n_rows FROM orders GROUP BY o_orderstatus""",
    "q11_day_window": """
        SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS anomesdia FROM events
        WHERE CAST(strftime(ts, '%Y%m%d') AS INTEGER) > 20240120
          AND CAST(strftime(ts, '%Y%m%d') AS INTEGER) < 20240130""",
    "q12_timestamp_window": """
        SELECT event_id, user_id, value FROM events
        WHERE ts >= TIMESTAMP '2024-01-28 00:00:00' AND ts < TIMESTAMP '2024-01-30 23:59:59'""",
    "q13_cast_projection": """
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS INTEGER) END AS customer_id,
               CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount,
               CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS rough,
               CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_day,
               o_orderpriority AS untouched
        FROM orders""",
    "q14_merge_insert": """
        WITH known AS (SELECT o_orderkey AS contract_id FROM orders WHERE o_orderstatus = 'F'),
        incoming AS (
          SELECT o_orderkey AS contract_id, 'A' AS origin FROM orders
          UNION ALL
          SELECT DISTINCT l_orderkey, 'B' FROM lineitem
        )
        SELECT contract_id, 'T' AS origin FROM known
        UNION ALL
        SELECT contract_id, origin FROM incoming
        WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.contract_id = incoming.contract_id)""",
    "q15_order_totals": """
        SELECT o_orderkey, o_custkey, CAST(CAST(SUM(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) AS total
        FROM orders GROUP BY o_orderkey, o_custkey""",
    "q16_text_totals": """
        SELECT l_orderkey, l_suppkey,
               CAST(CAST(SUM(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) AS total
        FROM lineitem GROUP BY l_orderkey, l_suppkey""",
    "q17_contract_totals": CONTRACT_TOTALS,
    "q17_union_distinct": """
        SELECT o_custkey AS party, o_orderstatus AS mark FROM orders
        UNION SELECT l_suppkey, l_returnflag FROM lineitem
        UNION SELECT user_id, event_type FROM events""",
    "q17_union_sql": CONTRACT_TOTALS,
    "q18_daily_totals": """
        SELECT event_type, user_id, strftime(ts, '%Y%m%d') AS day,
               CAST(CAST(SUM(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE) AS total
        FROM events GROUP BY event_type, user_id, strftime(ts, '%Y%m%d')""",
    "q19_row_count_rules": _all(
        _rows(">", 1000, "lineitem"),
        _rows("<", 10, "lineitem"),
        _rows(">=", 1, "lineitem"),
        _rows("<=", 0, "lineitem"),
        _rows("=", 7, "lineitem"),
    ),
    "q20_distinct_rules": _all(
        _distinct("O_ORDERKEY", ">", 1, "orders"),
        _distinct("o_orderstatus", "=", 3, "orders"),
        _distinct("o_custkey", "<", 10, "orders"),
    ),
    "q21_value_rules": _all(
        _values("o_orderstatus", ["F", "O", "P"], "orders"),
        _values("o_orderstatus", ["F", "O"], "orders"),
        """SELECT 'ColumnValues "no_such_column" in ["F"]', 'Failed', NULL,
                  'no such column: no_such_column'""",
    ),
    "q22_stored_outcomes": f"""
        SELECT rule, outcome, actual, failure_reason, table_name, anomesdia,
               CAST(failed AS BIGINT) AS failed_rules
        FROM ({STORED_OUTCOMES})""",
    "q23_gate_actions": GATE_ACTIONS,
    "q24_partition_keys": """
        SELECT DISTINCT o_orderstatus, o_orderpriority,
               'o_orderstatus=' || o_orderstatus || '#o_orderpriority=' || o_orderpriority AS prtc_key
        FROM orders""",
    "q25_ledger": """
        SELECT DISTINCT 'orders' AS table_name, 'o_orderstatus=' || o_orderstatus AS prtc_key,
               '{"o_orderstatus":"' || o_orderstatus || '"}' AS data_prtc,
               CASE WHEN o_orderstatus = 'F' THEN '20240130' ELSE '20240201' END AS added
        FROM orders""",
    "q26_compaction": """
        SELECT l_returnflag, COUNT(*) AS n_rows, CAST(SUM(l_orderkey) AS BIGINT) AS key_sum, true AS fewer
        FROM lineitem GROUP BY l_returnflag""",
    "q27_expiry": """
        WITH days AS (
          SELECT DISTINCT event_type AS table_name, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS anomesdia
          FROM events
        ),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY anomesdia DESC) AS rn FROM days
        )
        SELECT table_name, anomesdia, c.cutoff FROM ranked
        JOIN (VALUES (20240115), (20240128)) AS c(cutoff) ON anomesdia < c.cutoff
        WHERE rn > 10""",
    "q28_orphans": """
        SELECT DISTINCT 'events' AS table_name, strftime(ts, '%Y%m%d') AS anomesdia,
               'anomesdia=' || strftime(ts, '%Y%m%d') AS prtc_key
        FROM events WHERE ts >= TIMESTAMP '2024-01-16'""",
    "q29_ingest_job": LANDING,
    "q30_union_job": CONTRACT_TOTALS,
    "q32_merge_job": MERGE_JOB,
    "q31_gated_job": """
        SELECT table_name, rules, failed, CAST(0 AS BIGINT) AS rows_written, CAST(0 AS BIGINT) AS entries
        FROM (VALUES ('tb_orders', 3, 0), ('tb_lineitem', 2, 0), ('tb_events', 2, 0),
                     ('contract_totals_gated', 2, 1)) AS v(table_name, rules, failed)""",
    "q14_merge_mixed_types": """
        SELECT l_orderkey AS contract_id, 'S' AS origin FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "q33_two_databases": """
        WITH days AS (SELECT * FROM (VALUES ('20240130'), ('20240201')) AS v(day)),
        dbs AS (SELECT * FROM (VALUES ('first'), ('second')) AS v("database"))
        SELECT 'row' AS what, o_orderstatus AS status, day, COUNT(*) AS n,
               CASE WHEN o_orderstatus = 'F' THEN 'first' ELSE 'second' END AS "database"
        FROM orders, days GROUP BY o_orderstatus, day
        UNION ALL SELECT 'entry', NULL, day, 1, "database" FROM days, dbs
        UNION ALL SELECT 'outcomes', NULL, day, 2, "database" FROM days, dbs""",
}
