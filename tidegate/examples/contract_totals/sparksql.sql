WITH orders_by_contract AS (
  SELECT o_orderkey, o_custkey, SUM(CAST(o_totalprice AS DECIMAL(38, 10))) AS amount
  FROM tb_orders
  GROUP BY o_orderkey, o_custkey
),
lines_by_contract AS (
  SELECT l_orderkey, l_suppkey, SUM(CAST(CAST(l_extendedprice AS STRING) AS DECIMAL(38, 10))) AS amount
  FROM tb_lineitem
  GROUP BY l_orderkey, l_suppkey
),
events_by_day AS (
  SELECT event_id, user_id, DATE_FORMAT(ts, 'yyyyMMdd') AS day, SUM(CAST(value AS DECIMAL(38, 10))) AS amount
  FROM tb_events
  GROUP BY event_id, user_id, DATE_FORMAT(ts, 'yyyyMMdd')
)
SELECT CAST(o_orderkey AS STRING) AS CONTRACT_ID, CAST(o_custkey AS STRING) AS CUSTOMER_ID,
       CAST(amount AS DOUBLE) AS VALOR, 'MAINFRAME' AS FONTE, DATE_FORMAT(:as_of, 'yyyyMMdd') AS DATA_PROCESSAMENTO
FROM orders_by_contract
UNION
SELECT CAST(l_orderkey AS STRING), CAST(l_suppkey AS STRING), CAST(amount AS DOUBLE), 'MOBILE', DATE_FORMAT(:as_of, 'yyyyMMdd')
FROM lines_by_contract
UNION
SELECT CAST(event_id AS STRING), CAST(user_id AS STRING), CAST(amount AS DOUBLE), 'EXTERNOS', day
FROM events_by_day
