"""DuckDB SQL of the queries in ``suite_loads``, from the driver's base tables."""

from __future__ import annotations

from martlane.oracle import (ADS_UPSERT, BASE, MASTER_ORDER_STORES_SQL, ORDER_MART, ORDER_NUMBERED, PARTS,
                             STORE_UNION_CUSTOMERS, _ads_records)
from martlane.suite_loads import ABSENT, ADS_ASKED_FROM, CUT_CHUNKS, FIRST_WINS_DELAY, PAGE
from martlane.suite_common import ADS_TODAY

_ADS = _ads_records("TRUE", "1.0")
_ORDERS_OF_MASTERS = f"SELECT * FROM ({ORDER_MART}) m WHERE source_store IN ({MASTER_ORDER_STORES_SQL})"

LOADS = {
    "ads_rejects": f"""
WITH d AS (SELECT date_start, position // {PAGE} AS page, count(*) AS n, sum(spend) AS spend, day(CAST(date_start AS DATE)) % 7 AS k
  FROM {_ADS} GROUP BY ALL)
SELECT date_start || '_' || CAST(page AS VARCHAR) AS document,
  CASE k WHEN 0 THEN 'not JSON or cut short' WHEN 3 THEN 'empty' END AS reason,
  CASE WHEN k IN (0, 3, 5) THEN 0 ELSE n END AS records,
  CASE WHEN k NOT IN (0, 3, 5) THEN CAST(spend AS DOUBLE) END AS spend FROM d""",

    "ads_missing_chunks": f"""
WITH RECURSIVE ch(s) AS (SELECT DATE '{ADS_ASKED_FROM}' UNION ALL SELECT CAST(s + INTERVAL 1 MONTH AS DATE) FROM ch
    WHERE CAST(s + INTERVAL 1 MONTH AS DATE) <= DATE '{ADS_TODAY}'),
c AS (SELECT s, least(CAST(s + INTERVAL 1 MONTH AS DATE) - 1, DATE '{ADS_TODAY}') AS e FROM ch)
SELECT CAST(s AS VARCHAR) AS chunk_start, CAST(e AS VARCHAR) AS chunk_end,
  CASE WHEN CAST(s AS VARCHAR) IN ('{"', '".join(CUT_CHUNKS)}') THEN 'to be asked for' ELSE 'landed' END AS state,
  CASE WHEN CAST(s AS VARCHAR) IN ('{"', '".join(CUT_CHUNKS)}') THEN 0 ELSE
    (SELECT count(*) FROM {_ADS} a WHERE CAST(a.date_start AS DATE) BETWEEN s AND e) END AS records
FROM c""",

    "ads_daily_upsert": ADS_UPSERT,
    "ads_day_list": f"""
SELECT date_start AS day, count(*) AS rows, max(date_stop) AS mark FROM ({ADS_UPSERT}) GROUP BY 1""",

    "ads_first_wins_stream": f"""
SELECT campaign_name, ad_name, adset_name, impressions::INTEGER AS impressions, clicks::INTEGER AS clicks,
  CAST(spend AS DOUBLE) AS spend, CAST(cpc AS DOUBLE) AS cpc, CAST(purchase_roas AS DOUBLE) AS purchase_roas, date_start, date_stop
FROM {_ADS}
WHERE CAST(date_start AS DATE) <= (SELECT CAST(max(ts) AS DATE) - {FIRST_WINS_DELAY} FROM events)
QUALIFY row_number() OVER (PARTITION BY ad_name, date_start ORDER BY position) = 1""",

    "load_first_wins": "WITH " + BASE + """,
other_items AS (
  SELECT store AS source_store, -(o_orderkey * 4 + 1) AS id, 'shipping' AS label FROM ord
  UNION ALL SELECT store, -(o_orderkey * 4 + 2), 'shipping' FROM ord WHERE o_orderpriority = '2-HIGH'
  UNION ALL SELECT store, -(o_orderkey * 4 + 3), 'fee' FROM ord WHERE o_orderpriority = '1-URGENT'),
ids AS (
  SELECT 'orders' AS tab, store, order_id AS id, post_type AS label FROM posts
  UNION ALL SELECT 'items', store, item_id, 'line_item' FROM lines
  UNION ALL SELECT 'items', source_store, id, label FROM other_items),
ext AS (
  SELECT *, 1 AS extract FROM ids
  UNION ALL SELECT tab, store, id, 'changed', 2 FROM ids WHERE id % 3 = 0
  UNION ALL SELECT tab, store, id, label, 3 FROM ids WHERE id % 5 = 0
  UNION ALL SELECT tab, store, NULL, label, 4 FROM ids WHERE id % 101 = 0)
SELECT tab, store AS source_store, CAST(id AS DOUBLE) AS id, label, extract,
  CASE WHEN id IS NULL THEN 'NULL in key'
       WHEN extract = min(extract) OVER (PARTITION BY tab, store, id) THEN 'kept' ELSE 'duplicate key' END AS outcome
FROM ext""",

    "returns_by_product_collated": "WITH " + BASE + "," + PARTS + """,
rp AS (
  SELECT l.l_partkey, l.l_orderkey, o.o_orderdate,
    CASE l.l_orderkey % 3 WHEN 1 THEN 'p' WHEN 2 THEN 'Ṕ' ELSE 'P' END || CAST(l.l_partkey AS VARCHAR) AS sku
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_returnflag = 'R')
SELECT min(rp.sku) AS sku, pa.p_name AS product_name, 'M-' || CAST(pa.b AS VARCHAR) AS parent_sku, pa.categories,
  count(DISTINCT rp.l_orderkey)::INTEGER AS total_returns,
  min(rp.o_orderdate) AS first_return_date, max(rp.o_orderdate) AS last_return_date
FROM rp LEFT JOIN pa ON rp.l_partkey = pa.p_partkey
GROUP BY lower(strip_accents(rp.sku)), pa.p_name, pa.b, pa.categories""",

    "distinct_skus_collated": "WITH " + BASE + """,
skus AS (
  SELECT sstore, p_partkey AS id, 'P' || CAST(p_partkey AS VARCHAR) || '-' || sstore AS sku
  FROM part, stores WHERE p_size NOT IN (1, 2)
  UNION ALL SELECT sstore, s_suppkey + 2000000000000, 'V' || CAST(s_suppkey AS VARCHAR) || '-' || sstore
  FROM supplier, stores WHERE s_nationkey <> 0),
spelled AS (
  SELECT sstore, sku FROM skus UNION ALL
  SELECT sstore, CASE id % 3 WHEN 1 THEN lower(sku) WHEN 2 THEN replace(sku, 'P', 'Ṕ') ELSE sku END FROM skus)
SELECT sstore AS source_store, count(DISTINCT sku) AS binary_skus, count(DISTINCT lower(sku)) AS no_case_skus,
  count(DISTINCT lower(strip_accents(sku))) AS no_accent_skus,
  count(*) FILTER (lower(strip_accents(sku)) LIKE 'p1%') AS like_no_accent,
  count(*) FILTER (lower(sku) LIKE 'p1%') AS like_no_case
FROM spelled GROUP BY 1""",

    "order_units_collated": "WITH " + BASE + f"""
,spelled AS (
  SELECT lines.*, 'V' || l_suppkey || '-' || store AS v,
    CASE WHEN l_partkey % 2 = 1 THEN lower('P' || (l_partkey // 2) || '-' || store) ELSE 'P' || (l_partkey // 2) || '-' || store END AS p
  FROM lines),
named AS (
  SELECT l_orderkey, replace(replace(shape, '#', v), '@', p) AS label,
    CASE WHEN v_state = 'known' THEN v WHEN p_state = 'known' THEN p ELSE CAST(l_partkey AS VARCHAR) END AS unit
  FROM spelled JOIN label_of ON p_state = lp AND v_state = lv),
units AS (SELECT l_orderkey, count(DISTINCT lower(unit)) AS n FROM named GROUP BY 1),
labels AS (SELECT l_orderkey, string_agg(label, ', ' ORDER BY label) AS skus
  FROM (SELECT l_orderkey, min(label) AS label FROM named GROUP BY l_orderkey, lower(label)) GROUP BY 1)
SELECT m.source_store, m.order_id, coalesce(n, 0)::INTEGER AS units_total, coalesce(skus, '') AS ordered_items_skus
FROM ({ORDER_MART}) m LEFT JOIN units u ON m.order_id = u.l_orderkey LEFT JOIN labels s ON m.order_id = s.l_orderkey""",

    "extracted_store_orders": _ORDERS_OF_MASTERS + f" AND source_store <> '{ABSENT}'",

    "landed_store_customers": f"SELECT * FROM ({STORE_UNION_CUSTOMERS}) WHERE source_store <> '{ABSENT}'",

    "master_orders_filled": "WITH " + BASE + "," + ORDER_NUMBERED + f"""
SELECT m.* REPLACE (coalesce(nullif(trim(num), ''), 'ORD' || CAST(m.order_id AS VARCHAR)) AS order_number_formatted)
FROM ({ORDER_MART}) m JOIN onum ON m.source_store = onum.store AND m.order_id = onum.order_id
WHERE m.source_store IN ({MASTER_ORDER_STORES_SQL})""",

    "export_round_trip": f"""
SELECT source_store, order_id, order_date, channel, units_total, gross_total, net_margin, format
FROM ({ORDER_MART}) m, (VALUES ('tsv'), ('csv'), ('json')) f(format)""",
}
