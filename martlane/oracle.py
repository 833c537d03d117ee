"""Independent DuckDB SQL for each registered query.

Each statement recomputes the expected result from the driver's base tables
(region nation customer supplier part orders lineitem events pages ...), restating the
shaping rules of ``martlane.sources.shop_shape`` directly instead of replaying the
Spark steps (no EAV round trip).  Money is compared as DOUBLE.
"""

from __future__ import annotations

from martlane.sources.shop_shape import (NATION_STORE, PAYMENT_OF_PRIORITY, POST_STATUS,
                                         STORE_ORDER_CURRENCY)
from martlane import schemas as S


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, (int, float)):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


BASE = f"""
ns(nk, store) AS (VALUES {_values(enumerate(NATION_STORE))}),
cur(cstore, currency) AS (VALUES {_values(STORE_ORDER_CURRENCY.items())}),
pay(prio, method) AS (VALUES {_values(PAYMENT_OF_PRIORITY.items())}),
pst(st, post_status) AS (VALUES {_values(POST_STATUS.items())}),
stores(sstore, place) AS (SELECT store, min(nk) FROM ns GROUP BY store),
rpx(rstore, prefix) AS (VALUES {_values(S.REFUND_PREFIX.items())}),
cust AS (
  SELECT c.c_custkey, c.c_name, c.c_mktsegment, n.n_name, ns.store
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN ns ON c.c_nationkey = ns.nk),
ord AS (
  SELECT o.*, cust.c_mktsegment, cust.n_name, cust.store
  FROM orders o LEFT JOIN cust ON o.o_custkey = cust.c_custkey),
-- what a store's lookup holds of a product: a SKU, an empty one, no row
psku AS (
  SELECT p_partkey, p_size, CASE p_size WHEN 1 THEN 'blank' WHEN 2 THEN 'none' ELSE 'known' END AS p_state FROM part),
vsku AS (
  SELECT s_suppkey, CASE s_nationkey WHEN 0 THEN 'blank' ELSE 'known' END AS v_state FROM supplier),
-- the label that goes with each pair of states (@ and # stand for the two SKUs)
label_of(lp, lv, shape) AS (VALUES
  ('known', 'known', '@(#)'), ('known', 'blank', '@()'), ('known', 'none', '@'),
  ('blank', 'known', '(#)'), ('none', 'known', '#'),
  ('blank', 'blank', '(Unregistered SKU)'), ('blank', 'none', '(Unregistered SKU)'),
  ('none', 'blank', '(Unregistered SKU)'), ('none', 'none', '(Unregistered SKU)')),
pim_of(mp, mv, mshape) AS (VALUES
  ('known', 'known', '@(#)'), ('known', 'none', '@'), ('none', 'known', '#'), ('none', 'none', NULL)),
lines AS (
  SELECT l.*, l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
      l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS item_id,
    ord.store, coalesce(p_state, 'none') AS p_state,
    CASE WHEN l.l_linestatus = 'O' THEN coalesce(v_state, 'none') ELSE 'none' END AS v_state
  FROM lineitem l LEFT JOIN ord ON l.l_orderkey = ord.o_orderkey
  LEFT JOIN psku ON l.l_partkey = p_partkey LEFT JOIN vsku ON l.l_suppkey = s_suppkey),
labeled AS (
  SELECT lines.*,
    replace(replace(shape, '#', 'V' || l_suppkey || '-' || store), '@', 'P' || l_partkey || '-' || store) AS label,
    CASE WHEN v_state = 'known' THEN 'V' || l_suppkey || '-' || store
         WHEN p_state = 'known' THEN 'P' || l_partkey || '-' || store ELSE CAST(l_partkey AS VARCHAR) END AS unit
  FROM lines JOIN label_of ON p_state = lp AND v_state = lv),
la AS (
  SELECT l_orderkey,
    count(DISTINCT unit) AS units_total,
    CAST(round(sum(CAST(CAST(l_quantity AS INTEGER) AS DECIMAL(12,2))), 0) AS INTEGER) AS items_count,
    sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS line_sum,
    string_agg(DISTINCT label, ', ' ORDER BY label) AS skus
  FROM labeled GROUP BY l_orderkey),
refunds AS (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS amt
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey),
posts AS (
  SELECT store, o_orderkey AS order_id, 'shop_order' AS post_type, o_orderkey AS k,
         o_orderdate AS order_date, o_orderstatus, o_orderpriority, o_custkey,
         CAST(o_totalprice AS DECIMAL(12,2)) AS total, c_mktsegment, n_name, NULL::DECIMAL(12,2) AS refund_amt
  FROM ord
  UNION ALL
  SELECT ord.store, o_orderkey + 1000000000000, 'shop_order_refund', o_orderkey,
         o_orderdate, NULL, NULL, NULL, NULL, NULL, NULL, refunds.amt
  FROM refunds JOIN ord ON refunds.l_orderkey = ord.o_orderkey),
kept AS (
  SELECT * FROM posts
  WHERE store <> 'OPS' OR (post_type = 'shop_order' AND o_orderpriority IN ('1-URGENT', '2-HIGH'))),
om AS (
  SELECT p.*, la.units_total, la.items_count, la.line_sum, la.skus,
    CASE WHEN p.post_type = 'shop_order' THEN round(p.total * 0.07, 2) END AS tax,
    CASE WHEN p.o_orderpriority = '1-URGENT' THEN 2.50 END AS fee,
    CASE WHEN p.post_type = 'shop_order' THEN
      (CASE p.o_orderstatus WHEN 'F' THEN 4.95 WHEN 'O' THEN 0.00 ELSE 7.50 END)
      + (CASE WHEN p.o_orderpriority = '2-HIGH' THEN 9.90 ELSE 0 END) END AS ship_sum,
    CASE WHEN p.post_type <> 'shop_order' THEN NULL
         WHEN p.o_orderpriority = '2-HIGH' THEN 9.90
         ELSE (CASE p.o_orderstatus WHEN 'F' THEN 4.95 WHEN 'O' THEN 0.00 ELSE 7.50 END) END AS ship_first,
    CASE WHEN p.o_orderpriority = '1-URGENT' THEN round(p.total * 0.05, 2) ELSE 0 END AS discount
  FROM kept p LEFT JOIN la ON p.order_id = la.l_orderkey),
omx AS (
  SELECT om.*,
    CASE WHEN line_sum IS NULL THEN 0
         ELSE line_sum + coalesce(tax, 0) + coalesce(fee, 0) + coalesce(ship_sum, 0) END AS gross,
    coalesce(refund_amt, 0) AS refunded
  FROM om)
"""


ORDER_MART = "WITH " + BASE + """
SELECT omx.store AS source_store, order_id,
  CASE WHEN omx.store = 'TR' THEN CAST(order_id AS VARCHAR)
       WHEN post_type = 'shop_order_refund' THEN coalesce(rpx.prefix, '') || '-REFUND-' || CAST(order_id AS VARCHAR)
       WHEN omx.store IN ('TR', 'OPS') THEN NULL
       WHEN omx.store = 'NL' AND o_orderpriority = '3-MEDIUM' THEN 'NULL'
       WHEN omx.store = 'BE' AND o_orderpriority = '2-HIGH' THEN '  '
       ELSE omx.store || '-' || CAST(k AS VARCHAR) END AS order_number_formatted,
  order_date,
  CASE WHEN post_type = 'shop_order' THEN pst.post_status ELSE 'wc-completed' END AS order_status,
  CASE WHEN post_type <> 'shop_order' THEN NULL WHEN o_orderpriority = '5-LOW' THEN 0
       ELSE o_custkey + 1 END::DOUBLE AS customer_id,
  omx.store AS country_code, 'WOO-' || omx.store AS channel, c_mktsegment AS billing_city,
  coalesce(skus, '') AS ordered_items_skus,
  0::DOUBLE AS cogs, 0::DOUBLE AS ads_spend, 0::DOUBLE AS logistics_cost, 0::DOUBLE AS other_costs,
  CAST(gross - discount + refunded AS DOUBLE) AS net_revenue, CAST(gross - discount + refunded AS DOUBLE) AS net_profit,
  CASE WHEN gross - discount + refunded > 0 THEN 100 ELSE 0 END::DOUBLE AS net_margin,
  CASE WHEN post_type <> 'shop_order' THEN NULL
       WHEN o_orderstatus = 'P' THEN CAST(k AS VARCHAR)
       ELSE 'shop-' || lower(c_mktsegment) || '.example.com' END AS site,
  n_name AS billing_country,
  o_orderpriority AS payment_method,
  CASE WHEN post_type = 'shop_order' THEN coalesce(cur.currency, 'EUR') END AS currency_code,
  coalesce(units_total, 0)::INTEGER AS units_total,
  coalesce(items_count, 0)::INTEGER AS ordered_items_count,
  CAST(coalesce(line_sum, 0) AS DOUBLE) AS subtotal,
  CAST(gross AS DOUBLE) AS gross_total,
  CAST(tax AS DOUBLE) AS tax_amount,
  CAST(ship_first AS DOUBLE) AS shipping_fee,
  CAST(fee AS DOUBLE) AS fee_amount,
  CAST(discount AS DOUBLE) AS discount_amount,
  CAST(refunded AS DOUBLE) AS refunded_amount,
  CAST(coalesce(total, 0) AS DOUBLE) AS total_price
FROM omx
LEFT JOIN pst ON omx.o_orderstatus = pst.st
LEFT JOIN cur ON omx.store = cur.cstore
LEFT JOIN rpx ON omx.store = rpx.rstore
"""


PART_COST = """
pcost AS (
  SELECT p_partkey,
    round(CAST(p_retailprice AS DECIMAL(12,2)) * 0.01, 2) AS wc,
    round(CAST(p_retailprice AS DECIMAL(12,2)) * 0.011, 2) AS alt,
    p_type
  FROM part),
pcost2 AS (
  SELECT p_partkey, wc + CASE p_type WHEN 'PROMO' THEN trunc(alt) WHEN 'SMALL' THEN 0
                                   WHEN 'LARGE' THEN -alt WHEN 'ECONOMY' THEN 0 ELSE alt END AS unit_cost
  FROM pcost),
lc AS (
  SELECT l_orderkey, sum(CAST(CAST(l_quantity AS INTEGER) AS DECIMAL(12,2)) * (unit_cost + place * 0.01)) AS cogs
  FROM lines JOIN pcost2 ON l_partkey = p_partkey JOIN stores ON lines.store = sstore GROUP BY l_orderkey)
"""

ORDER_PROFIT = "WITH " + BASE + "," + PART_COST + """,
pr AS (
  SELECT omx.store, order_id, gross, discount, refunded,
         CASE WHEN post_type = 'shop_order' THEN coalesce(lc.cogs, 0) ELSE 0 END AS cogs
  FROM omx LEFT JOIN lc ON omx.order_id = lc.l_orderkey),
pr2 AS (
  SELECT *, gross - discount + refunded AS rev, gross - discount + refunded - cogs AS profit FROM pr)
SELECT store AS source_store, order_id,
  CAST(gross AS DOUBLE) AS gross_total,
  CAST(CAST(cogs AS DECIMAL(12,2)) AS DOUBLE) AS cogs,
  CAST(round(rev, 2) AS DOUBLE) AS net_revenue,
  CAST(round(profit, 2) AS DOUBLE) AS net_profit,
  CAST(CASE WHEN rev > 0 THEN greatest(least(round(CAST(profit / rev AS DECIMAL(18,6)) * 100, 2), 9999.99), -9999.99)
            ELSE 0 END AS DOUBLE) AS net_margin
FROM pr2
"""

ORDER_SKU_LIST = "WITH " + BASE + """
SELECT store AS source_store, order_id, coalesce(units_total, 0)::INTEGER AS units_total,
       coalesce(skus, '') AS ordered_items_skus
FROM omx
"""


ORACLE = {
    "order_mart": ORDER_MART,
    "order_profit": ORDER_PROFIT,
    "order_sku_list": ORDER_SKU_LIST,
}


ITEM_LINES = """
il AS (
  SELECT lines.*, ord.o_orderdate, mshape,
    CASE WHEN l_linestatus = 'O' THEN l_suppkey + 2000000000000 END AS variation_id,
    round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS net
  FROM lines LEFT JOIN ord ON l_orderkey = o_orderkey
  JOIN pim_of ON mp = CASE p_state WHEN 'known' THEN 'known' ELSE 'none' END
    AND mv = CASE v_state WHEN 'known' THEN 'known' ELSE 'none' END)
"""

ORDER_ITEMS_SKU = "WITH " + BASE + "," + ITEM_LINES + """
SELECT il.item_id AS order_item_id, il.l_orderkey AS order_id, il.l_partkey AS product_id, CAST(il.variation_id AS DOUBLE) AS variation_id,
  replace(replace(mshape, '#', 'V' || l_suppkey), '@', 'P' || l_partkey) AS sku,
  'Part ' || CAST(il.l_partkey AS VARCHAR) AS order_item_name,
  CAST(il.l_quantity AS INTEGER) AS quantity,
  CAST(il.net AS DOUBLE) AS line_total,
  CAST(round(il.net * CAST(il.l_tax AS DECIMAL(4,2)), 2) AS DOUBLE) AS line_tax,
  CAST(CASE WHEN il.l_returnflag = 'R' THEN il.l_orderkey + 1000000000000 END AS DOUBLE) AS refund_reference,
  coalesce(cur.currency, 'EUR') AS currency_code,
  il.store AS source_store,
  il.o_orderdate AS created_at
FROM il
LEFT JOIN cur ON il.store = cur.cstore
"""

UNIT_COST_MAP = """
WITH pc AS (
  SELECT p_partkey, p_type,
    round(CAST(p_retailprice AS DECIMAL(12,2)) * 0.01, 2) AS wc,
    round(CAST(p_retailprice AS DECIMAL(12,2)) * 0.011, 2) AS alt
  FROM part)
SELECT p_partkey AS product_id,
  CAST(CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE', 'ECONOMY') THEN wc ELSE greatest(wc, alt) END AS DOUBLE)
    AS cog_value
FROM pc WHERE wc > 0
"""

MARKETPLACE_FILTER = "WITH " + BASE + """
SELECT store AS source_store, order_id, post_type, o_orderpriority AS payment_method
FROM kept WHERE store = 'OPS'
"""

REFUND_NUMBERS = "WITH " + BASE + """
SELECT kept.store AS source_store, order_id,
  CASE WHEN kept.store = 'TR' THEN CAST(order_id AS VARCHAR)
       ELSE coalesce(rpx.prefix, '') || '-REFUND-' || CAST(order_id AS VARCHAR) END AS order_number_formatted
FROM kept LEFT JOIN rpx ON kept.store = rpx.rstore
WHERE post_type = 'shop_order_refund'
"""

CUSTOMERS = """
nl AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
ocm AS (
  SELECT store, CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE o_custkey + 1 END AS customer_id,
    min(o_orderdate) AS first_order_date, max(o_orderdate) AS last_order_date,
    count(*) AS orders_count, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS ltv,
    sum(coalesce(nl.n, 0)) AS units_total
  FROM ord LEFT JOIN nl ON ord.o_orderkey = nl.l_orderkey
  GROUP BY 1, 2),
rcm AS (
  SELECT store, CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE o_custkey + 1 END AS customer_id,
    sum(refunds.amt) AS refunds_total
  FROM refunds JOIN ord ON refunds.l_orderkey = ord.o_orderkey
  GROUP BY 1, 2),
cb AS (
  SELECT c_custkey + 1 AS customer_id, store, c_mktsegment, n_name,
    regexp_extract(c_name, '([0-9]+)$', 1) AS no
  FROM cust),
cm AS (
  SELECT cb.customer_id, cb.store,
    CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN no
         WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Ann'
         WHEN c_mktsegment = 'MACHINERY' THEN 'Bill ' || no
         ELSE 'Ann ' || no END AS full_name,
    'user' || CAST(cb.customer_id - 1 AS VARCHAR) || '@example.com' AS email,
    '+31-' || no AS phone,
    CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE TIMESTAMP '2020-01-01 00:00:00' END AS registered_at,
    ocm.first_order_date, ocm.last_order_date,
    coalesce(ocm.orders_count, 0)::INTEGER AS orders_count,
    coalesce(ocm.units_total, 0)::INTEGER AS units_total,
    coalesce(ocm.ltv, 0) AS ltv,
    CASE WHEN coalesce(ocm.orders_count, 0) > 0
         THEN round(CAST(ocm.ltv / ocm.orders_count AS DECIMAL(18,6)), 2) ELSE 0 END AS aov,
    coalesce(rcm.refunds_total, 0) AS refunds_total,
    n_name AS billing_country, c_mktsegment AS billing_city
  FROM cb
  LEFT JOIN ocm ON cb.store = ocm.store AND cb.customer_id = ocm.customer_id
  LEFT JOIN rcm ON cb.store = rcm.store AND cb.customer_id = rcm.customer_id)
"""

CUSTOMER_MART = "WITH " + BASE + "," + CUSTOMERS + """
SELECT customer_id, full_name, email, phone, registered_at, first_order_date, last_order_date,
  orders_count, units_total, CAST(ltv AS DOUBLE) AS ltv, CAST(aov AS DOUBLE) AS aov,
  CAST(refunds_total AS DOUBLE) AS refunds_total, store AS source_store, billing_country, billing_city
FROM cm
"""

REFUND_BY_PARENT = "WITH " + BASE + "," + CUSTOMERS + """
SELECT store AS source_store, customer_id, CAST(refunds_total AS DOUBLE) AS refunds_total FROM rcm
"""

MASTER_ORDER_STORES_SQL = ", ".join(_lit(s) for s in S.MASTER_ORDER_STORES)
MASTER_CUSTOMER_STORES_SQL = ", ".join(_lit(s) for s in S.MASTER_CUSTOMER_STORES)

ORDER_NUMBERED = """
onum AS (
  SELECT omx.*, CAST(coalesce(total, 0) AS DECIMAL(12,2)) AS total_price,
    CASE WHEN omx.store = 'TR' THEN CAST(order_id AS VARCHAR)
         WHEN post_type = 'shop_order_refund' THEN coalesce(rpx.prefix, '') || '-REFUND-' || CAST(order_id AS VARCHAR)
         WHEN omx.store IN ('TR', 'OPS') THEN NULL
         WHEN omx.store = 'NL' AND o_orderpriority = '3-MEDIUM' THEN 'NULL'
         WHEN omx.store = 'BE' AND o_orderpriority = '2-HIGH' THEN '  '
         ELSE omx.store || '-' || CAST(k AS VARCHAR) END AS num,
    CASE WHEN post_type <> 'shop_order' THEN NULL WHEN o_orderpriority = '5-LOW' THEN 0
         ELSE o_custkey + 1 END::BIGINT AS customer_id,
    CASE WHEN post_type = 'shop_order' THEN coalesce(cur.currency, 'EUR') END AS currency_code,
    gross - discount + refunded AS rev
  FROM omx LEFT JOIN rpx ON omx.store = rpx.rstore LEFT JOIN cur ON omx.store = cur.cstore),
mo AS (
  SELECT * FROM onum
  WHERE store IN (""" + MASTER_ORDER_STORES_SQL + """)
    AND num IS NOT NULL AND num <> '' AND length(trim(num)) > 0 AND num <> 'NULL')
"""

STORE_UNION_ORDERS = "WITH " + BASE + "," + ORDER_NUMBERED + """
SELECT m.* REPLACE (trim(m.order_number_formatted) AS order_number_formatted)
FROM (""" + ORDER_MART + """) m JOIN mo ON m.source_store = mo.store AND m.order_id = mo.order_id
"""

CUSTOMER_NUMBERED = """
cpx(cpstore, cprefix) AS (VALUES """ + _values(S.CUSTOMER_PREFIX.items()) + """),
mc AS (
  SELECT cm.*,
    CASE WHEN store = 'TR' THEN CAST(customer_id AS VARCHAR)
         WHEN cprefix IS NOT NULL THEN cprefix || '-' || store || '-' || CAST(customer_id AS VARCHAR)
         ELSE store || '-' || CAST(customer_id AS VARCHAR) END AS customer_number_formatted
  FROM cm LEFT JOIN cpx ON cm.store = cpx.cpstore
  WHERE store IN (""" + MASTER_CUSTOMER_STORES_SQL + """))
"""

STORE_UNION_CUSTOMERS = "WITH " + BASE + "," + CUSTOMERS + "," + CUSTOMER_NUMBERED + """
SELECT customer_number_formatted, store AS source_store, customer_id, full_name, email, phone, registered_at,
  first_order_date, last_order_date, orders_count, units_total, CAST(ltv AS DOUBLE) AS ltv, CAST(aov AS DOUBLE) AS aov,
  CAST(refunds_total AS DOUBLE) AS refunds_total, billing_country, billing_city
FROM mc
"""

RATES = "rates(rcur, rate) AS (VALUES " + ", ".join(
    f"('{c}', CAST('{r}' AS DECIMAL(12,6)))" for c, r in S.SEED_RATES) + ")"

CUSTOMERS_EUR = "WITH " + BASE + "," + CUSTOMERS + "," + CUSTOMER_NUMBERED + "," + RATES + """,
-- the stores that do not report in euros
sells(vstore, vcur) AS (VALUES ('CZ', 'CZK'), ('DK', 'DKK'), ('HU', 'HUF'), ('RO', 'RON'), ('SE', 'SEK'), ('TR', 'TRY')),
mce AS (SELECT mc.*, coalesce(vcur, 'EUR') AS ccy FROM mc LEFT JOIN sells ON store = vstore)
SELECT customer_id, full_name, email, store AS source_store, billing_country, billing_city,
  CAST(ltv AS DOUBLE) AS original_ltv, CAST(aov AS DOUBLE) AS original_aov,
  CAST(coalesce(rate, 1.0) AS DOUBLE) AS rate_to_eur,
  CAST(round(ltv * coalesce(rate, 1.0), 2) AS DOUBLE) AS ltv_eur,
  CAST(round(aov * coalesce(rate, 1.0), 2) AS DOUBLE) AS aov_eur,
  orders_count, units_total, registered_at, last_order_date
FROM mce LEFT JOIN rates ON mce.ccy = rates.rcur
"""

ORDERS_EUR = "WITH " + BASE + "," + ORDER_NUMBERED + "," + RATES + """
SELECT store AS source_store, trim(num) AS order_number_formatted, order_id, currency_code,
  CAST(round(coalesce(line_sum, 0) * rate, 2) AS DOUBLE) AS subtotal,
  CAST(round(gross * rate, 2) AS DOUBLE) AS gross_total,
  CAST(round(0 * rate, 2) AS DOUBLE) AS cogs,
  CAST(round(total_price * rate, 2) AS DOUBLE) AS total_price,
  CAST(round(tax * rate, 2) AS DOUBLE) AS tax_amount,
  CAST(round(ship_first * rate, 2) AS DOUBLE) AS shipping_fee,
  CAST(round(fee * rate, 2) AS DOUBLE) AS fee_amount,
  CAST(round(discount * rate, 2) AS DOUBLE) AS discount_amount,
  CAST(round(refunded * rate, 2) AS DOUBLE) AS refunded_amount,
  CAST(round(0 * rate, 2) AS DOUBLE) AS ads_spend,
  CAST(round(0 * rate, 2) AS DOUBLE) AS logistics_cost,
  CAST(round(0 * rate, 2) AS DOUBLE) AS other_costs,
  CAST(round(round(rev, 2) * rate, 2) AS DOUBLE) AS net_profit,
  CAST(round(round(rev, 2) * rate, 2) AS DOUBLE) AS net_revenue,
  CAST(CASE WHEN rev > 0 THEN 100 ELSE 0 END AS DOUBLE) AS net_margin
FROM mo LEFT JOIN rates ON mo.currency_code = rates.rcur
"""

ORACLE.update({
    "order_items_sku": ORDER_ITEMS_SKU,
    "unit_cost_map": UNIT_COST_MAP,
    "marketplace_filter": MARKETPLACE_FILTER,
    "refund_numbers": REFUND_NUMBERS,
    "customer_mart": CUSTOMER_MART,
    "refund_by_parent": REFUND_BY_PARENT,
    "store_union_orders": STORE_UNION_ORDERS,
    "store_union_customers": STORE_UNION_CUSTOMERS,
    "customers_eur": CUSTOMERS_EUR,
    "orders_eur": ORDERS_EUR,
})


PARTS = """
pt AS (SELECT p_type, 3000 + dense_rank() OVER (ORDER BY p_type) AS tid FROM (SELECT DISTINCT p_type FROM part)),
pp AS (
  SELECT p.*, CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) AS b, pt.tid,
    round(CAST(p_retailprice AS DECIMAL(12,2)) * 0.01, 2) AS wc,
    round(CAST(p_retailprice AS DECIMAL(12,2)) * 0.011, 2) AS alt
  FROM part p LEFT JOIN pt ON p.p_type = pt.p_type),
pa AS (
  SELECT *,
    'Color:Brand ' || CAST(b AS VARCHAR) || ',' || p_type || ', Size:'
      || CASE WHEN p_size <= 25 THEN 'EU ' || CAST(p_size AS VARCHAR) ELSE CAST(2000 + p_size AS VARCHAR) END
      || ', Marka:0' AS attributes,
    CASE WHEN p_size >= 3 AND p_size <= 45 THEN p_type END AS categories,
    CASE WHEN p_size >= 3 THEN 'Brand ' || CAST(b AS VARCHAR) END AS tags,
    CAST(wc AS VARCHAR) AS wc_txt,
    CASE p_type WHEN 'PROMO' THEN replace(CAST(alt AS VARCHAR), '.', ',') WHEN 'SMALL' THEN 'n/a'
                WHEN 'LARGE' THEN '-' || CAST(alt AS VARCHAR) WHEN 'ECONOMY' THEN '0'
                ELSE CAST(alt AS VARCHAR) END AS alg_txt
  FROM pp),
gp AS (
  SELECT DISTINCT p_partkey AS product_id, image_id FROM (
    SELECT p_partkey, CAST(p_size AS BIGINT) AS image_id FROM part WHERE p_size >= 3
    UNION ALL
    SELECT p_partkey, CAST(p_size * 3 AS BIGINT) FROM part WHERE p_size >= 3)),
img AS (
  SELECT gp.product_id,
    string_agg(pg.url, ',' ORDER BY gp.image_id) FILTER (WHERE pg.url IS NOT NULL) AS image_url
  FROM gp LEFT JOIN (SELECT page_id, url FROM pages WHERE url NOT LIKE '%#top') pg ON gp.image_id = pg.page_id
  GROUP BY gp.product_id)
"""

PRODUCT_PIVOT_ATTRIBUTES = "WITH " + PARTS + """
SELECT p_partkey AS product_id, attributes FROM pa
"""

CATEGORY_ROLLUP = "WITH " + PARTS + """
SELECT p_partkey AS product_id, categories, tags FROM pa WHERE p_size >= 3
"""

GALLERY_PAIRS = "WITH " + PARTS + """
SELECT product_id, image_id FROM gp
"""

IMAGE_ROLLUP = "WITH " + PARTS + """
SELECT product_id, image_url FROM img
"""

PRODUCT_MASTER = "WITH " + PARTS + """
SELECT p_partkey AS product_id, p_name AS title, 'P' || CAST(p_partkey AS VARCHAR) AS sku,
  'M-' || CAST(b AS VARCHAR) AS parent_sku, attributes,
  CASE WHEN p_size = 2 THEN NULL ELSE p_size * 3 END::DOUBLE AS stock_qty,
  categories, tags,
  CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS regular_price,
  CAST(CASE WHEN p_size > 40 THEN round(CAST(p_retailprice AS DECIMAL(12,2)) * 0.9, 2) END AS DOUBLE) AS sale_price,
  img.image_url,
  CAST(coalesce(TRY_CAST(nullif(regexp_extract(CASE WHEN wc_txt > alg_txt THEN wc_txt ELSE alg_txt END,
        '^\\s*([+-]?([0-9]+([.][0-9]*)?|[.][0-9]+))', 1), '') AS DECIMAL(12,2)), 0) AS DOUBLE) AS cogs
FROM pa LEFT JOIN img ON pa.p_partkey = img.product_id
"""

ORACLE.update({
    "product_pivot_attributes": PRODUCT_PIVOT_ATTRIBUTES,
    "category_rollup": CATEGORY_ROLLUP,
    "gallery_pairs": GALLERY_PAIRS,
    "image_rollup": IMAGE_ROLLUP,
    "product_master": PRODUCT_MASTER,
})


RETURNS = """
rl AS (
  SELECT l.*, ord.o_orderpriority,
    CASE WHEN l.l_linestatus = 'O' THEN ' P' || CAST(l.l_partkey AS VARCHAR) || chr(13)
         ELSE 'P' || CAST(l.l_partkey AS VARCHAR) END AS sku,
    CASE WHEN l.l_linestatus = 'O'
           THEN '{"pa_renk":{"value":"brand-' || CAST(pp.b AS VARCHAR) || '"},"pa_beden":{"value":"'
                || CAST(pp.p_size + 2000 AS VARCHAR) || '"},"x":{"value":"y"}}'
         WHEN l.l_discount > 0.05 THEN '[]'
         ELSE '{"pa_materyal":{"value":"cotton"},"pa_beden":{"value":"size-' || CAST(pp.p_size AS VARCHAR) || '"}}'
    END AS blob,
    CASE WHEN l.l_linestatus = 'O'
           THEN 'Color:Brand ' || CAST(pp.b AS VARCHAR) || ', Size:'
                || CASE WHEN pp.p_size <= 25 THEN 'EU ' || CAST(pp.p_size AS VARCHAR) ELSE CAST(pp.p_size + 2000 AS VARCHAR) END
         WHEN l.l_discount > 0.05 THEN NULL
         ELSE 'Material:cotton, Size:'
                || CASE WHEN pp.p_size <= 25 THEN 'EU ' || CAST(pp.p_size AS VARCHAR) ELSE 'size-' || CAST(pp.p_size AS VARCHAR) END
    END AS decoded
  FROM lines l JOIN ord ON l.l_orderkey = ord.o_orderkey
  LEFT JOIN pp ON l.l_partkey = pp.p_partkey
  WHERE l.l_returnflag = 'R'),
ri AS (
  SELECT l_orderkey, count(*) AS n, string_agg(sku, ', ' ORDER BY item_id) AS skus,
    string_agg(DISTINCT 'reason-' || l_linestatus, ', ' ORDER BY 'reason-' || l_linestatus) AS reasons,
    sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS total,
    string_agg(decoded, ' || ' ORDER BY item_id) FILTER (WHERE decoded IS NOT NULL) AS attrs
  FROM rl GROUP BY l_orderkey),
rs AS (
  SELECT ord.*, ri.*, pst.post_status AS status,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'UPS' ELSE 'DHL' END AS shipping_method,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 6.50 ELSE 4.95 END AS fee,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'refund' ELSE 'label' END AS return_method,
    CASE WHEN o_orderpriority = '1-URGENT' THEN greatest(coalesce(cur.currency, 'EUR'), 'EUR')
         ELSE coalesce(cur.currency, 'EUR') END AS currency
  FROM ri JOIN ord ON ri.l_orderkey = ord.o_orderkey
  LEFT JOIN pst ON ord.o_orderstatus = pst.st
  LEFT JOIN cur ON ord.store = cur.cstore)
"""

RETURNS_ROLLUP = "WITH " + BASE + "," + PARTS + "," + RETURNS + """
SELECT o_orderkey AS return_id, CAST(o_orderkey AS VARCHAR) AS order_number,
  'c' || CAST(o_custkey AS VARCHAR) || '@example.com' AS order_email, o_orderdate AS order_date,
  o_orderdate + INTERVAL 14 DAY AS return_request_date,
  'shop-' || lower(c_mktsegment) || '.example.com' AS order_site,
  shipping_method, CAST(fee AS DOUBLE) AS payment_for_return_fee, status AS return_request_status,
  n::INTEGER AS return_requested_items_count, skus AS return_requested_items_sku,
  reasons AS return_reason, return_method,
  CAST(total AS DOUBLE) AS return_requested_total_amount,
  n_name AS country_code, c_mktsegment AS city, currency
FROM rs
"""

RETURNS_FANOUT = "WITH " + BASE + "," + PARTS + "," + RETURNS + """,
rl2 AS (
  SELECT rl.* FROM rl
  JOIN (SELECT 1 AS d UNION ALL SELECT 2) dd ON dd.d = 1 OR rl.o_orderpriority = '1-URGENT'),
rf AS (
  SELECT l_orderkey, count(*) AS n, string_agg(sku, ', ' ORDER BY item_id) AS skus,
    sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS total
  FROM rl2 GROUP BY l_orderkey)
SELECT rs.o_orderkey AS return_id, rf.n::INTEGER AS return_requested_items_count,
  rf.skus AS return_requested_items_sku, CAST(rf.total AS DOUBLE) AS return_requested_total_amount,
  CAST(rs.fee AS DOUBLE) AS payment_for_return_fee
FROM rs JOIN rf ON rs.o_orderkey = rf.l_orderkey
"""

RETURN_ATTRIBUTES = "WITH " + BASE + "," + PARTS + "," + RETURNS + """
SELECT o_orderkey AS return_id, attrs AS return_requested_items_attributes FROM rs
"""

RETURNS_BY_PRODUCT = "WITH " + BASE + "," + PARTS + """,
rp AS (
  SELECT 'P' || CAST(l.l_partkey AS VARCHAR) AS sku, l.l_orderkey, o.o_orderdate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_returnflag = 'R')
SELECT rp.sku, pa.p_name AS product_name, 'M-' || CAST(pa.b AS VARCHAR) AS parent_sku, pa.categories,
  count(DISTINCT rp.l_orderkey)::INTEGER AS total_returns,
  min(rp.o_orderdate) AS first_return_date, max(rp.o_orderdate) AS last_return_date
FROM rp LEFT JOIN pa ON rp.sku = 'P' || CAST(pa.p_partkey AS VARCHAR)
GROUP BY rp.sku, pa.p_name, pa.b, pa.categories
"""

ORACLE.update({
    "returns_rollup": RETURNS_ROLLUP,
    "returns_fanout": RETURNS_FANOUT,
    "return_attributes": RETURN_ATTRIBUTES,
    "returns_by_product": RETURNS_BY_PRODUCT,
})


def _ads_records(where: str, factor: str) -> str:
    return f"""(
  SELECT 'camp-' || event_type AS campaign_name, 'ad-' || CAST(user_id AS VARCHAR) AS ad_name,
    'set-' || CAST(user_id AS VARCHAR) AS adset_name, n * 10 AS impressions, k_sum AS clicks,
    spend,
    CASE WHEN k_sum > 0 THEN ((CAST(spend * 100 AS BIGINT) * 2 + k_sum) // (k_sum * 2)) / 100.0 END AS cpc,
    CASE WHEN event_type = 'purchase' THEN ((k_sum * 20000 + n) // (n * 2)) / 10000.0 ELSE 0 END AS purchase_roas,
    CAST(day AS VARCHAR) AS date_start, CAST(day AS VARCHAR) AS date_stop, position
  FROM (
    SELECT user_id, event_type, CAST(ts AS DATE) AS day, count(*) AS n,
      sum(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0)) AS k_sum,
      round(sum(CAST(value AS DECIMAL(12,2))) * {factor}, 2) AS spend, min(event_id) AS position
    FROM events WHERE {where}
    GROUP BY 1, 2, 3))"""


ADS_FLATTEN = "SELECT campaign_name, ad_name, adset_name, impressions::INTEGER AS impressions, " \
    "clicks::INTEGER AS clicks, CAST(spend AS DOUBLE) AS spend, CAST(cpc AS DOUBLE) AS cpc, " \
    "CAST(purchase_roas AS DOUBLE) AS purchase_roas, date_start, date_stop FROM " + \
    _ads_records("TRUE", "1.0")

ADS_A = "a AS (SELECT * FROM " + _ads_records("ts < TIMESTAMP '2024-01-21'", "1.0") + \
    " QUALIFY row_number() OVER (PARTITION BY ad_name, date_start ORDER BY position) = 1)"
ADS_B = "b AS (SELECT * FROM " + _ads_records("ts >= TIMESTAMP '2024-01-16'", "1.1") + \
    " QUALIFY row_number() OVER (PARTITION BY ad_name, date_start ORDER BY position) = 1)"

ADS_WINDOW = """WITH RECURSIVE
w AS (SELECT CAST(max(ts) AS DATE) + 1 AS since FROM events),
ch(s) AS (SELECT since FROM w UNION ALL SELECT CAST(s + INTERVAL 1 MONTH AS DATE) FROM ch
          WHERE CAST(s + INTERVAL 1 MONTH AS DATE) <= DATE '2024-03-15')
SELECT CAST(s AS VARCHAR) AS chunk_start,
  CAST(least(CAST(s + INTERVAL 1 MONTH AS DATE) - 1, DATE '2024-03-15') AS VARCHAR) AS chunk_end
FROM ch
"""

ADS_UPSERT = "WITH " + ADS_A + "," + ADS_B + """
SELECT coalesce(a.campaign_name, b.campaign_name) AS campaign_name,
  coalesce(a.ad_name, b.ad_name) AS ad_name,
  CASE WHEN a.ad_name IS NOT NULL THEN a.adset_name ELSE b.adset_name END AS adset_name,
  CASE WHEN b.ad_name IS NOT NULL THEN b.impressions ELSE a.impressions END::INTEGER AS impressions,
  CASE WHEN b.ad_name IS NOT NULL THEN b.clicks ELSE a.clicks END::INTEGER AS clicks,
  CAST(CASE WHEN b.ad_name IS NOT NULL THEN b.spend ELSE a.spend END AS DOUBLE) AS spend,
  CAST(CASE WHEN b.ad_name IS NOT NULL THEN b.cpc ELSE a.cpc END AS DOUBLE) AS cpc,
  CAST(CASE WHEN b.ad_name IS NOT NULL THEN b.purchase_roas ELSE a.purchase_roas END AS DOUBLE) AS purchase_roas,
  coalesce(a.date_start, b.date_start) AS date_start,
  CASE WHEN b.ad_name IS NOT NULL THEN b.date_stop ELSE a.date_stop END AS date_stop
FROM a FULL OUTER JOIN b ON a.ad_name = b.ad_name AND a.date_start = b.date_start
"""

EAV_PIVOT = "SELECT * FROM orders"

EAV_MULTI_KEY = "WITH " + PARTS + """
SELECT p_partkey AS product_id, CASE WHEN wc_txt > alg_txt THEN wc_txt ELSE alg_txt END AS cost_text FROM pa
"""

URL_HOST = "SELECT page_id, split_part(url, '/', 3) AS host FROM pages"

FULL_NAME = "WITH " + BASE + "," + CUSTOMERS + """
SELECT store AS source_store, customer_id, full_name, email, registered_at FROM cm
"""

DAMAGED = """
dmg AS (
  SELECT o_orderkey, o_orderstatus AS st, o_orderpriority AS pr, o_orderdate,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS total_txt,
    CAST(o_totalprice AS DECIMAL(12,2)) AS total
  FROM orders)
"""

LENIENT_DATES = "WITH " + DAMAGED + """
SELECT o_orderkey,
  CASE WHEN st = 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
       WHEN st = 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
       WHEN pr = '1-URGENT' THEN '0000-00-00 00:00:00' WHEN pr = '2-HIGH' THEN ''
       WHEN pr = '3-MEDIUM' THEN 'junk' WHEN pr = '4-NOT SPECIFIED' THEN ' 2024 '
       ELSE '1999-02-30 10:00:00' END AS date_text,
  CASE WHEN st IN ('F', 'O') THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS parsed
FROM dmg
"""

LENIENT_NUMBERS = "WITH " + DAMAGED + """
SELECT o_orderkey,
  CASE WHEN st = 'F' AND pr = '1-URGENT' THEN '99999999' || total_txt
       WHEN st = 'F' AND pr = '2-HIGH' THEN '-' || repeat('9', 40) || ' x'
       WHEN st = 'F' THEN total_txt WHEN st = 'O' THEN total_txt || 'abc'
       WHEN pr = '1-URGENT' THEN 'abc' WHEN pr = '2-HIGH' THEN '' WHEN pr = '3-MEDIUM' THEN '  -12.5'
       WHEN pr = '4-NOT SPECIFIED' THEN NULL ELSE '.5' END AS number_text,
  CAST(CASE WHEN st = 'F' AND pr = '1-URGENT' THEN 9999999999.99 WHEN st = 'F' AND pr = '2-HIGH' THEN -9999999999.99
            WHEN st IN ('F', 'O') THEN total
            WHEN pr IN ('1-URGENT', '2-HIGH') THEN 0
            WHEN pr = '3-MEDIUM' THEN -12.50
            WHEN pr = '4-NOT SPECIFIED' THEN NULL ELSE 0.50 END AS DOUBLE) AS parsed
FROM dmg
"""

UTF8_CLEAN = """
SELECT doc_id, CAST(length(text || ' end') AS INTEGER) AS clean_length, md5(text || ' end') AS clean_md5
FROM documents
"""

ORACLE.update({
    "ads_flatten": ADS_FLATTEN,
    "ads_window": ADS_WINDOW,
    "ads_upsert": ADS_UPSERT,
    "ads_stored_upsert": ADS_UPSERT,
    "eav_pivot": EAV_PIVOT,
    "eav_multi_key": EAV_MULTI_KEY,
    "url_host": URL_HOST,
    "full_name": FULL_NAME,
    "lenient_dates": LENIENT_DATES,
    "lenient_numbers": LENIENT_NUMBERS,
    "utf8_clean": UTF8_CLEAN,
})


STORE_UNION_ITEMS = "WITH " + BASE + "," + ITEM_LINES + """
SELECT il.item_id AS order_item_id, il.l_orderkey AS order_id, il.l_partkey AS product_id, CAST(il.variation_id AS DOUBLE) AS variation_id,
  replace(replace(mshape, '#', 'V' || l_suppkey), '@', 'P' || l_partkey) AS sku,
  'Part ' || CAST(il.l_partkey AS VARCHAR) AS order_item_name,
  CAST(il.l_quantity AS INTEGER) AS quantity,
  CAST(il.net AS DOUBLE) AS line_total,
  CAST(round(il.net * CAST(il.l_tax AS DECIMAL(4,2)), 2) AS DOUBLE) AS line_tax,
  CAST(CASE WHEN il.l_returnflag = 'R' THEN il.l_orderkey + 1000000000000 END AS DOUBLE) AS refund_reference,
  coalesce(cur.currency, 'EUR') AS currency_code,
  il.store AS source_store,
  il.o_orderdate AS created_at
FROM il
LEFT JOIN cur ON il.store = cur.cstore
WHERE il.store IN (""" + MASTER_ORDER_STORES_SQL + """)
"""

ORDER_COGS_MAP = "WITH " + BASE + "," + PARTS + """,
cmap AS (
  SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE', 'ECONOMY') THEN wc ELSE greatest(wc, alt) END AS cog
  FROM pa WHERE wc > 0),
mc AS (
  SELECT l_orderkey, sum(CAST(CAST(l_quantity AS INTEGER) AS DECIMAL(12,4)) * CAST(cog AS DECIMAL(12,4))) AS cogs
  FROM lineitem JOIN cmap ON l_partkey = p_partkey GROUP BY l_orderkey),
pr AS (
  SELECT omx.store, order_id, gross - discount + refunded AS rev,
    CASE WHEN post_type = 'shop_order' THEN CAST(coalesce(mc.cogs, 0) AS DECIMAL(12,2)) ELSE 0 END AS cogs
  FROM omx LEFT JOIN mc ON omx.order_id = mc.l_orderkey)
SELECT store AS source_store, order_id, CAST(cogs AS DOUBLE) AS cogs,
  CAST(round(rev - cogs, 2) AS DOUBLE) AS net_profit,
  CAST(CASE WHEN rev > 0 THEN greatest(least(round(CAST((rev - cogs) / rev AS DECIMAL(18,6)) * 100, 2), 9999.99), -9999.99)
            ELSE 0 END AS DOUBLE) AS net_margin
FROM pr
"""

ORACLE.update({
    "store_union_items": STORE_UNION_ITEMS,
    "order_cogs_map": ORDER_COGS_MAP,
})


ORACLE["ads_stream"] = ADS_FLATTEN


ORACLE["rates_upsert"] = "WITH " + BASE + "," + RATES + """,
paid AS (SELECT coalesce(currency, 'EUR') AS pcur, (count(*) % 1000 + 1) * 0.001 AS prate
  FROM ord LEFT JOIN cur ON store = cstore GROUP BY 1)
SELECT coalesce(pcur, rcur) AS currency_code, CAST(coalesce(prate, rate) AS DOUBLE) AS rate_to_eur,
  CASE WHEN pcur IS NULL THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-02-01' END AS last_updated
FROM rates FULL JOIN paid ON rcur = pcur
"""

ORACLE["customers_eur_v1"] = """
SELECT customer_id, full_name, email, source_store, billing_country, billing_city, original_ltv, rate_to_eur,
  ltv_eur, orders_count, original_aov AS aov, units_total, registered_at, last_order_date
FROM (""" + CUSTOMERS_EUR + ")"

ORACLE["advertisements"] = "WITH a AS (SELECT * FROM " + _ads_records("TRUE", "1.0") + """
  QUALIFY row_number() OVER (PARTITION BY ad_name, date_start ORDER BY position) = 1)
SELECT campaign_name, ad_name, adset_name, impressions::INTEGER AS impressions, clicks::INTEGER AS clicks,
  CAST(spend AS DOUBLE) AS spend, CAST(cpc AS DOUBLE) AS cpc, CAST(purchase_roas AS DOUBLE) AS purchase_roas,
  date_start, date_stop FROM a
"""

ORACLE["landed_store_orders"] = """
SELECT m.* REPLACE (CASE WHEN source_store = 'DE' THEN NULL ELSE order_status END AS order_status)
FROM (""" + ORDER_MART + """) m WHERE source_store IN (""" + MASTER_ORDER_STORES_SQL + ")"
