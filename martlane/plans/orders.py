"""Store orders mart (orders with item roll-ups, COGS and profit metrics).

Plan shape: the order meta is pivoted once by (store, order id); the item meta is
pivoted once by (store, item id), enriched with the product lookup, and rolled up
once by (store, order id).  Both sides are hash-partitioned on the same key, so the
final left join needs no further exchange.  The ten correlated subqueries per order of
the source become one aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane import schemas as S
from martlane.functions.numbers import (clamped, lenient_decimal, lenient_int, net_margin, net_profit,
                                        net_revenue, positive_number_text)
from martlane.functions.text import order_number, sku_label, url_host
from martlane.operators.eav import eav_pivot
from martlane.operators.joins import lookup_key
from martlane.operators.lists import sorted_distinct_join

STORE = "source_store"

ORDER_META = {
    "customer_user": "_customer_user",
    "number_meta": "_order_number_formatted",
    "track_url": "_wcst_order_track_http_url",
    "billing_country": "_billing_country",
    "billing_city": "_billing_city",
    "payment_method": "_payment_method_title",
    "currency_code": "_order_currency",
    "total_text": "_order_total",
    "tax_text": "_order_tax",
    "discount_text": "_cart_discount",
    "refund_text": "_refund_amount",
}

# Item meta the order roll-up reads.  Only these keys pass the pre-shuffle filter: every
# extra key would be sorted and shuffled by the pivot even when no output uses it.
ITEM_META = {
    "product_text": "_product_id",
    "variation_text": "_variation_id",
    "qty_text": "_qty",
    "subtotal_text": "_line_subtotal",
    "fee_text": "_fee_amount",
    "cost_text": "cost",
}
# Every item key the marts read: the shared item facts written once for orders and items.
ITEM_META_ALL = {**ITEM_META, "line_total_text": "_line_total", "line_tax_text": "_line_tax",
                 "refund_ref_text": "_refunded_item_id"}


def order_header(posts: DataFrame, post_meta: DataFrame,
                 marketplace_store: str = S.MARKETPLACE_STORE) -> DataFrame:
    """Orders and refunds with their pivoted meta; the marketplace store keeps only
    orders paid by a marketplace method (an EXISTS over the meta, folded into the pivot)."""
    paid_flag = F.max(F.when((F.col("meta_key") == "_payment_method")
                             & F.col("meta_value").isin(S.MARKETPLACE_PAYMENTS), F.lit(True)))
    meta = eav_pivot(post_meta, ["post_id", STORE], ORDER_META, extra_keys=["_payment_method"],
                     extra_aggs=[paid_flag.alias("marketplace_paid")])
    p = (posts.filter(F.col("post_type").isin(S.ORDER_TYPE, S.REFUND_TYPE))
              .select(STORE, F.col("ID").alias("order_id"), "post_type",
                      F.col("post_date").alias("order_date"), F.col("post_status").alias("order_status")))
    m = meta.withColumnRenamed("post_id", "order_id")
    hdr = p.join(m, ["order_id", STORE], "left")
    return hdr.filter((F.col(STORE) != F.lit(marketplace_store)) | F.col("marketplace_paid").isNotNull())


def item_facts(items: DataFrame, item_meta: DataFrame, store_lookup: DataFrame,
               keys=ITEM_META) -> DataFrame:
    """One row per order item: pivoted meta + parent/variation SKUs from the store's lookup.

    Product ids are local to a store, so the lookup is joined on store and id.  Only the
    references go there, and only those that name something: most items have no variation, fee
    and shipping rows no product.  Their SKUs come back by the item's key, under which the meta
    has one row, so each item meets what the lookup has for it, be that no row or several.
    """
    piv = eav_pivot(item_meta, ["order_item_id", STORE], keys)

    def skus(text: str, key: str, sku: str, least: int | None = None) -> DataFrame:
        ref = eav_pivot(item_meta, ["order_item_id", STORE], {text: keys[text]}).select(
            "order_item_id", STORE, F.col(text).try_cast("bigint").alias(key))
        there = F.col(key).isNotNull() if least is None else F.col(key) >= least
        lookup = store_lookup.select(F.col("product_id").alias(key), STORE, F.col("sku").alias(sku))
        return ref.filter(there).join(lookup, [key, STORE]).drop(key)

    it = items.select(STORE, "order_item_id", "order_id", "order_item_name", "order_item_type")
    f = it.join(piv, ["order_item_id", STORE], "left")
    f = (f.withColumn("product_id", F.col("product_text").try_cast("bigint"))
          .withColumn("variation_id", F.col("variation_text").try_cast("bigint")))
    named = (f.join(skus("product_text", "_p", "parent_sku"), ["order_item_id", STORE], "left")
              .join(skus("variation_text", "_v", "variation_sku", least=1), ["order_item_id", STORE], "left"))
    return named.select(STORE, *[c for c in f.columns if c != STORE], "parent_sku", "variation_sku")


def product_cost_total(store_product_meta: DataFrame) -> DataFrame:
    """Per store and product: sum of the cost-key values (both keys counted, as the join does)."""
    return (store_product_meta.filter(F.col("meta_key").isin(S.COST_KEYS))
                        .groupBy(STORE, F.col("post_id").alias("_p"))
                        .agg(F.sum(lenient_decimal("meta_value", 12, 2)).alias("unit_cost_sum")))


def unit_cost_map(product_meta: DataFrame, product_posts: DataFrame | None = None) -> DataFrame:
    """PIM cost map: per product MAX(decimal(12,4)) of numeric-text cost values > 0."""
    m = product_meta.filter(F.col("meta_key").isin(S.COST_KEYS)
                            & positive_number_text(F.col("meta_value")))
    if product_posts is not None:
        m = m.join(product_posts.select(F.col("ID").alias("post_id")), "post_id", "left_semi")
    return m.groupBy(F.col("post_id").alias("product_id")).agg(
        F.max(F.col("meta_value").try_cast(S.MONEY4)).alias("cog_value"))


def item_rollup(facts: DataFrame, product_costs: DataFrame | None = None,
                cost_map: DataFrame | None = None, fold=None) -> DataFrame:
    """All per-order item aggregates in a single groupBy(store, order).

    ``fold`` (a column function such as ``functions.collation.folded``) gives what DISTINCT
    compares: spellings that fold alike are one product and one label, shown in its least one.
    """
    is_line = F.col("order_item_type") == "line_item"
    is_fee = F.col("order_item_type") == "fee"
    is_ship = F.col("order_item_type") == "shipping"
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    sku = F.coalesce(blank("variation_sku"), blank("parent_sku"))
    # What the fold reads of an item of each kind, and nothing else, is dealt to the orders: a line
    # its SKUs (its product where it has none) and numbers, a charge its amount and place.
    read = [is_line.alias("is_line"), F.when(is_line & sku.isNull(), F.col("product_text")).alias("product_text"),
            *[F.when(is_line, F.col(c)).alias(c) for c in ("parent_sku", "variation_sku", "qty_text", "subtotal_text")],
            F.when(is_fee, F.col("fee_text")).alias("fee_text"), F.when(is_ship, F.col("cost_text")).alias("cost_text"),
            F.when(is_fee | is_ship, F.col("order_item_id")).alias("order_item_id")]
    costs = product_costs is not None or cost_map is not None
    f = facts.select("order_id", STORE, *read, *[lookup_key("product_id", "order_item_id").alias("_p")] * costs)
    if product_costs is not None:
        f = f.join(product_costs, [STORE, "_p"], "left")
    if cost_map is not None:
        # left join + sum over matched lines = the inner-join form of the cost-map COGS
        f = f.join(cost_map.withColumnRenamed("product_id", "_p"), "_p", "left")
    unit_cost = F.lit(None).cast(S.MONEY) if product_costs is None else F.col("unit_cost_sum")
    cog_value = F.lit(None).cast(S.MONEY4) if cost_map is None else F.col("cog_value")
    unit_key = F.coalesce(sku, F.col("product_text"))
    label = F.when(F.col("is_line"), sku_label("parent_sku", "variation_sku"))
    ship_cost = lenient_decimal("cost_text", 12, 2)
    fee_amt = lenient_decimal("fee_text", 12, 2)
    # One aggregation pass: distinct counts/lists as sets (no Expand of count(DISTINCT)),
    # "first row" values as numeric min_by (fixed-width buffers).  The items of an order lie
    # apart here, so aggregates before the exchange would be as many as the items, and wider.
    # In order behind it they are folded by one streaming aggregate instead of two hashed ones.
    dealt = f.drop("_p").repartition("order_id", STORE).sortWithinPartitions("order_id", STORE)
    g = dealt.groupBy("order_id", STORE).agg(
        F.size(F.collect_set(fold(unit_key) if fold else unit_key)).alias("units_total"),
        F.sum(lenient_decimal("qty_text", 12, 2)).alias("qty_sum"),
        sorted_distinct_join(label, ", ", empty="", fold=fold).alias("ordered_items_skus"),
        F.sum(lenient_decimal("subtotal_text", 12, 2)).alias("line_subtotal_sum"),
        F.sum(lenient_decimal("subtotal_text", 12, 4)).alias("subtotal4"),
        F.sum(fee_amt).alias("fee_sum"),
        F.sum(ship_cost).alias("ship_sum"),
        F.min_by(ship_cost, F.when(F.col("cost_text").isNotNull(), F.col("order_item_id"))).alias("shipping_first"),
        F.min_by(fee_amt, F.when(F.col("fee_text").isNotNull(), F.col("order_item_id"))).alias("fee_first"),
        F.sum(lenient_decimal("qty_text", 12, 2) * unit_cost).alias("item_cogs"),
        F.sum(lenient_int("qty_text") * cog_value).alias("map_cogs"),
    )
    return g.withColumn("ordered_items_count",
                        F.round(F.coalesce(F.col("qty_sum"), F.lit(0)), 0).cast("int")).drop("qty_sum")


def build_orders(posts: DataFrame, post_meta: DataFrame, items: DataFrame, item_meta: DataFrame,
                 store_lookup: DataFrame, store_product_meta: DataFrame | None = None,
                 cogs_mode: str = "zero", cost_map: DataFrame | None = None,
                 with_profit: bool = True, facts: DataFrame | None = None, fold=None) -> DataFrame:
    """Store orders (all stores at once, keyed by ``source_store``).

    ``store_lookup`` and ``store_product_meta`` hold each store's own products, keyed by
    ``source_store`` and id; the cost map comes from the product master and is global.
    ``cogs_mode``: "zero" (the source's current override), "items" (qty x product cost
    meta, both cost keys counted) or "cost_map" (INT qty x PIM cost map, the commented form).
    ``facts``: item facts already pivoted (and written) once for several marts.
    ``fold``: what DISTINCT compares of SKUs and labels (``item_rollup``).
    """
    hdr = order_header(posts, post_meta)
    if facts is None:
        facts = item_facts(items, item_meta, store_lookup)
    costs = (product_cost_total(store_product_meta)
             if store_product_meta is not None and cogs_mode == "items" else None)
    if cogs_mode == "cost_map" and cost_map is None:
        raise ValueError("cogs_mode='cost_map' needs cost_map")
    roll = item_rollup(facts, costs, cost_map if cogs_mode == "cost_map" else None, fold)
    o = hdr.join(roll, ["order_id", STORE], "left")
    tax = lenient_decimal("tax_text", 12, 2)
    gross = (F.col("line_subtotal_sum") + F.coalesce(tax, F.lit(0)) + F.coalesce(F.col("fee_sum"), F.lit(0))
             + F.coalesce(F.col("ship_sum"), F.lit(0)))
    if cogs_mode == "zero":
        cogs = F.lit(0)
    elif cogs_mode == "items":
        cogs = F.coalesce(F.col("item_cogs"), F.lit(0))
    else:
        cogs = F.coalesce(F.col("map_cogs"), F.lit(0))
    out = o.select(
        order_number(F.col(STORE), F.col("post_type"), F.col("order_id"), F.col("number_meta"))
         .alias("order_number_formatted"),
        F.col(STORE), "order_id", "order_date", "order_status",
        F.col("customer_user").try_cast("bigint").alias("customer_id"),
        F.col(STORE).alias("country_code"),
        F.concat(F.lit(S.CHANNEL_PREFIX), F.col(STORE)).alias("channel"),
        url_host("track_url").alias("site"),
        "billing_country", "billing_city",
        F.coalesce(F.col("units_total"), F.lit(0)).cast("int").alias("units_total"),
        F.coalesce(F.col("ordered_items_count"), F.lit(0)).cast("int").alias("ordered_items_count"),
        F.coalesce(F.col("ordered_items_skus"), F.lit("")).alias("ordered_items_skus"),
        "payment_method", "currency_code",
        clamped(F.coalesce(F.col("subtotal4"), F.lit(0)), S.MONEY).alias("subtotal"),
        clamped(F.coalesce(gross, F.lit(0)), S.MONEY).alias("gross_total"),
        clamped(cogs, S.MONEY).alias("cogs"),
        F.coalesce(lenient_decimal("total_text"), F.lit(0)).cast(S.MONEY).alias("total_price"),
        tax.alias("tax_amount"),
        F.col("shipping_first").alias("shipping_fee"),
        F.col("fee_first").alias("fee_amount"),
        F.coalesce(lenient_decimal("discount_text"), F.lit(0)).cast(S.MONEY).alias("discount_amount"),
        F.coalesce(lenient_decimal("refund_text"), F.lit(0)).cast(S.MONEY).alias("refunded_amount"),
        *[F.lit(0).cast(S.MONEY).alias(c) for c in ("ads_spend", "logistics_cost", "other_costs")],
        F.lit(0).cast(S.MONEY).alias("net_profit"), F.lit(0).cast(S.MONEY).alias("net_revenue"),
        F.lit(0).cast(S.MARGIN).alias("net_margin"),
    )
    return add_profit_metrics(out) if with_profit else out


def add_profit_metrics(orders: DataFrame) -> DataFrame:
    """Null-to-zero on the eight inputs, then net revenue, net profit and clamped margin."""
    zero_fill = ["total_price", "gross_total", "discount_amount", "refunded_amount", "cogs",
                 "logistics_cost", "ads_spend", "other_costs"]
    o = orders.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast(S.MONEY) for c in zero_fill})
    args = ("gross_total", "discount_amount", "refunded_amount", "cogs", "logistics_cost",
            "ads_spend", "other_costs")
    return o.withColumns({
        "net_revenue": net_revenue(*args[:3]),
        "net_profit": net_profit(*args),
        "net_margin": net_margin(*args),
    })

