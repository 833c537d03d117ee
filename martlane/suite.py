"""Queries registered with the driver: each runs a mart plan over the shaped driver tables.

Every query reads whole tables; money leaves as DOUBLE (computed exactly in DECIMAL,
cast at the edge) so that both engines hash identical values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.suite_common import (_CACHE, _WH, ADS_SPLIT_A, ADS_SPLIT_B, ADS_TODAY, NULLABLE_INTS, _fresh_root, as_double,  # noqa: F401
                                   shapes, warehouse)
from martlane.suite_loads import QUERIES as LOADS


def _orders(spark, sf_dir, cogs_mode="zero"):
    from martlane.plans.orders import build_orders
    s = shapes(spark, sf_dir)
    return build_orders(s.order_posts, s.order_meta, s.order_items, s.item_meta,
                        s.store_product_lookup, store_product_meta=s.store_product_meta, cogs_mode=cogs_mode)


def q_order_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    return as_double(o, NULLABLE_INTS)


def q_order_profit(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir, cogs_mode="items")
    return as_double(o.select("source_store", "order_id", "gross_total", "cogs", "net_revenue",
                              "net_profit", "net_margin"))


def q_order_sku_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    return o.select("source_store", "order_id", "units_total", "ordered_items_skus")


QUERIES = {
    "order_mart": q_order_mart,
    "order_profit": q_order_profit,
    "order_sku_list": q_order_sku_list,
}


# -- items, cost map, filters, numbers ----------------------------------------

def q_order_items_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.plans.order_items import build_order_items, sku_map
    s = shapes(spark, sf_dir)
    return as_double(build_order_items(s.order_items, s.item_meta, s.plain("order_posts"), s.plain("order_meta"),
                                       sku_map(s.product_lookup)), NULLABLE_INTS)


def q_unit_cost_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.plans.orders import unit_cost_map
    s = shapes(spark, sf_dir)
    return as_double(unit_cost_map(s.product_meta, s.product_posts))


def q_marketplace_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.plans.orders import order_header
    s = shapes(spark, sf_dir)
    h = order_header(s.order_posts, s.order_meta)
    return h.filter(F.col("source_store") == "OPS").select(
        "source_store", "order_id", "post_type", "payment_method")


def q_refund_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.functions.text import order_number
    from martlane.plans.orders import order_header
    s = shapes(spark, sf_dir)
    h = order_header(s.order_posts, s.order_meta).filter(F.col("post_type") == "shop_order_refund")
    return h.select("source_store", "order_id",
                    order_number("source_store", "post_type", "order_id", "number_meta")
                    .alias("order_number_formatted"))


# -- customers, masters, EUR ----------------------------------------------------

def _customers(spark, sf_dir):
    from martlane.plans.customers import build_customers
    s = shapes(spark, sf_dir)
    return build_customers(s.users, s.user_meta, s.order_posts, s.order_meta, s.plain("order_items"))


def q_customer_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(_customers(spark, sf_dir))


def q_refund_by_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.plans.customers import customer_activity
    s = shapes(spark, sf_dir)
    activity = customer_activity(s.order_posts, s.order_meta, s.plain("order_items"))
    return as_double(activity.filter("refunds_total is not null").select("source_store", "customer_id", "refunds_total"))


def q_store_union_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = warehouse(spark, sf_dir).table("master_orders")
    return as_double(m, NULLABLE_INTS)


def q_store_union_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = warehouse(spark, sf_dir).table("master_customers")
    return as_double(m.drop("created_at"))


def q_rates_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seed rates after an upsert of a rate for each currency that orders are paid in."""
    import datetime as dt
    from martlane.plans.masters import seed_rates, upsert_rates
    meta = shapes(spark, sf_dir).order_meta.filter(F.col("meta_key") == "_order_currency")
    rate = (F.count("*") % 1000 + 1) * F.lit("0.001").cast("decimal(12,6)")
    batch = meta.groupBy(F.col("meta_value").alias("currency_code")).agg(rate.cast("decimal(12,6)").alias("rate_to_eur"))
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    return as_double(upsert_rates(upsert_rates(None, seed_rates(spark), now=old), batch, now=new))


def q_customers_eur_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.plans.masters import customers_eur_v1
    wh = warehouse(spark, sf_dir)
    return as_double(customers_eur_v1(wh.table("master_customers"), wh.table("rates")))


def q_advertisements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ads mart after one refresh over all landed records."""
    m = warehouse(spark, sf_dir).table("advertisements").drop("created_at")
    return as_double(m.withColumns({c: F.col(c).cast("string") for c in ("date_start", "date_stop")}))


def q_landed_store_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from tables landed per store: the master stores that are there, one of them
    (DE) without the status column."""
    from martlane.plans.orders import build_orders
    from martlane.session import shuffles_freed
    from martlane.sources.bucketed import BucketedSources
    from martlane.sources.landed import LANDED_CODEC, STORE_TABLES, LandedStores
    s, root = shapes(spark, sf_dir), _fresh_root(spark, "landed")
    with s.passing(), shuffles_freed(spark):
        for name in STORE_TABLES:
            table = s.plain(name)
            if name == "order_posts":
                (table.filter("source_store = 'DE'").drop("post_status")
                      .write.partitionBy("source_store").parquet(f"{root}/{name}", compression=LANDED_CODEC))
                table = table.filter("source_store <> 'DE'")
            table.write.mode("append").partitionBy("source_store").parquet(f"{root}/{name}", compression=LANDED_CODEC)
    src = BucketedSources(LandedStores(spark, root, one_scan=True), f"{root}/_buckets", s.buckets)
    return as_double(build_orders(src.order_posts, src.order_meta, src.order_items, src.item_meta,
                                  src.store_product_lookup), NULLABLE_INTS)


def q_customers_eur(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(warehouse(spark, sf_dir).table("customers_eur"))


def q_orders_eur(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane import schemas as S
    e = warehouse(spark, sf_dir).table("eur_orders")
    return as_double(e.select("source_store", "order_number_formatted", "order_id",
                              "currency_code", *S.ORDER_MONEY_COLUMNS, "net_margin"))


QUERIES.update({
    "order_items_sku": q_order_items_sku,
    "unit_cost_map": q_unit_cost_map,
    "marketplace_filter": q_marketplace_filter,
    "refund_numbers": q_refund_numbers,
    "customer_mart": q_customer_mart,
    "refund_by_parent": q_refund_by_parent,
    "store_union_orders": q_store_union_orders,
    "store_union_customers": q_store_union_customers,
    "customers_eur": q_customers_eur,
    "orders_eur": q_orders_eur,
    "rates_upsert": q_rates_upsert,
    "customers_eur_v1": q_customers_eur_v1,
    "landed_store_orders": q_landed_store_orders,
})


# -- products -----------------------------------------------------------------

def q_product_pivot_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.plans.products import build_products
    s = shapes(spark, sf_dir)
    p = build_products(s.product_posts, s.product_meta, s.product_lookup, s.terms)
    return p.select("product_id", "attributes")


def q_category_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.plans.products import rollup_categories
    s = shapes(spark, sf_dir)
    return rollup_categories(s.term_relationships, s.term_taxonomy, s.terms)


def q_gallery_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.plans.products import gallery_pairs
    s = shapes(spark, sf_dir)
    return gallery_pairs(s.product_posts, s.product_meta)


def q_image_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.plans.products import gallery_pairs, image_urls, rollup_images
    s = shapes(spark, sf_dir)
    r = rollup_images(gallery_pairs(s.product_posts, s.product_meta), image_urls(s.attachments))
    return r.withColumnRenamed("urls", "image_url")


def q_product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(warehouse(spark, sf_dir).table("products").drop("created_at"), NULLABLE_INTS)


QUERIES.update({
    "product_pivot_attributes": q_product_pivot_attributes,
    "category_rollup": q_category_rollup,
    "gallery_pairs": q_gallery_pairs,
    "image_rollup": q_image_rollup,
    "product_master": q_product_master,
})


# -- returns ----------------------------------------------------------------

def _returns(spark, sf_dir, fanout=False):
    from martlane.plans.returns import build_returns
    s = shapes(spark, sf_dir)
    return build_returns(s.shipments, s.shipment_items, s.shipment_details, s.shipment_addresses,
                         s.terms, fanout=fanout)


def q_returns_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(_returns(spark, sf_dir).drop("return_requested_items_attributes"))


def q_returns_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _returns(spark, sf_dir, fanout=True)
    return as_double(r.select("return_id", "return_requested_items_count",
                              "return_requested_items_sku", "return_requested_total_amount",
                              "payment_for_return_fee"))


def q_return_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _returns(spark, sf_dir).select("return_id", "return_requested_items_attributes")


def q_returns_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).table("return_by_product")


QUERIES.update({
    "returns_rollup": q_returns_rollup,
    "returns_fanout": q_returns_fanout,
    "return_attributes": q_return_attributes,
    "returns_by_product": q_returns_by_product,
})


# -- ads --------------------------------------------------------------------

def q_ads_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.plans.ads import flatten_ads
    s = shapes(spark, sf_dir)
    return as_double(flatten_ads(s.ads_records()).drop("position")
                     .withColumns({"date_start": F.col("date_start").cast("string"),
                                   "date_stop": F.col("date_stop").cast("string")}))


def _ads_a(spark, sf_dir):
    from martlane.plans.ads import flatten_ads, upsert_ads
    s = shapes(spark, sf_dir)
    return upsert_ads(None, flatten_ads(s.ads_records(end=ADS_SPLIT_A)))


def q_ads_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    import datetime as dt
    from martlane.plans.ads import ads_window_chunks, flatten_ads, upsert_ads
    ads = upsert_ads(None, flatten_ads(shapes(spark, sf_dir).ads_records()))
    w = ads_window_chunks(ads, dt.date.fromisoformat(ADS_TODAY))
    return w.select(F.col("chunk_start").cast("string").alias("chunk_start"),
                    F.col("chunk_end").cast("string").alias("chunk_end"))


def q_ads_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.plans.ads import flatten_ads, upsert_ads
    s = shapes(spark, sf_dir)
    batch_b = flatten_ads(s.ads_records(start=ADS_SPLIT_B, spend_factor="1.1"))
    out = upsert_ads(_ads_a(spark, sf_dir), batch_b)
    return as_double(out.withColumns({"date_start": F.col("date_start").cast("string"),
                                      "date_stop": F.col("date_stop").cast("string")}))


def q_ads_stored_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two batches of ``ads_upsert`` through the stored, day-partitioned table."""
    import uuid
    from martlane.plans.ads import apply_ads_batch, flatten_ads, stored_ads
    from martlane.session import checkpoint_dir
    s = shapes(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/ads_stored_query/{uuid.uuid4().hex[:12]}"
    apply_ads_batch(spark, path, flatten_ads(s.ads_records(end=ADS_SPLIT_A)))
    apply_ads_batch(spark, path, flatten_ads(s.ads_records(start=ADS_SPLIT_B, spend_factor="1.1")))
    return as_double(stored_ads(spark, path).withColumns({c: F.col(c).cast("string") for c in ("date_start", "date_stop")}))


# -- column functions over whole tables ------------------------------------

def q_eav_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> (id, key, value) -> orders again."""
    from martlane.operators.eav import eav_pivot, eav_unpivot
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    cols = [c for c in o.columns if c != "o_orderkey"]
    long = eav_unpivot(o, "o_orderkey", cols)
    wide = eav_pivot(long, "o_orderkey", {c: c for c in cols})
    return wide.select("o_orderkey", *[F.col(c).cast(o.schema[c].dataType).alias(c) for c in cols])


def q_eav_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cost keys feed one output column; the textual maximum wins."""
    from martlane import schemas as S
    from martlane.operators.eav import eav_pivot
    s = shapes(spark, sf_dir)
    return eav_pivot(s.product_meta, "post_id", {"cost_text": S.COST_KEYS}) \
        .withColumnRenamed("post_id", "product_id")


def q_url_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.functions.text import url_host
    p = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return p.select("page_id", url_host("url").alias("host"))


def q_full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.plans.customers import customer_base
    s = shapes(spark, sf_dir)
    return customer_base(s.users, s.user_meta).select("source_store", "customer_id", "full_name",
                                                      "email", "registered_at")


def _damaged_orders(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    total = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    date_txt = (F.when(st == "F", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
                .when(st == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
                .when(pr == "1-URGENT", F.lit("0000-00-00 00:00:00"))
                .when(pr == "2-HIGH", F.lit(""))
                .when(pr == "3-MEDIUM", F.lit("junk"))
                .when(pr == "4-NOT SPECIFIED", F.lit(" 2024 "))
                .otherwise(F.lit("1999-02-30 10:00:00")))
    num_txt = (F.when((st == "F") & (pr == "1-URGENT"), F.concat(F.lit("99999999"), total))
               .when((st == "F") & (pr == "2-HIGH"), F.concat(F.lit("-"), F.repeat(F.lit("9"), F.lit(40)), F.lit(" x")))
               .when(st == "F", total)
               .when(st == "O", F.concat(total, F.lit("abc")))
               .when(pr == "1-URGENT", F.lit("abc"))
               .when(pr == "2-HIGH", F.lit(""))
               .when(pr == "3-MEDIUM", F.lit("  -12.5"))
               .when(pr == "4-NOT SPECIFIED", F.lit(None).cast("string"))
               .otherwise(F.lit(".5")))
    return o.select("o_orderkey", date_txt.alias("date_text"), num_txt.alias("number_text"))


def q_lenient_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.functions.dates import lenient_datetime
    d = _damaged_orders(spark, sf_dir)
    return d.select("o_orderkey", "date_text", lenient_datetime("date_text").alias("parsed"))


def q_lenient_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martlane.functions.numbers import lenient_decimal
    d = _damaged_orders(spark, sf_dir)
    return as_double(d.select("o_orderkey", "number_text",
                              lenient_decimal("number_text", 12, 2).alias("parsed")))


def q_utf8_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts with an invalid byte injected, cleaned back."""
    from martlane.functions.text import drop_invalid_utf8
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    raw = F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("C3")), F.encode(F.lit(" end"), "UTF-8"))
    clean = drop_invalid_utf8(raw)
    return d.select("doc_id", F.length(clean).alias("clean_length"), F.md5(F.encode(clean, "UTF-8")).alias("clean_md5"))


QUERIES.update({
    "ads_flatten": q_ads_flatten,
    "ads_window": q_ads_window,
    "ads_upsert": q_ads_upsert,
    "ads_stored_upsert": q_ads_stored_upsert,
    "advertisements": q_advertisements,
    "eav_pivot": q_eav_pivot,
    "eav_multi_key": q_eav_multi_key,
    "url_host": q_url_host,
    "full_name": q_full_name,
    "lenient_dates": q_lenient_dates,
    "lenient_numbers": q_lenient_numbers,
    "utf8_clean": q_utf8_clean,
})


def q_store_union_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = warehouse(spark, sf_dir).table("master_order_items")
    return as_double(m, NULLABLE_INTS)


def q_order_cogs_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COGS from the PIM cost map (qty x cog_value), then the profit metrics."""
    from martlane.plans.orders import build_orders, unit_cost_map
    s = shapes(spark, sf_dir)
    o = build_orders(s.order_posts, s.order_meta, s.order_items, s.item_meta, s.store_product_lookup,
                     cogs_mode="cost_map", cost_map=unit_cost_map(s.product_meta, s.product_posts))
    return as_double(o.select("source_store", "order_id", "cogs", "net_profit", "net_margin"))


QUERIES.update({
    "store_union_items": q_store_union_items,
    "order_cogs_map": q_order_cogs_map,
})


def q_ads_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ads records landed as API pages, ingested by the availableNow stream + upsert."""
    import uuid
    from martlane.plans.ads import ADS_KEYS_WITH_CAMPAIGN
    from martlane.session import checkpoint_dir
    from martlane.streaming.ads_stream import land_api_pages, read_ads_table, run_ads_stream
    s = shapes(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/ads_stream_query/{uuid.uuid4().hex[:12]}"
    land_api_pages(s.ads_records(), f"{root}/landing")
    run_ads_stream(spark, f"{root}/landing", f"{root}/table", keys=ADS_KEYS_WITH_CAMPAIGN,
                   checkpoint=f"{root}/checkpoint", multi_line=False)
    t = read_ads_table(spark, f"{root}/table")
    return as_double(t.select("campaign_name", "ad_name", "adset_name", "impressions", "clicks",
                              "spend", "cpc", "purchase_roas",
                              F.col("date_start").cast("string").alias("date_start"),
                              F.col("date_stop").cast("string").alias("date_stop")))


QUERIES["ads_stream"] = q_ads_stream

QUERIES.update(LOADS)
