"""Store customers mart: user profile pivot + order, unit and refund aggregates.

Plan shape: the order meta is pivoted once; orders and refunds are folded per order
(a refund keyed by its parent), joined with per-order line counts, and fed to ONE
aggregate per (store, customer).  The guest id (0) can hold a large
share of orders: every aggregate here is algebraic (min/max/count/sum), so the partial
aggregate folds it map-side before the exchange; no user row carries id 0, so it drops
out at the final left join from users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane import schemas as S
from martlane.functions.dates import lenient_datetime
from martlane.functions.numbers import lenient_decimal, safe_ratio
from martlane.functions.text import full_name
from martlane.operators.eav import eav_pivot

STORE = "source_store"

USER_META = {
    "fn": "first_name", "ln": "last_name",
    "bfn": "billing_first_name", "bln": "billing_last_name",
    "sfn": "shipping_first_name", "sln": "shipping_last_name",
    "phone": "billing_phone", "billing_country": "billing_country", "billing_city": "billing_city",
}


def customer_base(users: DataFrame, user_meta: DataFrame) -> DataFrame:
    piv = eav_pivot(user_meta, ["user_id", STORE], USER_META).withColumnRenamed("user_id", "ID")
    u = users.join(piv, [STORE, "ID"], "left")
    return u.select(
        STORE, F.col("ID").alias("customer_id"),
        full_name("fn", "ln", "bfn", "bln", "sfn", "sln").alias("full_name"),
        F.lower(F.col("user_email")).alias("email"), "phone",
        lenient_datetime("user_registered").alias("registered_at"),
        "billing_country", "billing_city")


def order_customer_meta(post_meta: DataFrame) -> DataFrame:
    return eav_pivot(post_meta, ["post_id", STORE], {
        "customer_user": "_customer_user", "total_text": "_order_total",
        "refund_text": "_refund_amount"})


def customer_activity(posts: DataFrame, post_meta: DataFrame, items: DataFrame) -> DataFrame:
    """Order metrics, line counts and refunds per (store, customer) in one pass.

    One pivot of the order meta; each order and each refund is keyed by the order it
    belongs to (a refund by its parent), so one aggregate gathers an order's customer,
    date, total and refunds without a self join; one more aggregate per customer.
    """
    meta = order_customer_meta(post_meta)
    p = (posts.filter(F.col("post_type").isin(S.ORDER_TYPE, S.REFUND_TYPE))
              .select(STORE, F.col("ID").alias("post_id"), "post_type", "post_date", "post_parent"))
    pm = p.join(meta, ["post_id", STORE], "left")
    is_order = F.col("post_type") == S.ORDER_TYPE
    is_refund = F.col("post_type") == S.REFUND_TYPE
    order_key = F.when(is_refund, F.col("post_parent")).otherwise(F.col("post_id"))
    per_order = pm.groupBy(order_key.alias("order_id"), STORE).agg(
        F.max(F.when(is_order, F.col("customer_user"))).alias("customer_user"),
        F.max(F.when(is_order, F.col("post_date"))).alias("post_date"),
        F.count_if(is_order).alias("n_order_rows"),
        F.sum(F.when(is_order, F.coalesce(lenient_decimal("total_text", 12, 2),
                                          F.lit(0).cast(S.MONEY)))).alias("total"),
        F.sum(F.when(is_refund, lenient_decimal(F.coalesce(F.col("refund_text"), F.lit("0")),
                                                12, 2))).alias("refunds"))
    lines = (items.groupBy("order_id", STORE)
                  .agg(F.count_if(F.col("order_item_type") == "line_item").alias("n_lines")))
    o = per_order.join(lines, ["order_id", STORE], "left")
    has_cust = F.col("customer_user").isNotNull() & (F.col("customer_user") != "")
    counted = has_cust & (F.col("n_order_rows") > 0)
    return o.filter(F.col("customer_user").isNotNull()).groupBy(
        F.col("customer_user").try_cast("bigint").alias("customer_id"), STORE).agg(
        F.min(F.when(counted, F.col("post_date"))).alias("first_order_date"),
        F.max(F.when(counted, F.col("post_date"))).alias("last_order_date"),
        F.sum(F.when(counted, F.col("n_order_rows"))).alias("orders_count"),
        F.sum(F.when(counted, F.col("total"))).alias("ltv"),
        F.sum(F.coalesce(F.col("n_lines"), F.lit(0))).alias("units_total"),
        F.sum("refunds").alias("refunds_total"))


def build_customers(users: DataFrame, user_meta: DataFrame, posts: DataFrame,
                    post_meta: DataFrame, items: DataFrame) -> DataFrame:
    base = customer_base(users, user_meta)
    act = customer_activity(posts, post_meta, items)
    j = base.join(act, ["customer_id", STORE], "left")
    n = F.coalesce(F.col("orders_count"), F.lit(0))
    ltv = F.coalesce(F.col("ltv"), F.lit(0)).cast(S.MONEY)
    return j.select(
        "customer_id", "full_name", "email", "phone", "registered_at",
        "first_order_date", "last_order_date",
        n.cast("int").alias("orders_count"),
        F.coalesce(F.col("units_total"), F.lit(0)).cast("int").alias("units_total"),
        ltv.alias("ltv"),
        safe_ratio(F.col("ltv"), n).alias("aov"),
        F.coalesce(F.col("refunds_total"), F.lit(0)).cast(S.MONEY).alias("refunds_total"),
        STORE, "billing_country", "billing_city")
