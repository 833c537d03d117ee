"""Shape the driver's TPC-H-like tables into the store schema the marts read.

The marts take the raw shop tables (posts, post meta, order items, item meta, users,
user meta, product lookup, terms, return-portal tables, ads records).  Test data comes as
TPC-H-like parquet, so this module derives those tables from it with plain DataFrame
expressions: one scan per input table, unpivots for the EAV tables, no driver loops.
Every rule below is restated in the DuckDB oracle of the same query.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlane.operators.eav import eav_unpivot

# ---------------------------------------------------------------------------
# Fixed values of the shaping rules (also restated in the oracle SQL).
# ---------------------------------------------------------------------------
# Store of a customer's nation, by nation key 0..24.  "SK" is deliberately absent
# (a listed store without data); PL, US and GB are stores outside the merge lists.
NATION_STORE = ["OPS", "TR", "DE", "FR", "NL", "BE", "BEFRLU", "AT", "DK", "ES", "IT", "SE",
                "FI", "PT", "CZ", "HU", "RO", "UK", "TR", "DE", "FR", "NL", "PL", "US", "GB"]
# Currency of the orders of a store; any other store sells in EUR.
STORE_ORDER_CURRENCY = {"TR": "TRY", "DK": "DKK", "SE": "SEK", "CZ": "CZK", "HU": "HUF",
                        "RO": "RON", "UK": "GBP", "PL": "PLN", "US": "USD", "GB": "GBP"}
# Payment method by order priority.
PAYMENT_OF_PRIORITY = {"1-URGENT": "bol", "2-HIGH": "other", "3-MEDIUM": "card",
                       "4-NOT SPECIFIED": "paypal", "5-LOW": "bank"}
POST_STATUS = {"F": "wc-completed", "O": "wc-processing", "P": "wc-on-hold"}
REFUND_ID_BASE = 1_000_000_000_000      # refund post id = order key + base
VARIATION_ID_BASE = 2_000_000_000_000   # variation product id = supplier key + base
BRAND_TERM_BASE, SIZE_TERM_BASE, TYPE_TERM_BASE = 1000, 2000, 3000
MAX_SIZE_TERM = 25                      # size terms exist for sizes 1..25 only
GUEST_PRIORITY = "5-LOW"                # orders placed as guest (customer id 0)
USER_ID_SHIFT = 1                       # user id = customer key + 1 (user ids start at 1)
DISCOUNT_PRIORITY = "1-URGENT"          # orders with a cart discount and a fee line
SECOND_SHIPPING_PRIORITY = "2-HIGH"     # orders with two shipping lines
DOUBLE_DETAIL_PRIORITY = "1-URGENT"     # returns with two shipment-detail rows
STORE_COST_STEP = "0.01"                # a store's product cost is this much a place in NATION_STORE higher
LINES_PER_ORDER = 1000                  # item id = order key times this + place in the order
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
              "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _map(d: dict) -> Column:
    from itertools import chain
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def _dec(c, p=12, s=2) -> Column:
    return F.col(c).cast(f"decimal({p},{s})") if isinstance(c, str) else c.cast(f"decimal({p},{s})")


def _txt(c: Column) -> Column:
    return c.cast("string")


class ShopShapes:
    """Lazily derived shop tables over one driver data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- dimensions ---------------------------------------------------------
    @cached_property
    def customer_store(self) -> DataFrame:
        """customer -> (store, country name, city); nation is a 25-row dimension."""
        nation = F.broadcast(self.table("nation").select("n_nationkey", "n_name"))
        c = self.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        return (c.join(nation, c.c_nationkey == nation.n_nationkey, "left")
                 .select("c_custkey", "c_name", "c_mktsegment", "n_name",
                         F.array(*[F.lit(s) for s in NATION_STORE])[F.col("c_nationkey")]
                         .alias("source_store")))

    @cached_property
    def _orders(self) -> DataFrame:
        """Orders with their customer's store: what most tables below are made of."""
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                        "o_orderpriority")
        cs = self.customer_store.drop("c_name")
        return o.join(cs, o.o_custkey == cs.c_custkey, "left").drop("c_custkey")

    @cached_property
    def _refunds(self) -> DataFrame:
        """One refund per order with returned lines; amount = their extended prices."""
        li = self.table("lineitem").filter(F.col("l_returnflag") == "R")
        amt = li.groupBy("l_orderkey").agg(F.sum(_dec("l_extendedprice")).alias("refund_amount"))
        o = self._orders.select("o_orderkey", "o_orderdate", "source_store")
        return amt.join(o, amt.l_orderkey == o.o_orderkey, "inner").drop("l_orderkey")

    # -- orders (posts + post meta) ----------------------------------------
    @cached_property
    def order_posts(self) -> DataFrame:
        o = self._orders
        orders = o.select(
            "source_store", F.col("o_orderkey").alias("ID"), F.lit("shop_order").alias("post_type"),
            F.col("o_orderdate").alias("post_date"),
            _map(POST_STATUS)[F.col("o_orderstatus")].alias("post_status"),
            F.lit(0).cast("bigint").alias("post_parent"))
        r = self._refunds
        refunds = r.select(
            "source_store", (F.col("o_orderkey") + REFUND_ID_BASE).alias("ID"),
            F.lit("shop_order_refund").alias("post_type"), F.col("o_orderdate").alias("post_date"),
            F.lit("wc-completed").alias("post_status"), F.col("o_orderkey").alias("post_parent"))
        return orders.unionByName(refunds)

    @property
    def order_meta_entities(self) -> DataFrame:
        """What the order meta is made of: one row for each order and each refund."""
        o = self._orders.withColumnRenamed("o_orderkey", "post_id").drop("o_orderdate")
        r = self._refunds.select("source_store", (F.col("o_orderkey") + REFUND_ID_BASE).alias("post_id"),
                                 "refund_amount", F.lit(True).alias("refund"))
        return o.unionByName(r, allowMissingColumns=True)

    @staticmethod
    def order_meta_text(entities: DataFrame) -> DataFrame:
        """The order meta before it is unpivoted, its values as text."""
        store, prio, status = F.col("source_store"), F.col("o_orderpriority"), F.col("o_orderstatus")
        key = _txt(F.col("post_id"))
        total = _dec("o_totalprice")
        tax = F.round(total * F.lit("0.07").cast("decimal(3,2)"), 2)
        seg = F.lower(F.col("c_mktsegment"))
        number = (F.when(store.isin("TR", "OPS"), F.lit(None))
                  .when((store == "NL") & (prio == "3-MEDIUM"), F.lit("NULL"))
                  .when((store == "BE") & (prio == "2-HIGH"), F.lit("  "))
                  .otherwise(F.concat(store, F.lit("-"), key)))
        url = (F.when(status == "P", F.concat(F.lit("www."), seg, F.lit(".example.com/c/"), key))
               .otherwise(F.concat(F.lit("https://shop-"), seg, F.lit(".example.com/checkout/"), key)))
        order = F.col("refund").isNull()
        return entities.select(
            "source_store", "post_id",
            F.when(prio == GUEST_PRIORITY, F.lit("0")).otherwise(_txt(F.col("o_custkey") + USER_ID_SHIFT))
             .alias("_customer_user"),
            F.when(order, number).alias("_order_number_formatted"),
            url.alias("_wcst_order_track_http_url"),
            F.col("n_name").alias("_billing_country"),
            F.col("c_mktsegment").alias("_billing_city"),
            _map(PAYMENT_OF_PRIORITY)[prio].alias("_payment_method"),
            prio.alias("_payment_method_title"),
            F.when(order, F.coalesce(_map(STORE_ORDER_CURRENCY)[store], F.lit("EUR"))).alias("_order_currency"),
            _txt(total).alias("_order_total"),
            F.when(status == "P", F.concat(_txt(tax), F.lit(" EUR"))).otherwise(_txt(tax))
             .alias("_order_tax"),
            F.when(prio == DISCOUNT_PRIORITY,
                   _txt(F.round(total * F.lit("0.05").cast("decimal(3,2)"), 2)))
             .alias("_cart_discount"),
            _txt(F.col("refund_amount")).alias("_refund_amount"), "refund")

    @property
    def order_meta_rows(self) -> DataFrame:
        return self.order_meta_text(self.order_meta_entities)

    @cached_property
    def order_meta(self) -> DataFrame:
        return unpivoted("order_meta", self.order_meta_rows)

    # -- order items + item meta -------------------------------------------
    @cached_property
    def _lines(self) -> DataFrame:
        li = self.table("lineitem")
        # Several rows of an order may share a line number: the item id is the order key and
        # the row's place in its order, which ends with the whole row (an order is small).
        place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
        item_id = F.col("l_orderkey") * LINES_PER_ORDER + place
        li = li.select(*LINE_ORDER, "l_orderkey", item_id.alias("order_item_id"))
        o = self._orders.select("o_orderkey", "source_store")
        return li.join(o, li.l_orderkey == o.o_orderkey, "left").drop("o_orderkey", "l_linenumber", "l_shipdate")

    def _item_entities(self, lines: DataFrame) -> DataFrame:
        lines = lines.withColumnRenamed("l_orderkey", "order_id").withColumn("kind", F.lit("line_item"))
        o = self._orders.select("source_store", F.col("o_orderkey").alias("order_id"), "o_orderstatus", "o_orderpriority")

        def charge(rows: DataFrame, place: int, name: str, kind: str, cost: Column, column: str) -> DataFrame:
            return rows.select("source_store", (-(F.col("order_id") * 4 + place)).alias("order_item_id"), "order_id",
                               F.lit(name).alias("name"), F.lit(kind).alias("kind"), cost.alias(column))

        status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
        flat = F.when(status == "F", F.lit("4.95")).when(status == "O", F.lit("0.00")).otherwise(F.lit("7.50"))
        ship1 = charge(o, 1, "Flat rate", "shipping", flat, "cost")
        ship2 = charge(o.filter(prio == SECOND_SHIPPING_PRIORITY), 2, "Express", "shipping", F.lit("9.90"), "cost")
        fee = charge(o.filter(prio == DISCOUNT_PRIORITY), 3, "Handling", "fee", F.lit("2.50"), "_fee_amount")
        rows = lines
        for more in (ship1, ship2, fee):
            rows = rows.unionByName(more, allowMissingColumns=True)
        return rows

    @cached_property
    def _items(self) -> DataFrame:
        """What the order items and their meta are made of: one row for each line and charge."""
        return self._item_entities(self._lines)

    @cached_property
    def order_items(self) -> DataFrame:
        return self.order_item_rows(self._items)

    @staticmethod
    def order_item_rows(entities: DataFrame) -> DataFrame:
        name = F.when(F.col("kind") == "line_item", F.concat(F.lit("Part "), _txt(F.col("l_partkey")))).otherwise(F.col("name"))
        return entities.select("source_store", "order_item_id", "order_id", name.alias("order_item_name"),
                               F.col("kind").alias("order_item_type"))

    @staticmethod
    def item_meta_text(entities: DataFrame) -> DataFrame:
        """The item meta before it is unpivoted, its values as text: a charge has none of a line's."""
        ext = _dec("l_extendedprice")
        net = F.round(ext * (F.lit(1).cast("decimal(3,2)") - _dec("l_discount", 4, 2)), 2)
        return entities.select(
            "source_store", "order_item_id",
            _txt(F.col("l_partkey")).alias("_product_id"),
            F.when(F.col("l_linestatus") == "O", _txt(F.col("l_suppkey") + VARIATION_ID_BASE))
             .alias("_variation_id"),
            _txt(F.col("l_quantity").cast("int")).alias("_qty"),
            _txt(ext).alias("_line_subtotal"),
            _txt(net).alias("_line_total"),
            _txt(F.round(net * _dec("l_tax", 4, 2), 2)).alias("_line_tax"),
            F.when(F.col("l_returnflag") == "R", _txt(F.col("order_id") + REFUND_ID_BASE))
             .alias("_refunded_item_id"), "cost", "_fee_amount")

    @property
    def item_meta_rows(self) -> DataFrame:
        return self.item_meta_text(self._items)

    @cached_property
    def item_meta(self) -> DataFrame:
        return unpivoted("item_meta", self.item_meta_rows)

    # -- products -------------------------------------------------------------
    @property
    def _stores(self) -> Column:
        """Each store once with its (first) place among the nations."""
        return F.explode(F.array(*[F.struct(F.lit(s).alias("source_store"), F.lit(NATION_STORE.index(s)).alias("place"))
                                   for s in dict.fromkeys(NATION_STORE)]))

    @cached_property
    def store_product_lookup(self) -> DataFrame:
        """Each store's own lookup: the same product ids in every store, other SKUs."""
        lk = self.product_lookup.select("*", self._stores.alias("x"))
        sku = F.when(F.col("sku") != "", F.concat("sku", F.lit("-"), "x.source_store")).otherwise(F.col("sku"))
        return lk.select("x.source_store", "product_id", sku.alias("sku"))

    @cached_property
    def store_product_meta(self) -> DataFrame:
        """Each store's own cost meta: the clean cost is higher by the store's place."""
        m = self.product_meta.filter(F.col("meta_key").isin("_wc_cog_cost", "_alg_wc_cog_cost"))
        m = m.select("*", self._stores.alias("x"))
        more = _txt(_dec("meta_value") + F.col("x.place") * F.lit(STORE_COST_STEP).cast("decimal(12,2)"))
        return m.select("x.source_store", "post_id", "meta_key",
                        F.when(F.col("meta_key") == "_wc_cog_cost", more).otherwise(F.col("meta_value")).alias("meta_value"))

    @cached_property
    def product_lookup(self) -> DataFrame:
        """The product master's lookup: product id -> SKU; size-1 parts have an empty SKU,
        size-2 parts no row."""
        p = self.table("part")
        parts = (p.filter(F.col("p_size") != 2)
                  .select(F.col("p_partkey").alias("product_id"),
                          F.when(F.col("p_size") == 1, F.lit(""))
                           .otherwise(F.concat(F.lit("P"), _txt(F.col("p_partkey")))).alias("sku"),
                          (F.col("p_size") * 3).cast("double").alias("stock_quantity")))
        s = self.table("supplier")
        variations = s.select((F.col("s_suppkey") + VARIATION_ID_BASE).alias("product_id"),
                              F.when(F.col("s_nationkey") == 0, F.lit(""))
                               .otherwise(F.concat(F.lit("V"), _txt(F.col("s_suppkey")))).alias("sku"),
                              F.lit(None).cast("double").alias("stock_quantity"))
        return parts.unionByName(variations)

    @cached_property
    def _part_terms(self) -> DataFrame:
        p = self.table("part")
        brand_no = F.regexp_extract(F.col("p_brand"), "([0-9]+)$", 1).cast("int")
        return p.withColumn("brand_no", brand_no)

    @cached_property
    def type_terms(self) -> DataFrame:
        """One term per distinct part type, id by rank of the type name."""
        t = self.table("part").select("p_type").distinct()
        return t.select("p_type", (F.lit(TYPE_TERM_BASE) + F.dense_rank().over(
            Window.orderBy("p_type"))).cast("bigint").alias("term_id"))

    @cached_property
    def terms(self) -> DataFrame:
        """(term_id, slug, name): brand terms, size terms 1..25, type terms."""
        p = self._part_terms
        brands = p.select("brand_no").distinct().select(
            (F.col("brand_no") + BRAND_TERM_BASE).cast("bigint").alias("term_id"),
            F.concat(F.lit("brand-"), _txt(F.col("brand_no"))).alias("slug"),
            F.concat(F.lit("Brand "), _txt(F.col("brand_no"))).alias("name"))
        sizes = (p.select("p_size").distinct().filter(F.col("p_size") <= MAX_SIZE_TERM)
                  .select((F.col("p_size") + SIZE_TERM_BASE).cast("bigint").alias("term_id"),
                          F.concat(F.lit("size-"), _txt(F.col("p_size"))).alias("slug"),
                          F.concat(F.lit("EU "), _txt(F.col("p_size"))).alias("name")))
        types = self.type_terms.select("term_id", F.lower(F.col("p_type")).alias("slug"),
                                       F.col("p_type").alias("name"))
        return brands.unionByName(sizes).unionByName(types)

    @cached_property
    def product_posts(self) -> DataFrame:
        p = self.table("part")
        return p.select(F.col("p_partkey").alias("ID"), F.lit("product").alias("post_type"),
                        F.col("p_name").alias("post_title"))

    @property
    def product_meta_rows(self) -> DataFrame:
        """Product meta incl. PHP-serialized attributes and two (messy) cost keys, before it is unpivoted."""
        p = self._part_terms.join(self.type_terms, "p_type", "left")
        renk = F.concat(_txt(F.col("brand_no") + BRAND_TERM_BASE), F.lit("|"), _txt(F.col("term_id")))
        beden = _txt(F.col("p_size") + SIZE_TERM_BASE)

        def block(name: Column | str, value: Column) -> Column:
            nm = F.lit(name)
            return F.concat(
                F.lit('s:'), _txt(F.length(nm)), F.lit(':"'), nm, F.lit('";a:4:{s:4:"name";s:'),
                _txt(F.length(nm)), F.lit(':"'), nm, F.lit('";s:5:"value";s:'), _txt(F.length(value)),
                F.lit(':"'), value, F.lit('";s:8:"position";s:1:"0";s:10:"is_visible";i:1;}'))

        attrs = F.concat(F.lit("a:3:{"), block("pa_renk", renk), block("pa_beden", beden),
                         block("pa_marka", F.lit("")), F.lit("}"))
        cost = F.round(_dec("p_retailprice") * F.lit("0.01").cast("decimal(3,2)"), 2).cast("decimal(12,2)")
        alt = F.round(_dec("p_retailprice") * F.lit("0.011").cast("decimal(4,3)"), 2).cast("decimal(12,2)")
        ptype = F.col("p_type")
        alg = (F.when(ptype == "PROMO", F.regexp_replace(_txt(alt), "[.]", ","))
               .when(ptype == "SMALL", F.lit("n/a"))
               .when(ptype == "LARGE", F.concat(F.lit("-"), _txt(alt)))
               .when(ptype == "ECONOMY", F.lit("0"))
               .otherwise(_txt(alt)))
        gallery = F.concat_ws(",", _txt(F.col("p_size")), _txt(F.col("p_size") * 3), F.lit(""),
                              _txt(F.col("p_size")))
        wide = p.select(
            F.col("p_partkey").alias("post_id"),
            F.concat(F.lit("P"), _txt(F.col("p_partkey"))).alias("_sku"),
            F.concat(F.lit("M-"), _txt(F.col("brand_no"))).alias("_main_SKU"),
            attrs.alias("_product_attributes"),
            _txt(_dec("p_retailprice")).alias("_regular_price"),
            F.when(F.col("p_size") > 40, _txt(F.round(_dec("p_retailprice") * F.lit("0.9").cast("decimal(2,1)"), 2)))
             .alias("_sale_price"),
            F.when(F.col("p_size") >= 3, gallery).alias("_product_image_gallery"),
            _txt(cost).alias("_wc_cog_cost"),
            alg.alias("_alg_wc_cog_cost"))
        return wide

    @cached_property
    def product_meta(self) -> DataFrame:
        return unpivoted("product_meta", self.product_meta_rows)

    @cached_property
    def term_taxonomy(self) -> DataFrame:
        t = self.terms
        return t.select(F.col("term_id").alias("term_taxonomy_id"), "term_id",
                        F.when(F.col("term_id") >= TYPE_TERM_BASE, F.lit("product_cat"))
                         .otherwise(F.lit("product_tag")).alias("taxonomy"))

    @cached_property
    def term_relationships(self) -> DataFrame:
        """Type as category (sizes <= 45), brand as tag (sizes >= 3); sizes 1-2 have none."""
        p = self._part_terms.join(self.type_terms, "p_type", "left")
        cat = (p.filter((F.col("p_size") >= 3) & (F.col("p_size") <= 45))
                .select(F.col("p_partkey").alias("object_id"), F.col("term_id").alias("term_taxonomy_id")))
        tag = (p.filter(F.col("p_size") >= 3)
                .select(F.col("p_partkey").alias("object_id"),
                        (F.col("brand_no") + BRAND_TERM_BASE).cast("bigint").alias("term_taxonomy_id")))
        return cat.unionByName(tag)

    @cached_property
    def attachments(self) -> DataFrame:
        pg = self.table("pages")
        return pg.select(F.col("page_id").alias("ID"), F.lit("attachment").alias("post_type"),
                         F.col("url").alias("guid"),
                         F.when(F.col("url").endswith("#top"), F.lit("text/html"))
                          .otherwise(F.lit("image/jpeg")).alias("post_mime_type"))

    # -- users --------------------------------------------------------------
    @cached_property
    def users(self) -> DataFrame:
        c = self.customer_store
        return c.select("source_store", (F.col("c_custkey") + USER_ID_SHIFT).alias("ID"),
                        F.concat(F.lit("User"), _txt(F.col("c_custkey")), F.lit("@Example.COM"))
                         .alias("user_email"),
                        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("0000-00-00 00:00:00"))
                         .otherwise(F.lit("2020-01-01 00:00:00")).alias("user_registered"))

    @property
    def user_meta_rows(self) -> DataFrame:
        """The user meta before it is unpivoted: one row for each user."""
        c = self.customer_store
        seg = F.col("c_mktsegment")
        name_no = F.regexp_extract(F.col("c_name"), "([0-9]+)$", 1)
        wide = c.select(
            "source_store", (F.col("c_custkey") + USER_ID_SHIFT).alias("user_id"),
            F.when(seg == "AUTOMOBILE", F.lit("")).when(seg != "MACHINERY", F.lit("Ann"))
             .alias("first_name"),
            F.when(seg == "HOUSEHOLD", F.lit("")).when(seg != "MACHINERY", name_no).alias("last_name"),
            F.lit("Bill").alias("billing_first_name"),
            F.when(seg != "FURNITURE", name_no).alias("billing_last_name"),
            F.lit("Ship").alias("shipping_first_name"),
            name_no.alias("shipping_last_name"),
            F.concat(F.lit("+31-"), name_no).alias("billing_phone"),
            F.col("n_name").alias("billing_country"),
            seg.alias("billing_city"))
        return wide

    @cached_property
    def user_meta(self) -> DataFrame:
        return unpivoted("user_meta", self.user_meta_rows)

    # -- return portal ------------------------------------------------------
    @cached_property
    def shipments(self) -> DataFrame:
        r = self._refunds.select(F.col("o_orderkey").alias("returned"))
        o = self._orders
        s = o.join(r, o.o_orderkey == r.returned, "left_semi")
        return s.select(F.col("o_orderkey").alias("id"), _txt(F.col("o_orderkey")).alias("order_id"),
                        F.concat(F.lit("c"), _txt(F.col("o_custkey")), F.lit("@example.com")).alias("order_email"),
                        F.col("o_orderdate").alias("order_date"),
                        (F.col("o_orderdate") + F.expr("INTERVAL 14 DAYS")).alias("created_at"),
                        F.concat(F.lit("shop-"), F.lower(F.col("c_mktsegment")), F.lit(".example.com")).alias("order_site"),
                        _map(POST_STATUS)[F.col("o_orderstatus")].alias("shipment_status"),
                        "o_orderpriority", "n_name", "c_mktsegment", "source_store")

    @cached_property
    def shipment_items(self) -> DataFrame:
        li = self._lines.filter(F.col("l_returnflag") == "R")
        p = self._part_terms.select("p_partkey", "brand_no", "p_size")
        j = li.join(p, li.l_partkey == p.p_partkey, "left")
        sku = F.concat(F.lit("P"), _txt(F.col("l_partkey")))
        sku = F.when(F.col("l_linestatus") == "O", F.concat(F.lit(" "), sku, F.lit("\r"))).otherwise(sku)
        attrs = (F.when(F.col("l_linestatus") == "O",
                        F.concat(F.lit('{"pa_renk":{"value":"brand-'), _txt(F.col("brand_no")),
                                 F.lit('"},"pa_beden":{"value":"'), _txt(F.col("p_size") + SIZE_TERM_BASE),
                                 F.lit('"},"x":{"value":"y"}}')))
                 .when(F.col("l_discount") > 0.05, F.lit("[]"))
                 .otherwise(F.concat(F.lit('{"pa_materyal":{"value":"cotton"},"pa_beden":{"value":"size-'),
                                     _txt(F.col("p_size")), F.lit('"}}'))))
        return j.select(F.col("order_item_id").alias("id"), F.col("l_orderkey").alias("shipment_id"),
                        sku.alias("product_sku"), attrs.alias("attributes"),
                        F.concat(F.lit("reason-"), F.col("l_linestatus")).alias("return_reason"),
                        _dec("l_extendedprice").alias("total"))

    @cached_property
    def shipment_details(self) -> DataFrame:
        s = self.shipments
        first = s.select(F.col("id").alias("shipment_id"), F.lit("DHL").alias("shiping_method"),
                         F.lit("4.95").cast("decimal(12,2)").alias("shiping_price"),
                         F.lit("label").alias("payment_method"),
                         F.coalesce(_map(STORE_ORDER_CURRENCY)[F.col("source_store")], F.lit("EUR"))
                          .alias("currency"))
        second = (s.filter(F.col("o_orderpriority") == DOUBLE_DETAIL_PRIORITY)
                   .select(F.col("id").alias("shipment_id"), F.lit("UPS").alias("shiping_method"),
                           F.lit("6.50").cast("decimal(12,2)").alias("shiping_price"),
                           F.lit("refund").alias("payment_method"),
                           F.lit("EUR").alias("currency")))
        return first.unionByName(second)

    @cached_property
    def shipment_addresses(self) -> DataFrame:
        s = self.shipments
        return s.select(F.col("id").alias("shipment_id"), F.col("n_name").alias("country"),
                        F.col("c_mktsegment").alias("city"))

    # -- ads ----------------------------------------------------------------
    def ads_records(self, start: str | None = None, end: str | None = None,
                    spend_factor: str = "1.0") -> DataFrame:
        """Ads API rows from events: one per (user, event type, day) in [start, end).

        ``purchase_roas`` is an array of {action_type, value}, empty for non-purchases;
        ``position`` is the order of the row in the API answer (first event id).
        """
        e = self.table("events")
        if start:
            e = e.filter(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
        if end:
            e = e.filter(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
        k = F.get_json_object(F.col("props"), "$.k").try_cast("bigint")
        day = F.to_date(F.col("ts"))
        g = e.groupBy("user_id", "event_type", day.alias("day")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(k, F.lit(0))).alias("k_sum"),
            F.sum(_dec("value")).alias("v_sum"), F.min("event_id").alias("position"))
        spend = F.round(F.col("v_sum") * F.lit(spend_factor).cast("decimal(3,1)"), 2)
        # rounded ratios by integer arithmetic (half up), identical in every engine
        cents = (spend * 100).cast("bigint")
        roas_units = F.floor((F.col("k_sum") * 20000 + F.col("n")) / (F.col("n") * 2))
        roas_txt = F.format_string("%d.%04d", F.floor(roas_units / 10000).cast("bigint"),
                                   (roas_units % 10000).cast("bigint"))
        roas = F.when(F.col("event_type") == "purchase",
                      F.array(F.struct(F.lit("omni_purchase").alias("action_type"),
                                       roas_txt.alias("value"))))
        roas = F.coalesce(roas, F.array().cast("array<struct<action_type:string,value:string>>"))
        cpc_units = F.floor((cents * 2 + F.col("k_sum")) / (F.col("k_sum") * 2))
        cpc_txt = F.format_string("%d.%02d", F.floor(cpc_units / 100).cast("bigint"),
                                  (cpc_units % 100).cast("bigint"))
        return g.select(
            F.concat(F.lit("camp-"), F.col("event_type")).alias("campaign_name"),
            F.concat(F.lit("ad-"), _txt(F.col("user_id"))).alias("ad_name"),
            F.concat(F.lit("set-"), _txt(F.col("user_id"))).alias("adset_name"),
            _txt(F.col("n") * 10).alias("impressions"), _txt(F.col("k_sum")).alias("clicks"),
            _txt(spend).alias("spend"),
            F.when(F.col("k_sum") > 0, cpc_txt).alias("cpc"),
            roas.alias("purchase_roas"),
            _txt(F.col("day")).alias("date_start"), _txt(F.col("day")).alias("date_stop"),
            "position")


SOURCE_TABLES = ["order_posts", "order_meta", "order_items", "item_meta", "product_lookup",
                 "store_product_lookup", "store_product_meta", "product_posts", "product_meta", "terms", "term_taxonomy",
                 "term_relationships", "attachments", "users", "user_meta", "shipments",
                 "shipment_items", "shipment_details", "shipment_addresses"]


#: What several of them are made of; stored with them, so that it is made once.
SHARED_PARTS = ["_orders", "_refunds", "_lines", "_items"]
#: Attribute tables and their entity's key.
EAV_TABLES = {"order_meta": ["source_store", "post_id"], "item_meta": ["source_store", "order_item_id"],
              "product_meta": ["post_id"], "user_meta": ["source_store", "user_id"]}
#: Bytes of the driver's parquet for each bucket: a bucket of the largest attribute table is then
#: some hundred MB in memory, however large the input.
BUCKET_BYTES = 4_000_000


def unpivoted(name: str, rows: DataFrame) -> DataFrame:
    """An attribute table from one row for each entity.  A refund has its amount even if that is NULL."""
    if "refund" not in rows.columns:
        return eav_unpivot(rows, EAV_TABLES[name])
    long = eav_unpivot(rows, [*EAV_TABLES[name], "refund"], drop_nulls=False)
    amount = F.col("refund") & (F.col("meta_key") == "_refund_amount")
    return long.filter(F.col("meta_value").isNotNull() | amount).drop("refund")


class StoredShapes(ShopShapes):
    """Shop tables of which those named are published under ``root`` at their first use.

    A query reads stored source tables, as it would in production (extracts landed per store),
    and waits only for those that it reads.  Entities and their attributes are stored in buckets
    of the entity's key.  Whatever is stored there already is replaced, never reused.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, root: str, names=SOURCE_TABLES):
        super().__init__(spark, sf_dir)
        self.root, self.stored = root.rstrip("/"), frozenset([*names, *SHARED_PARTS])

    def __getattribute__(self, name: str):
        if name.startswith("__") or name in ("stored", "root") or name not in self.stored or name in self.__dict__:
            return super().__getattribute__(name)
        self.__dict__[name] = self._store(name)
        return self.__dict__[name]

    @cached_property
    def buckets(self) -> int:
        """As many as the session shuffles to, more if the input is large."""
        from martlane.sources.files import fingerprint
        size = sum(n for _, n, _ in fingerprint(self.spark, self.sf_dir))
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))

    def plain(self, name: str) -> DataFrame:
        """A table for a plan that gains nothing from buckets: as it is stored, if another plan had
        it stored, else made of the shared parts as it is read.  Same rows, nothing dealt or written."""
        if name in self.__dict__:
            return self.__dict__[name]
        if name == "order_items":
            return self.order_item_rows(self.plain("_items"))
        if name == "item_meta":
            return unpivoted(name, self.item_meta_text(self.plain("_items")))
        return getattr(ShopShapes, name).func(self)

    @contextmanager
    def passing(self) -> Iterator[None]:
        """What is stored within is deleted at the end, as it was only stored to be landed
        elsewhere; what was there before stays, and the next use stores a table anew."""
        from martlane.sources.files import file_system
        before = set(self.__dict__)
        yield
        for name in self.stored.intersection(self.__dict__) - before:
            del self.__dict__[name]
            fs, path = file_system(self.spark, f"{self.root}/{name}")
            fs.delete(path, True)

    def _store(self, name: str) -> DataFrame:
        from martlane.sources.bucketed import ATTRIBUTE_CODEC, BUCKET_KEYS, store_bucketed
        from martlane.sources.sinks import publish
        path = f"{self.root}/{name}"
        if name == "order_items":
            return self.order_item_rows(self._items)     # in the buckets and the order of those
        if name not in BUCKET_KEYS:
            return publish(super().__getattribute__(name), path, compression=ATTRIBUTE_CODEC if name == "_lines" else None)
        path, keys = f"{path}/{uuid.uuid4().hex}", BUCKET_KEYS[name]
        store = partial(store_bucketed, name=name, path=path, keys=keys, buckets=self.buckets)
        if name == "_items":
            return store(self._item_entities(self.plain("_lines")))
        # the rows of an attribute table's entities are dealt as they are, and spelled out afterwards
        if name == "order_meta":
            return store(self.order_meta_entities, unpivot=lambda dealt: unpivoted(name, self.order_meta_text(dealt)))
        if name == "item_meta":
            return store(self._items, unpivot=lambda dealt: unpivoted(name, self.item_meta_text(dealt)))
        if name in EAV_TABLES:
            return store(getattr(self, f"{name}_rows"), unpivot=partial(unpivoted, name))
        return store(super().__getattribute__(name))


def materialize(shapes: ShopShapes, root: str, names=SOURCE_TABLES) -> ShopShapes:
    """Publish each shaped source table under ``root`` at once, and read it back."""
    stored = StoredShapes(shapes.spark, shapes.sf_dir, root, names)
    for name in names:
        getattr(stored, name)
    return stored
