"""Output schemas of the marts and the store dimension.

All values below under "fixed values" must equal the source system's constants
for results to match; they are stated once, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Stores, prefixes, currencies, rates.
# ---------------------------------------------------------------------------

# Stores merged into the master orders / order items (in merge order).
MASTER_ORDER_STORES = ["OPS", "TR", "DE", "FR", "NL", "BE", "BEFRLU", "AT", "DK", "ES",
                       "IT", "SE", "FI", "PT", "CZ", "HU", "RO", "SK", "UK"]
# Stores merged into the master customers (no marketplace store).
MASTER_CUSTOMER_STORES = ["TR", "DE", "FR", "NL", "BE", "BEFRLU", "AT", "DK", "ES",
                          "IT", "SE", "FI", "PT", "CZ", "HU", "RO", "SK", "UK"]

# Prefix of refund order numbers: "<prefix>-REFUND-<id>"; any other store uses "".
REFUND_PREFIX = {
    "NL": "101", "BE": "201", "DE": "301", "AT": "401", "BEFR": "241", "BEFRLU": "241",
    "FR": "501", "DK": "601", "SE": "901", "FI": "641", "PT": "741", "ES": "701",
    "IT": "801", "CZ": "461", "HU": "441", "RO": "531", "SK": "561", "UK": "161",
    "OPS": "",
}

# Prefix of customer numbers: "<prefix>-<store>-<id>"; TR is the bare id; others "<store>-<id>".
CUSTOMER_PREFIX = {
    "NL": "101", "BE": "201", "DE": "301", "AT": "401", "CZ": "461", "HU": "441",
    "BEFRLU": "241", "FR": "501", "RO": "531", "SK": "561", "FI": "641", "PT": "741",
    "ES": "701", "IT": "801", "SE": "901", "DK": "601", "UK": "161",
}

# Currency of a store, first matching substring of the store code wins; default EUR.
STORE_CURRENCY_RULES = [("FR", "EUR"), ("TR", "TRY"), ("HU", "HUF"), ("DK", "DKK"),
                        ("CZ", "CZK"), ("RO", "RON"), ("SE", "SEK"), ("GB", "GBP")]
DEFAULT_CURRENCY = "EUR"

# Seed exchange rates (currency -> rate to EUR).
SEED_RATES = [("EUR", "1.000000"), ("GBP", "1.165000"), ("DKK", "0.134000"),
              ("SEK", "0.087000"), ("CZK", "0.040000"), ("HUF", "0.002500"),
              ("RON", "0.201000"), ("TRY", "0.028000")]

# Order types and item types of the shop schema.
ORDER_TYPE = "shop_order"
REFUND_TYPE = "shop_order_refund"
PRODUCT_TYPES = ["product", "product_variation"]
MARKETPLACE_STORE = "OPS"
MARKETPLACE_PAYMENTS = ["bol", "other"]
UNREGISTERED_SKU = "(Unregistered SKU)"
CHANNEL_PREFIX = "WOO-"             # channel = prefix + store code
REFUND_NUMBER_INFIX = "-REFUND-"    # refund number = refund prefix + infix + refund id
MISSING_NUMBER_PREFIX = "ORD"       # fallback order number = prefix + order id
STORE_DATABASE = "woo_{store}"      # per-store database name (lower-case store code)
COST_KEYS = ["_alg_wc_cog_cost", "_wc_cog_cost"]
MARGIN_BOUND = "9999.99"
ADS_LOOKBACK_DAYS = 60

# ---------------------------------------------------------------------------
# Types
# ---------------------------------------------------------------------------

MONEY = T.DecimalType(12, 2)
MONEY4 = T.DecimalType(12, 4)
MARGIN = T.DecimalType(8, 2)
RATE = T.DecimalType(12, 6)

# Columns of the marts.
ORDERS_COLUMNS = [
    "order_number_formatted", "source_store", "order_id", "order_date", "order_status",
    "customer_id", "country_code", "channel", "site", "billing_country", "billing_city",
    "units_total", "ordered_items_count", "ordered_items_skus", "payment_method",
    "currency_code", "subtotal", "gross_total", "cogs", "total_price", "tax_amount",
    "shipping_fee", "fee_amount", "discount_amount", "refunded_amount", "ads_spend",
    "logistics_cost", "other_costs", "net_profit", "net_revenue", "net_margin",
]

ORDER_MONEY_COLUMNS = ["subtotal", "gross_total", "cogs", "total_price", "tax_amount",
                       "shipping_fee", "fee_amount", "discount_amount", "refunded_amount",
                       "ads_spend", "logistics_cost", "other_costs", "net_profit",
                       "net_revenue"]

ORDER_ITEMS_COLUMNS = [
    "order_item_id", "order_id", "product_id", "variation_id", "sku", "order_item_name",
    "quantity", "line_total", "line_tax", "refund_reference", "currency_code",
    "source_store", "created_at",
]

CUSTOMERS_COLUMNS = [
    "customer_number_formatted", "customer_id", "full_name", "email", "phone",
    "registered_at", "first_order_date", "last_order_date", "orders_count", "units_total",
    "ltv", "aov", "refunds_total", "billing_country", "billing_city", "source_store",
]

PRODUCTS_COLUMNS = ["product_id", "title", "sku", "parent_sku", "attributes", "stock_qty",
                    "categories", "tags", "regular_price", "sale_price", "image_url", "cogs"]

RETURNS_COLUMNS = [
    "return_id", "order_number", "order_email", "order_date", "return_request_date",
    "order_site", "shipping_method", "payment_for_return_fee", "return_request_status",
    "return_requested_items_count", "return_requested_items_sku",
    "return_requested_items_attributes", "return_reason", "return_method",
    "return_requested_total_amount", "country_code", "city", "currency",
]

ADS_COLUMNS = ["campaign_name", "ad_name", "adset_name", "impressions", "clicks", "spend",
               "cpc", "purchase_roas", "date_start", "date_stop"]

ADS_JSON_SCHEMA = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("campaign_name", T.StringType()),
        T.StructField("ad_name", T.StringType()),
        T.StructField("adset_name", T.StringType()),
        T.StructField("impressions", T.StringType()),
        T.StructField("clicks", T.StringType()),
        T.StructField("spend", T.StringType()),
        T.StructField("cpc", T.StringType()),
        T.StructField("purchase_roas", T.ArrayType(T.StructType([
            T.StructField("action_type", T.StringType()),
            T.StructField("value", T.StringType()),
        ]))),
        T.StructField("date_start", T.StringType()),
        T.StructField("date_stop", T.StringType()),
    ]))),
])
