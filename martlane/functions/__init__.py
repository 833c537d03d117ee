"""Column expressions shared by the marts. All are JVM-side built-ins; no Python UDF."""

from martlane.functions.dates import lenient_datetime, month_chunks, plan_ads_window
from martlane.functions.numbers import (lenient_decimal, net_margin, net_profit, net_revenue,
                                        positive_number_text, safe_ratio)
from martlane.functions.text import (capitalize_first, clean_sku, currency_of_store,
                                     customer_number, drop_invalid_utf8, full_name,
                                     order_number, pim_sku, sku_label, strip_cr, url_host,
                                     valid_order_number)

__all__ = [
    "lenient_datetime", "month_chunks", "plan_ads_window", "lenient_decimal", "net_margin",
    "net_profit", "net_revenue", "positive_number_text", "safe_ratio",
    "capitalize_first", "clean_sku", "currency_of_store", "customer_number",
    "drop_invalid_utf8", "full_name", "order_number", "pim_sku", "sku_label", "strip_cr",
    "url_host", "valid_order_number",
]
