"""String column functions (order numbers, SKU labels, names, cleaning)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlane import schemas as S


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _map_literal(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def _blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def url_host(url) -> Column:
    """Third '/'-separated field: the host of an absolute URL (same oddity on 'a/b/c/d')."""
    return F.substring_index(F.substring_index(_col(url), "/", 3), "/", -1)


def sku_label(parent_sku, variation_sku) -> Column:
    """Item SKU label used in the order SKU list."""
    p, v = _col(parent_sku), _col(variation_sku)
    return (F.when(_blank(p) & _blank(v), F.lit(S.UNREGISTERED_SKU))
            .when(v.isNotNull() & (v != p), F.concat(p, F.lit("("), v, F.lit(")")))
            .otherwise(F.coalesce(p, v, F.lit(S.UNREGISTERED_SKU))))


def pim_sku(variation_id, parent_sku, variation_sku) -> Column:
    """Order-item SKU from the product master map (4 branches)."""
    vid, p, v = _col(variation_id), _col(parent_sku), _col(variation_sku)
    return (F.when(vid.isNull() | (vid == 0), p)
            .when(p.isNull(), v)
            .when(v.isNull(), p)
            .otherwise(F.concat(p, F.lit("("), v, F.lit(")"))))


def full_name(first, last, billing_first, billing_last, shipping_first, shipping_last) -> Column:
    """Own name, else billing name, else shipping name; '' when all are empty."""
    def present(a, b):
        return ~_blank(_col(a)) | ~_blank(_col(b))

    def joined(a, b):
        return F.trim(F.concat_ws(" ", _col(a), _col(b)))

    return (F.when(present(first, last), joined(first, last))
            .when(present(billing_first, billing_last), joined(billing_first, billing_last))
            .otherwise(joined(shipping_first, shipping_last)))


def clean_sku(c) -> Column:
    """Remove CR, LF and spaces, then trim."""
    return F.trim(F.regexp_replace(_col(c), "[\r\n ]", ""))


def strip_cr(c) -> Column:
    return F.regexp_replace(_col(c), "\r", "")


def drop_invalid_utf8(c) -> Column:
    """Drop invalid UTF-8 byte sequences (input string or binary)."""
    return F.regexp_replace(F.make_valid_utf8(_col(c)), "�", "")


def capitalize_first(c) -> Column:
    c = _col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))


def valid_order_number(c) -> Column:
    """Not NULL, not '', not blank after trim, not the text 'NULL'."""
    c = _col(c)
    return c.isNotNull() & (c != "") & (F.length(F.trim(c)) > 0) & (c != "NULL")


def order_number(store, post_type, order_id, formatted_meta) -> Column:
    """Order number: TR uses the id; refunds get '<prefix>-REFUND-<id>'; else the meta value."""
    store, post_type = _col(store), _col(post_type)
    oid = _col(order_id).cast("string")
    prefix = F.coalesce(_map_literal(S.REFUND_PREFIX)[store], F.lit(""))
    return (F.when(store == "TR", oid)
            .when(post_type == S.REFUND_TYPE, F.concat(prefix, F.lit(S.REFUND_NUMBER_INFIX), oid))
            .otherwise(_col(formatted_meta)))


def customer_number(store, customer_id) -> Column:
    """Customer number: TR bare id; '<prefix>-<store>-<id>' for known stores; else '<store>-<id>'."""
    store = _col(store)
    cid = _col(customer_id).cast("string")
    prefix = _map_literal(S.CUSTOMER_PREFIX)[store]
    return (F.when(store == "TR", cid)
            .when(prefix.isNotNull(), F.concat(prefix, F.lit("-"), store, F.lit("-"), cid))
            .otherwise(F.concat(store, F.lit("-"), cid)))


def currency_of_store(store, uk_as_gbp: bool = False) -> Column:
    """Currency by ordered substring rules on the store code; 'UK' falls to EUR unless asked."""
    store = _col(store)
    rules = list(S.STORE_CURRENCY_RULES)
    if uk_as_gbp:
        rules.append(("UK", "GBP"))
    expr = None
    for needle, cur in rules:
        cond = store.contains(needle)
        expr = F.when(cond, F.lit(cur)) if expr is None else expr.when(cond, F.lit(cur))
    return expr.otherwise(F.lit(S.DEFAULT_CURRENCY))
