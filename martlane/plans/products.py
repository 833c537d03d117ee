"""Product master: pivot, decoded attributes, categories/tags, gallery and images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane import schemas as S
from martlane.functions.attributes import decode_php_attributes, term_dictionary
from martlane.functions.numbers import lenient_decimal
from martlane.functions.text import drop_invalid_utf8
from martlane.operators.eav import eav_pivot
from martlane.operators.lists import ordered_join
from martlane.operators.merge import update_from

PRODUCT_META = {
    "sku": "_sku", "parent_sku": "_main_SKU", "attributes_raw": "_product_attributes",
    "regular_price_text": "_regular_price", "sale_price_text": "_sale_price",
    "gallery_text": "_product_image_gallery", "cogs_text": S.COST_KEYS,
}


def product_base(posts: DataFrame, post_meta: DataFrame, product_lookup: DataFrame) -> DataFrame:
    """Products and variations with their pivoted meta and stock (one pivot of the meta)."""
    p = posts.filter(F.col("post_type").isin(S.PRODUCT_TYPES)).select(
        F.col("ID").alias("product_id"), F.col("post_title").alias("title"))
    meta = eav_pivot(post_meta, "post_id", PRODUCT_META).withColumnRenamed("post_id", "product_id")
    stock = product_lookup.groupBy("product_id").agg(F.max("stock_quantity").alias("stock"))
    return p.join(meta, "product_id", "left").join(stock, "product_id", "left")


def build_products(posts: DataFrame, post_meta: DataFrame, product_lookup: DataFrame,
                   terms: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Products with decoded attributes and typed prices.

    ``image_url`` starts as the gallery id list and ``categories``/``tags`` as NULL, as
    in the source; the roll-ups below replace them.
    """
    j = base if base is not None else product_base(posts, post_meta, product_lookup)
    attrs = decode_php_attributes(j.select("product_id", "attributes_raw"), "product_id",
                                  "attributes_raw", term_dictionary(terms, with_slugs=False))
    j = j.join(attrs, "product_id", "left")
    return j.select(
        "product_id", drop_invalid_utf8("title").alias("title"), "sku", "parent_sku",
        drop_invalid_utf8("attributes").alias("attributes"),
        F.round(F.col("stock"), 0).cast("int").alias("stock_qty"),
        F.lit(None).cast("string").alias("categories"), F.lit(None).cast("string").alias("tags"),
        lenient_decimal("regular_price_text").alias("regular_price"),
        lenient_decimal("sale_price_text").alias("sale_price"),
        F.col("gallery_text").alias("image_url"),
        lenient_decimal("cogs_text").alias("cogs"))


def rollup_categories(term_relationships: DataFrame, term_taxonomy: DataFrame,
                      terms: DataFrame) -> DataFrame:
    """Per object: distinct category names and distinct other-taxonomy names (sorted,
    ','-joined); NULL when the object has none of that kind."""
    j = (term_relationships.join(term_taxonomy, "term_taxonomy_id", "inner")
                           .join(terms.select("term_id", "name"), "term_id", "inner"))
    is_cat = F.col("taxonomy") == "product_cat"

    def names(cond):
        v = F.when(cond, F.col("name"))
        return F.when(F.count(v) > 0, F.array_join(F.sort_array(F.collect_set(v)), ","))

    return j.groupBy(F.col("object_id").alias("product_id")).agg(
        names(is_cat).alias("categories"), names(~is_cat).alias("tags"))


def apply_categories(products: DataFrame, cats: DataFrame) -> DataFrame:
    """UPDATE products INNER JOIN cats: unmatched products keep their values."""
    return update_from(products, cats, ["product_id"], ["categories", "tags"], how="inner")


def gallery_pairs(posts: DataFrame, post_meta: DataFrame) -> DataFrame:
    """(product_id, image_id): the gallery id list exploded, blanks dropped, pairs unique."""
    p = posts.filter(F.col("post_type").isin(S.PRODUCT_TYPES)).select(F.col("ID").alias("post_id"))
    g = eav_pivot(post_meta, "post_id", {"ids": "_product_image_gallery"})
    j = p.join(g, "post_id", "left").withColumnRenamed("post_id", "product_id")
    return pairs_from_lists(j, "ids")


def pairs_from_lists(df: DataFrame, ids_col: str) -> DataFrame:
    """(product_id, id list text) -> unique (product_id, image_id) pairs."""
    e = df.select("product_id", F.explode(F.split(ids_col, ",")).alias("x"))
    e = e.filter(F.col("x") != "")
    image_id = F.coalesce(F.regexp_extract("x", r"^\s*([0-9]+)", 1).try_cast("bigint"), F.lit(0).cast("bigint"))
    return e.select("product_id", image_id.alias("image_id")).distinct()


def image_urls(attachments: DataFrame) -> DataFrame:
    return (attachments.filter((F.col("post_type") == "attachment")
                               & F.col("post_mime_type").startswith("image/"))
                       .select(F.col("ID").alias("image_id"), F.col("guid").alias("image_url")))


def rollup_images(pairs: DataFrame, urls: DataFrame) -> DataFrame:
    """Per product: image URLs joined by ',' in image-id order; NULL when none resolve."""
    j = pairs.join(urls, "image_id", "left")
    return j.groupBy("product_id").agg(ordered_join("image_url", "image_id", ",").alias("urls"))


def apply_images(products: DataFrame, rolled: DataFrame) -> DataFrame:
    """UPDATE products LEFT JOIN rolled SET image_url: products without images get NULL."""
    return update_from(products, rolled, ["product_id"], {"image_url": "urls"}, how="left")


def product_master(posts, post_meta, product_lookup, terms, term_relationships, term_taxonomy,
                   attachments, base: DataFrame) -> DataFrame:
    """Products -> categories/tags -> images, in the source's dependency order.

    ``base`` is the stored ``product_base``: three branches read it (attributes, gallery, the
    row itself), and column pruning would give each its own pivot of the meta.
    """
    prod = build_products(posts, post_meta, product_lookup, terms, base=base)
    # gallery pairs come from the same pivot of the product meta
    pairs = pairs_from_lists(base.select("product_id", "gallery_text"), "gallery_text")
    prod = apply_categories(prod, rollup_categories(term_relationships, term_taxonomy, terms))
    return apply_images(prod, rollup_images(pairs, image_urls(attachments)))
