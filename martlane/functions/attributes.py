"""Decoding of serialized product/return attributes as DataFrame plans (no UDF).

Both decoders explode the serialized text into (entity, segment, position, key, value)
rows, map values through the term dictionary with a join (AQE broadcasts it if it is small
at run time), and regroup the pieces in source order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlane.functions.text import capitalize_first, strip_cr

# Attribute keys and their display names.
PHP_KEY_NAMES = {"renk": "Color", "beden": "Size", "materyal": "Material",
                 "cinsiyet": "Gender", "ozellik": "Feature"}
JSON_KEY_NAMES = {"pa_renk": "Color", "pa_beden": "Size", "pa_materyal": "Material",
                  "pa_cinsiyet": "Gender", "pa_ozellik": "Feature"}
JSON_KEY_ORDER = list(JSON_KEY_NAMES)

PHP_SEGMENT_SPLIT = 's:[0-9]+:"pa_'
PHP_VALUE = 's:[0-9]+:"([0-9|]+)"'


def _map_literal(d: dict) -> Column:
    from itertools import chain
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def _ordered_join(order_cols: list[str], value_col: str, sep: str) -> Column:
    """Aggregate: join values in the order of ``order_cols``."""
    st = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)],
                  F.col(value_col).alias("v"))
    return F.array_join(F.transform(F.array_sort(F.collect_list(st)), lambda x: x["v"]), sep)


def decode_php_attributes(df: DataFrame, id_col: str, raw_col: str,
                          dictionary: DataFrame) -> DataFrame:
    """(id, raw PHP-serialized attributes) -> (id, 'Key:v1,v2, Key2:v').

    Segments split on ``s:<n>:"pa_``; key = text up to the next quote; value = the first
    ``s:<n>:"<digits|pipes>"`` of the segment, split on '|', each id through the term
    dictionary (unknown ids kept).  Segments without such a value are skipped; entities
    without any decoded segment (or with NULL input) get ''.
    ``dictionary``: (term_key string, term_name string), one row per key.
    """
    segs = df.select(F.col(id_col).alias("_id"),
                     F.posexplode(F.split(strip_cr(F.col(raw_col)), PHP_SEGMENT_SPLIT))
                      .alias("_seg_pos", "_seg"))
    segs = segs.filter(F.col("_seg_pos") > 0).select(
        "_id", "_seg_pos",
        F.regexp_extract("_seg", '^([^"]*)"', 1).alias("_key"),
        F.regexp_extract("_seg", PHP_VALUE, 1).alias("_val"))
    segs = segs.filter(F.col("_val") != "")
    ids = segs.select("_id", "_seg_pos", "_key",
                      F.posexplode(F.split(F.regexp_replace("_val", "[|]", ","), ","))
                       .alias("_id_pos", "_term"))
    d = dictionary.select(F.col("term_key").alias("_term"), F.col("term_name").alias("_name"))
    mapped = ids.join(d, "_term", "left").withColumn(
        "_mapped", F.coalesce(F.col("_name"), F.col("_term")))
    per_seg = mapped.groupBy("_id", "_seg_pos", "_key").agg(
        _ordered_join(["_id_pos"], "_mapped", ",").alias("_vals"))
    key = F.coalesce(_map_literal(PHP_KEY_NAMES)[F.col("_key")], capitalize_first(F.col("_key")))
    per_seg = per_seg.withColumn("_pair", F.concat(key, F.lit(":"), F.col("_vals")))
    per_id = per_seg.groupBy("_id").agg(_ordered_join(["_seg_pos"], "_pair", ", ").alias("attributes"))
    out = df.select(F.col(id_col).alias("_id")).join(per_id, "_id", "left")
    return out.select(F.col("_id").alias(id_col),
                      F.coalesce(F.col("attributes"), F.lit("")).alias("attributes"))


JSON_ATTR_TYPE = "map<string,struct<value:string>>"


def decode_json_blobs(blobs: DataFrame, keys: list[str], blob_col: str, dictionary: DataFrame) -> DataFrame:
    """(keys, JSON blob) -> (keys, 'Color:Red, Size:XL'), blobs that decode to nothing left out.

    Only trimmed blobs that look like ``{...}`` and parse as an object are used; entries
    keep their source key order; five known keys are renamed, others dropped; each value
    maps through the slug/id dictionary (unknown kept); blank keys/values are skipped.
    """
    b = blobs.select(*keys, F.trim(F.col(blob_col)).alias("_blob"))
    b = b.filter(F.col("_blob").rlike(r"^\{.*\}$"))
    parsed = b.select(*keys, F.posexplode(F.map_entries(F.from_json("_blob", JSON_ATTR_TYPE)))
                      .alias("_epos", "_e"))
    entries = parsed.select(*keys, "_epos", F.col("_e.key").alias("_k"),
                            F.trim(F.col("_e.value.value")).alias("_v"))
    entries = entries.filter(F.col("_k").isin(JSON_KEY_ORDER) & F.col("_v").isNotNull()
                             & (F.col("_v") != ""))
    d = dictionary.select(F.col("term_key").alias("_v"), F.col("term_name").alias("_name"))
    m = entries.join(d, "_v", "left")
    pair = F.concat(_map_literal(JSON_KEY_NAMES)[F.col("_k")], F.lit(":"),
                    F.coalesce(F.col("_name"), F.col("_v")))
    return m.withColumn("_pair", pair).groupBy(*keys).agg(
        _ordered_join(["_epos"], "_pair", ", ").alias("attributes"))


def decode_json_attributes(blobs: DataFrame, id_col: str, blob_pos_col: str, blob_col: str,
                           dictionary: DataFrame) -> DataFrame:
    """(id, blob position, JSON blob) -> (id, 'Color:Red, Size:XL || Color:Blue') in the
    order of the positions; NULL when nothing decodes."""
    per_blob = decode_json_blobs(blobs, [id_col, blob_pos_col], blob_col, dictionary)
    return per_blob.groupBy(id_col).agg(
        _ordered_join([blob_pos_col], "attributes", " || ").alias("attributes"))


def term_dictionary(terms: DataFrame, with_slugs: bool = True) -> DataFrame:
    """Lookup key -> term name: id -> name, plus slug -> name.  A key seen more than once
    (a repeated slug) resolves to the term with the highest id."""
    by_id = terms.select(F.col("term_id").cast("string").alias("term_key"), "term_id",
                         F.col("name").alias("term_name"))
    rows = by_id
    if with_slugs:
        rows = rows.unionByName(terms.select(F.col("slug").alias("term_key"), "term_id",
                                             F.col("name").alias("term_name")))
    return rows.groupBy("term_key").agg(F.max_by("term_name", "term_id").alias("term_name"))
