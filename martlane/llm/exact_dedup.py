"""Exact dedup by deterministic block naming, in DataFrame operations only.

A normalised text is cut into blocks of ``BLOCK`` code points.  The distinct blocks are
sorted inside their hash bucket and numbered, so each block has one integer name.  Adjacent
names are paired, the distinct pairs are sorted and numbered again, and so on until every
document has one name.  Two documents of the same block count have the same last name
exactly if their texts are equal: names stand for contents, not for hashes of them.

Block texts are shuffled once, after equal blocks of a task were merged.  A document finds
its names by the 64-bit hash of its blocks; the hashes that stand for two different blocks
are looked up by the block's text instead (``_collisions``), so a hash collision costs a
second look and never merges two texts.

Nulls and empty tables: a null text is an empty text, equal to every other empty text; a
null ``doc_id`` sorts after all others.  Of rows repeated with the same ``doc_id`` and text
exactly one is kept.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlane.llm.common import cut

#: Code points of a block.  Longer texts take more naming rounds, one for each doubling.
BLOCK = 8192


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; single spaces are not touched."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\t-\r][ \t-\r]*| [ \t-\r]+", " ")


def _blocks(text: Column, block: int) -> Column:
    return (F.when(F.length(text) <= block, F.array(text))
            .otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))))


def _named(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Number the distinct keys in sorted order inside each bucket (partition)."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def _collisions(rows: DataFrame, texts: DataFrame, block: int, hashed, doubtful: DataFrame) -> DataFrame:
    """Names of the blocks whose hash stands for several blocks, found by their text."""
    there = (texts.select("rid", F.posexplode(_blocks(F.col("t"), block)).alias("i", "b"))
             .withColumn("h", hashed(F.col("b"))).join(doubtful, "h", "left_semi"))
    names = _named(there.select("h", "b").distinct(), ["h", "b"])
    # below zero: apart from the names that the other hashes got
    return (rows.join(there.join(cut(names), ["h", "b"]).select("rid", "i", "name"), ["rid", "i"])
            .withColumn("name", -1 - F.col("name")))


def name_documents(docs: DataFrame, block: int = BLOCK, hashed=F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: ``rid``, ``doc_id``, ``sha`` (binary), ``n`` blocks, ``name``."""
    texts = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id",
                        normalised(F.col("text")).alias("t"))
    keyed = cut(texts.select("rid", "doc_id", F.unhex(F.sha2("t", 256)).alias("sha"),
                             F.transform(_blocks(F.col("t"), block), lambda b: hashed(b)).alias("hs")))
    names = cut(_named(docs.select(F.explode(_blocks(normalised(F.col("text")), block)).alias("b"))
                       .select(hashed(F.col("b")).alias("h"), "b").distinct(), ["h", "b"])
                .select("h", "name"))
    by_hash = cut(names.groupBy("h").agg(F.min("name").alias("name"), F.count("*").alias("variants")))
    doubtful = by_hash.filter("variants > 1").select("h")

    rows = keyed.select("rid", F.size("hs").alias("n"), F.posexplode("hs").alias("i", "h"))
    named = rows.join(by_hash.filter("variants = 1").select("h", "name"), "h").select("rid", "n", "i", "name")
    if not doubtful.isEmpty():
        rest = _collisions(rows.join(doubtful, "h", "left_semi").drop("h"), texts, block, hashed, doubtful)
        named = named.unionByName(rest.select("rid", "n", "i", "name"))

    named = cut(named)
    longest = named.agg(F.max("n")).first()[0] or 1
    done, level = named.filter("n = 1"), named.filter("n > 1")
    while longest > 1:
        half = F.col("i") % 2
        pairs = cut(level.groupBy("rid", "n", F.floor(F.col("i") / 2).alias("i"))
                    .agg(F.max(F.when(half == 0, F.col("name"))).alias("a"),
                         F.coalesce(F.max(F.when(half == 1, F.col("name"))), F.lit(-1 << 62)).alias("b")))
        pair_names = cut(_named(pairs.select("a", "b").distinct(), ["a", "b"]))
        level = cut(pairs.join(pair_names, ["a", "b"]).select("rid", "n", "i", "name"))
        longest = (longest + 1) // 2
    return keyed.select("rid", "doc_id", "sha").join(done.unionByName(level).drop("i"), "rid")


def exact_duplicates(docs: DataFrame, block: int = BLOCK, hashed=F.xxhash64) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row."""
    named = cut(name_documents(docs, block, hashed))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first")
    # written, so that the join below meets plain rows on both sides and a hot group can be split
    groups = cut(named.groupBy("n", "name").agg(first, F.count("*").alias("group_size")))
    return named.join(groups, ["n", "name"]).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("first.rid")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
