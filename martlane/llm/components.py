"""Connected components of a graph given as links between longs, in DataFrame joins.

Alternating star contraction: in the large-star step each node sends its larger neighbours
to the smallest node of its neighbourhood, in the small-star step its smaller ones.  When
nothing changes, every node is linked to the smallest node of its component and to nothing
else.  A round is two groupings and two joins over the links.  Both sides of a join are written
tables (the grouping's result is written first), so a node with very many neighbours is one long
list of plain join rows that Spark can split, never a collected list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.llm.common import cut


def _star(links: DataFrame) -> DataFrame:
    """Link every neighbour of ``a`` (column ``b``) and ``a`` itself to the least of them; ``links``
    are written rows."""
    least = cut(links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")))
    return links.join(least, "a")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a`` and ``b``); ``root`` is the
    smallest node that can be reached."""
    links = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = cut(_star(both).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .filter("a <> b").distinct())
        # every link now leads from a larger to a smaller node
        small = _star(large)
        links = cut(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .unionByName(large.groupBy("a").agg(F.min("b").alias("b")))
                    .filter("a <> b").distinct())
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = links.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
