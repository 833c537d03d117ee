"""Entity-attribute-value tables stored bucketed and sorted by their entity.

The pivots and the joins of an entity with its attributes all group by the entity's key.  Stored
in buckets of that key, each bucket one sorted file, a table gives them rows that are already
where and in the order they need: a pivot is then a scan and one streaming aggregate, without
an exchange and without a sort, however many marts read it.  The shuffle is paid once, when the
table lands.

``buckets`` is the number of tasks that will scan the table; at 100 TB choose it so that a
bucket is some hundred MB.  A key with a third of all rows makes one large bucket: a streaming
aggregate passes it in constant memory, and its attributes are folded there, but the scan of
that bucket is one task.  Keys here are ids of single orders, items or users, which hold a few
dozen attributes each.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from martlane.session import shuffles_freed
from martlane.sources.files import file_system

STORE = "source_store"
#: Entity keys of the shop tables.
BUCKET_KEYS = {
    "order_posts": ["ID", STORE], "order_meta": ["post_id", STORE],
    "_items": ["order_item_id", STORE], "order_items": ["order_item_id", STORE], "item_meta": ["order_item_id", STORE],
    "users": ["ID", STORE], "user_meta": ["user_id", STORE],
    "product_posts": ["ID"], "product_meta": ["post_id"], "store_product_lookup": ["product_id", STORE],
}
#: Attribute rows repeat their entity's key and are by far the most: packed tighter than others,
#: whose size on disk tells Spark what it may broadcast.
ATTRIBUTE_CODEC = "zstd"
#: Attribute tables, and what has one row for each item.
ATTRIBUTE_PARTS = {"order_meta", "item_meta", "user_meta", "product_meta", "_items", "order_items"}
#: Without it Spark sorts a bucket that is one sorted file again.
KEEP_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"
#: With it Spark reads a table dealt already by splits of files, not by buckets, to write it again.
AUTO_SCAN = "spark.sql.sources.bucketing.autoBucketedScan.enabled"


def store_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int | None = None,
                   unpivot=None) -> DataFrame:
    """Store ``df`` under ``path`` as a catalog table in buckets of ``keys``, and read it.

    Rows are dealt to tasks by the same hash as to buckets, so each bucket is one file.  ``unpivot``
    makes attribute rows of entity rows once these are dealt and in order: a fraction of the rows
    is shuffled and sorted, and none if they lie in such buckets already.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(n, *keys).sortWithinPartitions(*keys)
    writer = (unpivot(dealt) if unpivot else dealt).write.bucketBy(n, *keys).sortBy(*keys)
    if name in ATTRIBUTE_PARTS:
        writer = writer.option("compression", ATTRIBUTE_CODEC)
    spark.conf.set(KEEP_ORDER, "true")
    auto = spark.conf.get(AUTO_SCAN)
    spark.conf.set(AUTO_SCAN, "false")
    try:
        with shuffles_freed(spark):
            writer.option("path", path).format("parquet").saveAsTable(table)
    finally:
        spark.conf.set(AUTO_SCAN, auto)
    return spark.table(table)


def plain_table(sources, name: str) -> DataFrame:
    """A source table as the sources have it without dealing it into buckets."""
    return sources.plain(name) if hasattr(type(sources), "plain") else getattr(sources, name)


class BucketedSources:
    """Source tables of which those in ``BUCKET_KEYS`` are stored in buckets at their first use.

    Landed extracts lie as they came; a refresh reads the attribute tables several times (items,
    orders, order items, customers), so it deals them out once and pivots without a shuffle.
    """

    def __init__(self, sources, root: str, buckets: int | None = None):
        self.sources, self.root, self.buckets = sources, root.rstrip("/"), buckets
        self._stored: dict[str, DataFrame] = {}

    def __getattr__(self, name: str):
        if name not in BUCKET_KEYS:
            return getattr(self.sources, name)
        if name not in self._stored:
            self._stored[name] = store_bucketed(getattr(self.sources, name), name, f"{self.root}/{name}_{uuid.uuid4().hex}",
                                                BUCKET_KEYS[name], self.buckets)
        return self._stored[name]

    def plain(self, name: str) -> DataFrame:
        """The table in its buckets if a plan had it dealt, else as it landed."""
        return self._stored[name] if name in self._stored else plain_table(self.sources, name)

    def forget(self) -> None:
        """Drop what was stored: the next use reads the sources anew."""
        for table in self._stored.values():
            for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
                fs, path = file_system(table.sparkSession, folder)
                fs.delete(path, True)
        self._stored.clear()
