"""A table kept by day: its published state names one folder for each day.

A load replaces the days it touches and nothing else.  It writes them to folders of their own,
then a new list of days (the old one with these days' entries replaced), and last moves the
pointer file to that list.  A reader follows the pointer once and so sees one state, before the
load or after it; a load that fails leaves the old one.  What a load writes is its own days and
the list (a row for each day), so it does not grow with the rows of the history.

Each entry also carries the day's row count and its high-water mark, so both are known
without a scan of the data.  Folders that neither the current list nor the one before it names
are removed.  One loader at a time; readers any time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlane.sources.files import exists, file_system, replace_file

PREFIX = "days-"


def pointer(spark: SparkSession, path: str) -> list[str]:
    """Lines of a table's pointer file; none if nothing was published."""
    file = f"{path}/CURRENT"
    return spark.read.text(file, wholetext=True).first()[0].splitlines() if exists(spark, file) else []


class DayTable:
    """``schema`` is that of the rows, ``day`` their day column (a date), ``mark`` the date
    column whose maximum is kept for each day."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, day: str, mark: str | None = None):
        self.spark, self.path, self.schema, self.day = spark, path.rstrip("/"), schema, day
        self.mark = mark or day
        self.entries = T.StructType([
            T.StructField("day", T.DateType()), T.StructField("folder", T.StringType(), False),
            T.StructField("rows", T.LongType(), False), T.StructField("mark", T.DateType())])

    @classmethod
    def published(cls, spark: SparkSession, path: str) -> DayTable:
        """The table as its pointer describes it."""
        _, _, day, mark, schema = pointer(spark, path)
        return cls(spark, path, T.StructType.fromJson(json.loads(schema)), day, mark)

    def _list(self, version: str) -> DataFrame:
        return self.spark.read.schema(self.entries).parquet(f"{self.path}/lists/{version}")

    def days(self) -> DataFrame:
        """``day, folder, rows, mark`` of the published state: a row for each day."""
        lines = pointer(self.spark, self.path)
        return self._list(lines[0]) if lines else self.spark.createDataFrame([], self.entries)

    def read(self, days: DataFrame | None = None) -> DataFrame:
        """The rows of the published state, or of the given ``days`` (a ``day`` column) only."""
        wanted = self.days()
        if days is not None:
            only = days.select(F.col("day").alias("_day"))
            wanted = wanted.join(only, wanted["day"].eqNullSafe(only["_day"]), "left_semi")
        # the list has a row for each day, and Spark's own listing holds the files of each
        folders = [r["folder"] for r in wanted.select("folder").collect()]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        base = f"{self.path}/data"
        return (self.spark.read.schema(self.schema).option("basePath", base)
                .parquet(*[f"{base}/{f}" for f in folders]).select(*self.schema.names))

    def replace(self, rows: DataFrame) -> int:
        """Publish ``rows`` as the whole content of the days they lie in; the number of days."""
        spark, version = self.spark, PREFIX + uuid.uuid4().hex
        written = f"{self.path}/data/version={version}"
        rows.select(*self.schema.names).write.partitionBy(self.day).parquet(written)
        fresh = spark.read.schema(self.schema).parquet(written)
        folder = F.concat(F.lit(f"version={version}/{self.day}="),
                          F.coalesce(F.col("day").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
        new = (fresh.groupBy(F.col(self.day).alias("day")).agg(F.count("*").alias("rows"), F.max(self.mark).alias("mark"))
               .select("day", folder.alias("folder"), "rows", "mark"))
        lines = pointer(spark, self.path)
        if lines:
            old = self._list(lines[0])
            new_days = new.select(F.col("day").alias("_day"))
            new = old.join(new_days, old["day"].eqNullSafe(new_days["_day"]), "left_anti").unionByName(new)
        new.coalesce(1).write.parquet(f"{self.path}/lists/{version}")
        before = lines[0] if lines else ""
        replace_file(spark, f"{self.path}/CURRENT", "\n".join([version, before, self.day, self.mark, self.schema.json()]))
        if lines and lines[1]:
            self._drop(lines[1], [before, version])
        return self._list(version).filter(F.col("folder").startswith(f"version={version}/")).count()

    def _drop(self, gone: str, kept: list[str]) -> None:
        """Remove a list, and the folders that only it names."""
        fs, _ = file_system(self.spark, self.path)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        still = self._list(kept[0]).select("folder").unionByName(self._list(kept[1]).select("folder"))
        for r in self._list(gone).select("folder").join(still, "folder", "left_anti").collect():
            fs.delete(path(f"{self.path}/data/{r['folder']}"), True)
        fs.delete(path(f"{self.path}/lists/{gone}"), True)
