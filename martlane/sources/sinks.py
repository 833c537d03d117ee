"""Sinks: published (versioned) tables and on-request exports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from martlane.session import shuffles_freed
from martlane.sources.daily import PREFIX, DayTable, pointer
from martlane.sources.files import file_system, replace_file


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                max_records_per_file: int | None = None, compression: str | None = None) -> None:
    """Overwrite a folder.  Spark deletes the old files first, so a reader may find the table
    missing while this runs or after it failed; ``publish`` is the safe form.
    ``partition_by=["source_store"]`` gives store pruning at rest; ``max_records_per_file``
    bounds file size for a hot store."""
    w = df.write.mode("overwrite")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    with shuffles_freed(df.sparkSession):
        w.parquet(path)


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None, check=None,
            compression: str | None = None) -> DataFrame:
    """Truncate-and-reload that a reader never sees half done; returns the published table.

    The rows go to a new version folder.  ``check`` is called with what was written; only if
    neither it nor the write fails does the pointer file move to the new version, by an
    atomic rename.  The current version and the one before it, which a running reader may still
    scan, stay; older ones are removed.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    write_table(df, f"{path}/versions/{version}", partition_by, compression=compression)
    written = spark.read.schema(df.schema).parquet(f"{path}/versions/{version}").select(*df.columns)
    if check is not None:
        check(written)
    before = current_version(spark, path)
    replace_file(spark, f"{path}/CURRENT", version)
    fs, folder = file_system(spark, f"{path}/versions")
    for status in fs.listStatus(folder):
        if status.getPath().getName() not in (version, before):
            fs.delete(status.getPath(), True)
    return written


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the published version, None if nothing was published yet."""
    lines = pointer(spark, path)
    return lines[0] if lines else None


def read_published(spark: SparkSession, path: str) -> DataFrame:
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table was published at {path}")
    if version.startswith(PREFIX):
        return DayTable.published(spark, path).read()
    return spark.read.parquet(f"{path}/versions/{version}")


def export_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, compression: str | None = None) -> None:
    """Delimited export (TSV with ``sep='\\t'``), quoted where needed, one folder of parts."""
    with shuffles_freed(df.sparkSession):
        (df.write.mode("overwrite").option("sep", sep).option("header", header)
           .option("quote", '"').option("escape", '"').csv(path, compression=compression))


def export_json(df: DataFrame, path: str, compression: str | None = None) -> None:
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").json(path, compression=compression)
