"""Incremental ads ingest with Structured Streaming.

Landed API documents (``{"data": [...]}`` JSON files) are a file stream; each
micro-batch is flattened and upserted into the advertisements table with
``foreachBatch``.  ``trigger(availableNow=True)`` processes what has landed and stops,
which is the scheduled-batch form of the source's two-hourly run.  The stream's
checkpoint sits in the shared checkpoint folder, so a rerun skips files already applied;
the upsert is idempotent, so a micro-batch replayed after a failure is harmless.

The table is stored partitioned by ``date_start``: each micro-batch reads and rewrites
only the days it touches (``apply_ads_batch``: partition pruning + dynamic partition
overwrite), never the whole history.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane import schemas as S
from martlane.operators.load import FAIL
from martlane.plans.ads import ADS_KEYS, ADS_TABLE, apply_ads_batch, flatten_ads
from martlane.plans.ads_documents import parse_documents, records, rejects
from martlane.session import checkpoint_dir, stage, unstage

#: What Spark's reader of whole files gives.
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def read_ads_table(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.schema(ADS_TABLE).parquet(table_path)


def land_api_pages(records: DataFrame, landing_dir: str, page_size: int = 500) -> None:
    """Write ads records as API-like documents ``{"data": [...]}``, one per line, at most
    ``page_size`` records each (pages keyed by day and position, no unbounded group)."""
    fields = [c for c in records.columns if c != "position"]
    page = F.floor(F.col("position") / page_size)
    docs = records.groupBy("date_start", page.alias("_page")).agg(
        F.collect_list(F.struct(*fields)).alias("data"))
    docs.select("data").write.mode("overwrite").json(landing_dir)


def _json_lines(spark: SparkSession, landing_dir: str) -> DataFrame:
    """A file stream of JSON lines in the form of binary files, one for each line."""
    lines = spark.readStream.format("text").load(landing_dir)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.length("value").cast("long").alias("length"),
                        F.encode("value", "UTF-8").alias("content"))


def document_stream(spark: SparkSession, landing_dir: str, multi_line: bool = True,
                    files_per_batch: int | None = None) -> DataFrame:
    """Parsed documents (``plans.ads_documents``) of a folder, each file once.  A file without a
    byte gives a stream no row; the batch load reports it."""
    if not multi_line:
        return parse_documents(_json_lines(spark, landing_dir))
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return parse_documents(reader.load(landing_dir))


def park_rejects(documents: DataFrame, folder: str, epoch: int, on_reject: str = FAIL) -> None:
    """Set aside a micro-batch's documents that cannot be read, or fail on the first of them.

    A failed batch is not committed: its files come again when the stream is started anew.  Each
    batch has a folder of its own, so a batch that is repeated writes the same rows again."""
    bad = rejects(documents)
    worst = bad.orderBy("document", "line").first()
    if worst is None:
        return
    if on_reject == FAIL:
        raise ValueError(f"an ads document cannot be read: {worst['document']} ({worst['reason']})")
    bad.write.mode("overwrite").parquet(f"{folder}/batch={epoch}")


def run_ads_stream(spark: SparkSession, landing_dir: str, table_path: str,
                   keys=("ad_name", "date_start"), checkpoint: str | None = None,
                   multi_line: bool = True, on_reject: str = FAIL) -> None:
    """Process every landed file not yet applied, upserting each micro-batch.

    ``multi_line=True``: one JSON document per file (API answers saved as files);
    ``False``: JSON lines, one document per line (``land_api_pages``).  Documents that cannot be
    read fail the stream, or go to ``<table_path>_rejects`` (``on_reject="quarantine"``).
    """
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "ads_stream")

    def apply(batch: DataFrame, epoch: int) -> None:
        documents = stage(batch)
        park_rejects(documents, f"{table_path}_rejects", epoch, on_reject)
        apply_ads_batch(batch.sparkSession, table_path, flatten_ads(records(documents)), keys=list(keys))
        unstage(documents)

    q = (document_stream(spark, landing_dir, multi_line).writeStream.foreachBatch(apply)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()


def run_first_wins_stream(spark: SparkSession, landing_dir: str, out: str, checkpoint: str, keys=ADS_KEYS,
                          delay: str = "3 days", files_per_batch: int | None = None, multi_line: bool = True,
                          on_reject: str = FAIL) -> dict[str, int]:
    """Land the first row of each key, over all micro-batches, once its day is closed.

    The rows of a key meet in Spark's own state (a streaming ``min_by`` of their place), so no
    stored day is read again.  A day is closed, its rows are written and their state is dropped,
    when ``delay`` has passed in event time (``date_start``): a repeated row within it is known
    as one, however many batches later it comes, and a row that is later than that is dropped
    and counted.  State so holds the keys of the open days only.  Rows without a day or another
    part of the key are no rows of any day and go to ``<out>_unkeyed``.  Each batch writes a folder
    of its own.  Returns the number of ``batches`` and of rows ``too_late``.
    """
    parsed = document_stream(spark, landing_dir, multi_line, files_per_batch)
    flat = flatten_ads(records(parsed))
    rest = [c for c in S.ADS_COLUMNS if c not in keys]
    first = (flat.filter(" and ".join(f"{k} is not null" for k in keys))
             .withColumn("day", F.col("date_start").cast("timestamp")).withWatermark("day", delay)
             .groupBy("day", *keys).agg(F.min_by(F.struct(*rest), "position").alias("first"))
             .select(*keys, "first.*").select(*S.ADS_COLUMNS))

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    def aside(batch: DataFrame, epoch: int) -> None:
        documents = stage(batch)
        park_rejects(documents, f"{out}_rejects", epoch, on_reject)
        loose = flatten_ads(records(documents)).filter(" or ".join(f"{k} is null" for k in keys)).drop("position")
        loose.write.mode("overwrite").parquet(f"{out}_unkeyed/batch={epoch}")
        unstage(documents)

    # documents are looked over before their rows are, so that a bad one fails before any write
    for query, sink, name in ((parsed, aside, "documents"), (first, write, "rows")):
        q = (query.writeStream.foreachBatch(sink).option("checkpointLocation", f"{checkpoint}/{name}")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    steps = q.recentProgress
    return {"batches": len(steps), "too_late": sum(o["numRowsDroppedByWatermark"] for s in steps for o in s["stateOperators"])}
