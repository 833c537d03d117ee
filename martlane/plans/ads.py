"""Ads insights: read landed API JSON, flatten, plan the incremental window, upsert.

The source fetches monthly chunks from an HTTP API; here the API answers are files
landed in storage (one JSON document ``{"data": [...]}`` per chunk), read in parallel.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlane import schemas as S
from martlane.operators.merge import upsert
from martlane.sources.daily import DayTable

ADS_KEYS = ["ad_name", "date_start"]           # unique key of the table as deployed
ADS_KEYS_WITH_CAMPAIGN = ["campaign_name", "ad_name", "date_start"]
ADS_UPDATE = ["impressions", "clicks", "spend", "cpc", "purchase_roas", "date_stop"]
CPC = T.DecimalType(10, 4)
ROAS = T.DecimalType(10, 4)
#: The stored table's columns and types.
ADS_TABLE = T.StructType([
    T.StructField("campaign_name", T.StringType()), T.StructField("ad_name", T.StringType()),
    T.StructField("adset_name", T.StringType()), T.StructField("impressions", T.IntegerType()),
    T.StructField("clicks", T.IntegerType()), T.StructField("spend", S.MONEY),
    T.StructField("cpc", CPC), T.StructField("purchase_roas", ROAS),
    T.StructField("date_start", T.DateType()), T.StructField("date_stop", T.DateType())])


def read_ads_json(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """API documents -> one row per record; missing ``data`` and null entries tolerated.

    A document that cannot be parsed gives no row here; loads use ``ads_documents`` instead, which
    says what became of each.

    ``position`` keeps the record order (file, then index) for first-row-wins dedupe.
    """
    df = (spark.read.schema(S.ADS_JSON_SCHEMA).option("multiLine", True).json(paths)
               .withColumn("_file", F.input_file_name()))
    rec = df.select("_file", F.posexplode_outer("data").alias("_i", "r")).filter(F.col("r").isNotNull())
    return rec.select("r.*", F.struct(F.col("_file"), F.col("_i")).alias("position"))


def roas_value(c) -> Column:
    """``purchase_roas[0].value // 0`` (empty or missing array -> '0')."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.get(c, 0).getField("value"), F.lit("0"))


def flatten_ads(records: DataFrame) -> DataFrame:
    """Records -> advertisements columns with the table's types."""
    pos = [F.col("position")] if "position" in records.columns else []
    return records.select(
        "campaign_name", "ad_name", "adset_name",
        F.col("impressions").try_cast("int").alias("impressions"),
        F.col("clicks").try_cast("int").alias("clicks"),
        F.col("spend").try_cast(S.MONEY).alias("spend"),
        F.col("cpc").try_cast(CPC).alias("cpc"),
        roas_value("purchase_roas").try_cast(ROAS).alias("purchase_roas"),
        F.col("date_start").try_cast("date").alias("date_start"),
        F.col("date_stop").try_cast("date").alias("date_stop"),
        *pos)


def upsert_ads(target: DataFrame | None, batch: DataFrame, keys=ADS_KEYS) -> DataFrame:
    """INSERT ... ON DUPLICATE KEY UPDATE of the six measures; first batch row per key wins;
    campaign and ad set names of an existing row are kept."""
    order = "position" if "position" in batch.columns else None
    b = batch
    if target is not None and "position" in target.columns:
        target = target.drop("position")
    return upsert(target, b, list(keys), ADS_UPDATE, order_col=order)


def ads_window_chunks(ads: DataFrame, today: dt.date,
                      lookback_days: int = S.ADS_LOOKBACK_DAYS) -> DataFrame:
    """The next load's month chunks as a DataFrame (chunk_start, chunk_end), all in Spark.

    since = high-water mark + 1 day, or today - lookback when there is no mark or it is
    at/after today; chunk starts are since, +1 month, +1 month ... (iterated, clipped at
    month ends), each chunk ends the day before the next start, the last one at today.
    """
    t = F.lit(today).cast("date")
    last = ads.agg(F.max(F.col("date_stop").cast("date")).alias("last"))
    since = F.when(F.col("last").isNull() | (F.col("last") >= t), F.date_sub(t, lookback_days)) \
             .otherwise(F.date_add(F.col("last"), 1))
    w = last.select(since.alias("since"))
    n = (F.months_between(t, F.col("since")).cast("int") + 2)
    starts = F.transform(F.sequence(F.lit(0), n),
                         lambda k: F.aggregate(F.array_repeat(F.lit(1), k), F.col("since"),
                                               lambda acc, _x: F.add_months(acc, 1)))
    e = w.select(F.explode(starts).alias("chunk_start")).filter(F.col("chunk_start") <= t)
    return e.select("chunk_start",
                    F.least(F.date_sub(F.add_months("chunk_start", 1), 1), t).alias("chunk_end"))


def stored_ads(spark: SparkSession, table_path: str) -> DataFrame | None:
    """The stored ads table, None if its path does not exist.

    The path is resolved by Spark's own file system layer, whatever way it is spelled.  Only
    a path that is not there means "no table yet"; any other failure is raised.
    """
    try:
        return spark.read.schema(ADS_TABLE).parquet(table_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def apply_ads_batch(spark: SparkSession, table_path: str, batch: DataFrame,
                    keys=ADS_KEYS, partition_col: str = "date_start") -> int:
    """Upsert a batch into the ads table stored partitioned by ``date_start``.

    Only the days the batch touches are rewritten (dynamic partition overwrite, set on this
    write alone); the rest of the history is untouched.  The batch's first and last day
    prune the read; within them a null-safe semi join keeps the touched days, so rows
    without a date are merged like those of any other day.  The merged days are
    checkpointed before the write, so the job does not read the path it overwrites and a
    lost executor re-reads the checkpoint.  Returns the number of rewritten days.
    """
    from martlane.session import cut_lineage
    if partition_col not in keys:
        raise ValueError("the partition column must be part of the key")
    days = cut_lineage(batch.select(partition_col).distinct())
    day = F.col(partition_col)
    n_days, first, last, blank = days.agg(F.count("*"), F.min(day), F.max(day),
                                          F.max(day.isNull())).first()
    if not n_days:
        return 0
    target = stored_ads(spark, table_path)
    if target is not None:
        near = day.between(first, last) if first is not None else F.lit(False)
        there = days.withColumnRenamed(partition_col, "_day")
        target = (target.filter((near | day.isNull()) if blank else near)
                        .join(there, day.eqNullSafe(F.col("_day")), "left_semi"))
        target = target.select(*S.ADS_COLUMNS)
    merged = cut_lineage(upsert_ads(target, batch, keys=keys).select(*S.ADS_COLUMNS))
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(partition_col).parquet(table_path))
    return n_days


#: The ads mart: the table's columns, and when a row was first loaded.
ADS_MART = T.StructType([*ADS_TABLE.fields, T.StructField("created_at", T.TimestampNTZType())])


def ads_mart(spark: SparkSession, path: str) -> DayTable:
    """The ads mart kept by ``date_start``; its mark is the last ``date_stop``."""
    return DayTable(spark, path, ADS_MART, "date_start", "date_stop")


def load_ads(table: DayTable, batch: DataFrame, now=None, keys=ADS_KEYS) -> int:
    """Upsert a flattened batch into the mart: only the days it touches are read and written.

    Rows that are there keep their ``created_at``; ``now`` (a timestamp column) is that of new
    ones.  Returns the number of days written.
    """
    from martlane.session import stage, unstage
    if table.day not in keys:
        raise ValueError("the day must be part of the key")
    batch = stage(batch.withColumn("created_at", F.localtimestamp() if now is None else now))
    days = batch.select(F.col(table.day).alias("day")).distinct()
    merged = upsert_ads(table.read(days), batch, keys=keys).select(*ADS_MART.names)
    days_written = table.replace(merged)
    unstage(batch)
    return days_written


def high_water_mark(table: DayTable) -> DataFrame:
    """``date_stop`` of the last day loaded, from the mart's list of days: no row is read."""
    return table.days().agg(F.max("mark").alias("date_stop"))
