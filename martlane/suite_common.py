"""What the registered queries share: stored source tables, published marts, output types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlane.sources.shop_shape import ShopShapes

ADS_SPLIT_A = "2024-01-21"      # batch A of the upsert: events before this day
ADS_SPLIT_B = "2024-01-16"      # batch B: events from this day on (last 15 days)
ADS_TODAY = "2024-03-15"        # the run date of the next incremental load

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_CACHE: dict = {}
_WH: dict = {}


def _source_key(spark: SparkSession, sf_dir: str) -> tuple:
    """A session and what lies in a data directory just now."""
    from martlane.sources.files import fingerprint
    return id(spark), sf_dir, fingerprint(spark, sf_dir)


def _fresh_root(spark: SparkSession, kind: str) -> str:
    import uuid
    from martlane.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex[:12]}"


def shapes(spark: SparkSession, sf_dir: str) -> ShopShapes:
    """Shop-shaped source tables for ``sf_dir``, each stored at its first use, once for each state
    of its files."""
    from martlane.session import plan_settings
    from martlane.sources.shop_shape import StoredShapes
    plan_settings(spark)
    key = _source_key(spark, sf_dir)
    if key not in _CACHE:
        _CACHE[key] = StoredShapes(spark, sf_dir, _fresh_root(spark, "shop_tables"))
        _widen(spark, _CACHE[key].buckets)
    return _CACHE[key]


def _widen(spark: SparkSession, partitions: int) -> None:
    """Shuffles start as wide as the input asks for, where nothing else is set; those that turn
    out small are coalesced again."""
    if spark.conf.get(INITIAL_PARTITIONS, None) in (None, "") and partitions > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(partitions))


def warehouse(spark: SparkSession, sf_dir: str):
    """Published marts over the shaped sources of ``sf_dir`` (see plans/warehouse.py)."""
    from martlane.plans.warehouse import Warehouse
    key = _source_key(spark, sf_dir)
    if key not in _WH:
        _WH[key] = Warehouse(spark, shapes(spark, sf_dir), _fresh_root(spark, "marts"))
    return _WH[key]


NULLABLE_INTS = {"customer_id", "variation_id", "refund_reference", "stock_qty"}


def as_double(df: DataFrame, nullable_ints=()) -> DataFrame:
    """Decimal columns -> double at the output edge; so are integer columns that hold NULLs
    (``nullable_ints``), which pandas would otherwise render differently per engine."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) or f.name in nullable_ints
                       else F.col(f.name) for f in df.schema.fields])
