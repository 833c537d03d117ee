"""Session construction and lineage-cut helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Hot groups are pre-aggregated map-side; AQE splits what still skews a join.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# What the marts' plans ask of any session, set on it where it leaves them unset.
PLAN_CONF = {
    # HotSpot never compiles a method beyond 8000 bytes: a stage whose expressions make a longer
    # one runs faster without whole-stage code, as many short methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Rows that lie in the order of their groups are folded by one streaming aggregate.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}


#: With it the shuffle files of a write are removed when it ends (``shuffles_freed``).
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Cluster sizing (applied only where the cluster config leaves them unset): start wide
# and let AQE coalesce shuffle partitions toward the advisory size; the skew rule splits
# partitions far above it.  At 100 TB a shuffle of ~10 TB lands near 300 MB/partition.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32768",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def get_spark(master: str | None = None, app: str = "martlane",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and skew handling switched on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor; small input splits keep all
        # cores busy on the small test tables (the cluster branch below uses 256 MB)
        conf["spark.driver.memory"] = "8g"
        conf.setdefault("spark.sql.files.maxPartitionBytes", "4m")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if not (master or spark.sparkContext.master).startswith("local"):
        for k, v in CLUSTER_CONF.items():
            if spark.conf.get(k, None) in (None, ""):
                spark.conf.set(k, v)
    plan_settings(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def plan_settings(spark: SparkSession) -> None:
    """Set ``PLAN_CONF`` on a session, whoever made it."""
    for k, v in PLAN_CONF.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    (local runs, tests) a private scratch folder is created and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        # on a cluster a machine-local folder would lose checkpoints with the executor
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    local = tempfile.mkdtemp(prefix="martlane-ckpt-")
    try:
        spark.conf.set("spark.checkpoint.dir", local)
    except Exception:  # noqa: BLE001 - some sessions reject core-conf changes at runtime
        pass
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files: they go when the write ends, not when the
    driver happens to collect its garbage.

    For writes only, whose plan runs once.  The frames that a query returns are made outside and
    keep theirs, so they can be run again.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def stage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it from there.

    Unlike a checkpoint the plan runs once, columns are pruned when it is read again, and what
    an ``observe`` on it counts is counted once.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/stages/{uuid.uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete what ``stage`` wrote; ``df`` is not read any more."""
    from martlane.sources.files import file_system
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        fs, path = file_system(df.sparkSession, folder)
        if "/stages/" in folder:
            fs.delete(path, True)
