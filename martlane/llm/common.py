"""Helpers shared by the operators: reading tables, cutting lineage, bounding batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from martlane.sources.files import file_system

#: Rows of one Arrow batch: a batch of very long texts must still fit beside the heap.
BATCH_ROWS = 256
#: Tables that ``cut`` wrote.
_CUTS: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session without it (a test) gets a temporary
    folder of its own, on a cluster the missing setting is an error."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-checkpoint-")
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it from there.

    This cuts the lineage: what was computed survives lost executors, is computed once, and
    what it numbered (``monotonically_increasing_id``) keeps its numbers.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _CUTS.append(path)
    return spark.read.schema(df.schema).parquet(path)


def cuts_made() -> int:
    return len(_CUTS)


def settled(make: Callable[[], DataFrame], since: int | None = None) -> DataFrame:
    """The written result of ``make``; the tables that were cut on the way to it, or since there
    were ``since`` cuts, are deleted."""
    start = len(_CUTS) if since is None else since
    out = cut(make())
    spare, _CUTS[start:] = _CUTS[start:-1], _CUTS[-1:]
    for path in spare:
        fs, folder = file_system(out.sparkSession, path)
        fs.delete(folder, True)
    return out


def _set_aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The frame with other names for columns that begin with two underscores, as the operators'
    own do; and the names they have now, with those they had."""
    odd = [c for c in docs.columns if c.startswith("__")]
    names: dict[str, str] = {}
    for c in odd:
        k = len(names)
        while f"aside_{k}" in docs.columns or f"aside_{k}" in names:
            k += 1
        names[f"aside_{k}"] = c
    return docs.withColumnsRenamed({c: n for n, c in names.items()}), names


def _put_back(out: DataFrame, names: dict[str, str]) -> DataFrame:
    hidden = [n for n, c in names.items() if c in out.columns]
    return out.drop(*hidden).withColumnsRenamed({n: c for n, c in names.items() if n not in hidden})


def passes_columns(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator on documents, its first argument, that passes on columns of any name; one that
    has the name of a result column gives way to it."""
    @wraps(operator)
    def run(docs: DataFrame, *args, **kw) -> DataFrame:
        renamed, names = _set_aside(docs)
        return _put_back(operator(renamed, *args, **kw), names) if names else operator(docs, *args, **kw)
    return run


def passes_documents(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage ``(spark, docs, sf_dir)`` of the same kind."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        renamed, names = _set_aside(docs)
        return _put_back(stage(spark, renamed, sf_dir), names) if names else stage(spark, docs, sf_dir)
    return run
