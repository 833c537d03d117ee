"""Landed ads API documents: what can be read, what cannot and why, and which are new.

A document is read whole and parsed by an expression, so one that is cut short, empty or no
JSON is a row with an outcome instead of rows that are missing.  A file that holds several
documents one after the other is read as all of them where each stands on a line of its own.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlane import schemas as S

OK, EMPTY, NOT_UTF8, UNREADABLE, WRONG_SHAPE = "ok", "empty", "not UTF-8", "not JSON or cut short", "wrong shape"
CORRUPT = "_corrupt_record"
PARSED = T.StructType([*S.ADS_JSON_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
#: Characters of a rejected document that are kept with it.
SHOWN = 200
#: What was loaded from a folder of documents so far.
LEDGER = T.StructType([
    T.StructField("document", T.StringType(), False), T.StructField("length", T.LongType(), False),
    T.StructField("modified", T.TimestampType(), False)])
REJECTS = T.StructType([
    T.StructField("document", T.StringType()), T.StructField("line", T.IntegerType()), T.StructField("reason", T.StringType()),
    T.StructField("length", T.LongType()), T.StructField("shown", T.StringType())])


def _files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)


def _empty_files(files: DataFrame) -> DataFrame:
    """``document`` of the files without a byte, which Spark lists but never reads."""
    # the listing writes file:///x for what a scan calls file:/x
    names = [(re.sub(r"^([\w+.-]+):///", r"\1:/", unquote(n)),) for n in files.inputFiles()]
    listed = files.sparkSession.createDataFrame(names, "document string")
    return listed.join(files.select(F.col("path").alias("document")), "document", "left_anti")


def list_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``document, length, modified`` of the files; no file is opened.  An empty one has no
    time: it is another document once it has a length."""
    files = _files(spark, paths)
    never = F.timestamp_seconds(F.lit(0)).alias("modified")
    return files.select(F.col("path").alias("document"), "length", F.col("modificationTime").alias("modified")).unionByName(
        _empty_files(files).select("document", F.lit(0).cast("long").alias("length"), never))


def new_documents(listed: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Documents that the ledger does not hold, or not in the state they are in now."""
    return listed if ledger is None else listed.join(ledger, LEDGER.names, "left_anti")


def _one_value(c: Column) -> Column:
    """Whether a text is one JSON value, with nothing before or behind it."""
    return F.coalesce(F.size(F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<string>")), F.lit(0)) == 1


def parse_documents(files: DataFrame) -> DataFrame:
    """``document, line, length, outcome, data, shown`` of binary files (``path, length,
    content``): a row for each document, ``line`` counting those of a file from 0."""
    text = F.col("content").cast("string")
    rows = files.select(F.col("path").alias("document"), "length", F.is_valid_utf8(text).alias("valid"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(" \t\r")) != "")
    # a cut document over many lines stays one: its first line is no document
    many = (F.size("lines") > 1) & _one_value(F.get("lines", 0)) & ~_one_value(F.col("text"))
    rows = rows.withColumn("lines", lines).withColumn("bodies", F.when(many, F.col("lines")).otherwise(F.array("text")))
    parsed = rows.select("document", "length", "valid", F.posexplode("bodies").alias("line", "body")).withColumn(
        "j", F.from_json("body", PARSED, {"columnNameOfCorruptRecord": CORRUPT}))
    outcome = (F.when(~F.col("valid"), NOT_UTF8).when(F.trim(F.col("body"), F.lit(" \t\r\n")) == "", EMPTY)
               .when(~_one_value(F.col("body")), UNREADABLE)
               .when(F.col("j").isNull() | F.col(f"j.{CORRUPT}").isNotNull(), WRONG_SHAPE).otherwise(OK))
    return parsed.select("document", "line", "length", outcome.alias("outcome"), F.col("j.data").alias("data"),
                         F.left("body", F.lit(SHOWN)).alias("shown"))


def read_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Parsed documents of the files of a folder, or of the given ones."""
    files = _files(spark, paths)
    parsed = parse_documents(files)
    none = {f.name: F.lit(None).cast(f.dataType) for f in parsed.schema}
    empty = none | {"document": F.col("document"), "line": F.lit(0), "length": F.lit(0).cast("long"), "outcome": F.lit(EMPTY)}
    return parsed.unionByName(_empty_files(files).select(*[c.alias(name) for name, c in empty.items()]))


def records(documents: DataFrame) -> DataFrame:
    """One row for each record of the documents that could be read; a missing ``data`` and null
    entries are no records.  ``position`` is the record's place (document, line, index)."""
    found = documents.filter(F.col("outcome") == OK).select("document", "line", F.posexplode("data").alias("i", "r"))
    return found.filter(F.col("r").isNotNull()).select("r.*", F.struct("document", "line", "i").alias("position"))


def rejects(documents: DataFrame) -> DataFrame:
    """``document, line, reason, length, shown`` of the documents that could not be read."""
    return documents.filter(F.col("outcome") != OK).select(
        "document", "line", F.col("outcome").alias("reason"), "length", "shown")


def document_counts() -> list[Column]:
    """Aggregates over documents, to be observed while they are written."""
    ok = F.col("outcome") == OK
    return [F.count("*").alias("documents"), F.count_if(~ok).alias("rejects"),
            F.coalesce(F.sum(F.when(ok, F.size(F.filter(F.coalesce("data", F.array()), lambda r: r.isNotNull())))), F.lit(0)).alias("records")]
