"""Corpus pipeline over ``documents``: language ID, line dedup, near-dedup, decontamination,
tokenizing.  Each stage takes (spark, docs, sf_dir) and works on all that the one before kept;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.llm.bpe import encode_documents
from martlane.llm.common import cuts_made, passes_documents, settled, table
from martlane.llm.decontaminate import find_leaks
from martlane.llm.language_id import predict_languages, train
from martlane.llm.line_dedup import drop_repeated_lines
from martlane.llm.queries import vocabulary_path
from martlane.llm.simhash_dedup import one_of_each_group

#: Language ID, near-dedup by XXH64, decontamination and BPE cannot be said in SQL; the tests
#: hold the pipeline against a brute-force version.
ORACLE_SQL = None


@passes_documents
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected, as they were."""
    return predict_languages(docs, train(docs)).filter("not __rejected").select(*docs.columns)


@passes_documents
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stand in many of them; ``n_chars`` follows."""
    out = drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        changed = F.col("__n_dropped") > 0
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


@passes_documents
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest ``doc_id`` of each group."""
    return one_of_each_group(docs)


@passes_documents
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return find_leaks(docs, table(spark, sf_dir, "benchmark")).filter(F.size("__leaks") == 0).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256, exact`` of every document."""
    return encode_documents(docs, vocabulary_path())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage kept is written before the next reads it, and
    what it wrote on the way is deleted then."""
    docs, since = table(spark, sf_dir, "documents"), cuts_made()
    for _, stage in STAGES[:-1]:
        docs = settled(partial(stage, spark, docs, sf_dir), since)
    return STAGES[-1][1](spark, docs, sf_dir)
