"""License scan with ordered signature rules, in DataFrame functions only.

A text is lower-cased (A-Z) and reduced to its words with single spaces.  The words that are
some rule's keyword are collected once; only rules whose keyword is there run their pattern
(``license_rules``).  Detections are word intervals.  They are ordered by start, then the
longer first, then by priority, then by the rule's place; a detection inside an earlier one
of the same or a better priority is dropped, so ``apache license version 2 0`` (priority 1)
suppresses ``apache license`` inside it, and a vague phrase around a title does not suppress
the title.  All of this stays in the row: no shuffle, and a hot source is no hot key.

The base phrases (``BASE``) are counted apart from the rules, at all their places, and their
labels are never suppressed.

Cases: a null or empty text has no words and no labels; rows are scanned one by one, so ties,
repeated rows and empty tables need no care; other columns are passed on untouched.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlane.llm.license_rules import BASE, RULES

#: How sure a detection of each priority is.
SCORE = {1: 1.0, 2: 0.9, 3: 0.5}
MARK = "\x01"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def padded_words(text: Column) -> Column:
    """The words with one space between them and at both ends; one space if there is none."""
    text = F.coalesce(text, F.lit(""))
    # lower() also changes other letters, so it is for texts of ASCII only
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.concat(F.lit(" "), F.ltrim(F.regexp_replace(F.concat(low, F.lit(" ")), NO_WORD, " ")))


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _bounded(pattern: str) -> str:
    return f"(?<= )(?:{pattern})(?= )"


def _base(words: Column) -> list[Column]:
    any_base = F.lit(_bounded("|".join(BASE)))
    places = F.regexp_extract_all(words, any_base, F.lit(0))
    pieces = F.split(words, any_base, -1)
    n = F.size(places)
    last = F.element_at(places, -1)
    first_word = F.when(n > 0, _spaces(F.get(pieces, F.lit(0))) - 1)
    last_word = F.when(n > 0, (_spaces(words) - 1) - (_spaces(F.element_at(pieces, -1)) - 1) - (_spaces(last) + 1))
    labels = F.filter(F.array(*[F.when(F.contains(words, F.lit(f" {phrase} ")), F.lit(label))
                                for phrase, label in BASE.items()]), lambda x: x.isNotNull())
    some = F.contains(words, F.lit("license "))
    return [F.when(some, n).otherwise(0).cast("long").alias("__n_base"),
            F.when(some, first_word).alias("__first_word"), F.when(some, last_word).alias("__last_word"),
            labels.alias("__base_labels")]


def _intervals(words: Column, rule: Column) -> Column:
    """Word intervals of a rule's matches.  A mark, which no word holds, is put before each
    match, so one pass over the words gives all the starts."""
    found = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
    marked = F.split(F.regexp_replace(words, rule["pattern"], F.lit(f"{MARK}$0")), " ", -1)
    starts = F.filter(F.transform(marked, lambda w, i: F.when(F.startswith(w, F.lit(MARK)), (i - 1).cast("long"))),
                      lambda i: i.isNotNull())
    return F.when(F.size(found) > 0, F.zip_with(starts, found, lambda start, m: F.struct(
        start.alias("start"), (-start - _spaces(m)).alias("minus_end"), rule["priority"].alias("priority"),
        rule["place"].alias("place"), rule["label"].alias("label")))).otherwise(
        F.expr("cast(array() as array<struct<start:long,minus_end:long,priority:int,place:int,label:string>>)"))


def _kept(ordered: Column) -> Column:
    """Drop what lies inside an earlier detection of the same or a better priority."""
    none = F.lit(-1).cast("long")
    start = F.struct(none.alias("r1"), none.alias("r2"), none.alias("r3"),
                     F.expr("cast(array() as array<struct<label:string,start:long,end:long,priority:int>>)").alias("kept"))

    def step(acc: Column, d: Column) -> Column:
        end = -d["minus_end"]
        reach = F.when(d["priority"] == 1, acc["r1"]).when(
            d["priority"] == 2, F.greatest(acc["r1"], acc["r2"])).otherwise(F.greatest(acc["r1"], acc["r2"], acc["r3"]))
        own = F.array(F.struct(d["label"].alias("label"), d["start"].alias("start"), end.alias("end"),
                               d["priority"].alias("priority")))
        reached = [F.when(d["priority"] == p, F.greatest(acc[f"r{p}"], end)).otherwise(acc[f"r{p}"]).alias(f"r{p}")
                   for p in (1, 2, 3)]
        return F.struct(*reached, F.when(reach >= end, acc["kept"]).otherwise(F.concat(acc["kept"], own)).alias("kept"))

    return F.aggregate(ordered, start, step, lambda acc: acc["kept"])


def scan(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` and ``__n_words``, ``__n_base``, ``__first_word``, ``__last_word``,
    ``__base_labels`` (array), ``__detections`` (array of label, start, end, priority; words
    from 0, the end included), ``__labels`` (array, distinct and sorted) and ``__score``."""
    rules = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(keyword).alias("keyword"),
                               F.lit(_bounded(pattern)).alias("pattern"), F.lit(priority).alias("priority"),
                               F.lit(place).alias("place"))
                      for place, (label, keyword, pattern, priority) in enumerate(RULES)])
    keywords = F.array(*map(F.lit, sorted({r[1] for r in RULES})))
    words = F.col("__words")
    there = F.array_intersect(F.split(words, " "), keywords)
    run = F.filter(rules, lambda r: F.array_contains(F.col("__there"), r["keyword"]))
    found = F.array_sort(F.flatten(F.transform(F.col("__run"), lambda r: _intervals(words, r))))
    scored = docs.withColumn("__words", padded_words(F.col("text"))).withColumn("__there", there)
    scored = scored.withColumn("__run", F.when(F.size("__there") > 0, run)).select(
        *docs.columns, (_spaces(words) - 1).alias("__n_words"), *_base(words),
        F.when(F.size("__there") > 0, _kept(found)).alias("__detections"))
    scored = scored.withColumn("__detections", F.coalesce(
        "__detections", F.expr("cast(array() as array<struct<label:string,start:long,end:long,priority:int>>)")))
    best = F.array_min(F.transform(F.col("__detections"), lambda d: d["priority"]))
    sure = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in SCORE.items() for x in kv]), best), F.lit(0.0))
    return (scored.withColumn("__labels", F.array_sort(F.array_union(
                "__base_labels", F.transform(F.col("__detections"), lambda d: d["label"]))))
            .withColumn("__base_labels", F.array_sort("__base_labels"))
            .withColumn("__score", F.greatest(sure, F.when(F.col("__n_base") > 0, SCORE[2]).otherwise(0.0))))
