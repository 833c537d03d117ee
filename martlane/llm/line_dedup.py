"""Line dedup with two Bloom filters: once-seen and twice-seen line hashes.

The whole texts are read once for their long lines: a row for each document and line key, with
a 128-bit digest of the key and no text.  The digest's first half is sent to the task that owns
its part of the hash range; a batch of documents sends a digest twice at most.  That task
sets a digest's bits in its *once* filter; one whose bits are set already is suspected to be a
repeat and given back, once: the *twice* filter tells which were not given back yet, and where
it is not sure an exact list of the part's suspects does.  There are as many parts as the
lines need, so that each has about ``LINES_PER_PART`` of them: a filter is sized by its own part, nothing is
broadcast, and no bound changes what happens at size.

Only the lines with a suspected digest are shuffled on, to count their documents exactly and to
choose the document that keeps the line.  A key seen once goes no further than its part, but
for the filters' false positives, which the exact count removes.  Keys are equal if their
128-bit BLAKE2b digests are.

A key is the line without ASCII white space at both ends, A-Z lower-cased; keys of at least
``MIN_POINTS`` code points found in at least ``MIN_DOCUMENTS`` documents lose all their
lines except in the largest ``doc_id`` that holds them.

Nulls and ties: a null text is one empty line.  Every row counts as a document; rows of the
same largest ``doc_id`` all keep the line; a null ``doc_id`` is smaller than any other.
Columns other than ``doc_id`` and ``text`` are kept by ``drop_repeated_lines`` and never
read; one that has a result column's name gives way to it.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.llm.common import cut, passes_columns, small_batches

MIN_POINTS, MIN_DOCUMENTS = 40, 5
#: Lines for which a part's filters are made, and the least number of parts.
LINES_PER_PART, LEAST_PARTS = 1 << 19, 64
BITS_PER_LINE, PROBES = 16, 3
#: Digests that go through the filters together.
TOGETHER = 1 << 14
EDGE = " \t\n\x0b\x0c\r"
UPPER = {c: c + 32 for c in range(0x41, 0x5B)}


def line_key(line: str) -> str:
    line = line.strip(EDGE)
    return line.lower() if line.isascii() else line.translate(UPPER)


def long_keys(text: str | None, points: int) -> dict[str, list[int]]:
    """Each long key of a text with the numbers of its lines."""
    found: dict[str, list[int]] = {}
    for i, line in enumerate((text or "").split("\n")):
        if len(line) >= points and len(key := line_key(line)) >= points:
            found.setdefault(key, []).append(i)
    return found


def digest_of(key: str) -> bytes:
    return hashlib.blake2b(key.encode(), digest_size=16).digest()


def probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions of each hash inside a filter; ``bits`` is a power of two."""
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32)
    steps = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((low + steps * (high | np.uint64(1))) & np.uint64(bits - 1)).astype(np.int64)


class Filters:
    """The once-seen and the twice-seen filter of one part of the hash range."""

    def __init__(self, lines: int):
        self.bits = max(1 << 10, 1 << (max(1, lines) * BITS_PER_LINE - 1).bit_length())
        self.once, self.twice = np.zeros(self.bits, dtype=bool), np.zeros(self.bits, dtype=bool)
        self.given = np.zeros(0, dtype=np.uint64)  # sorted

    def repeats(self, hashes: np.ndarray) -> np.ndarray:
        """The hashes that may have been seen before, now or in an earlier call, and have not been
        given back yet."""
        values, times = np.unique(hashes, return_counts=True)
        at = probes(values, self.bits)
        seen = self.once[at].all(axis=0) | (times > 1)
        self.once[at] = True
        values, at = values[seen], at[:, seen]
        unsure = self.twice[at].all(axis=0)
        new = ~unsure
        if unsure.any():  # given back before, or a false positive of the twice filter
            asked = values[unsure]
            place = np.minimum(np.searchsorted(self.given, asked), len(self.given) - 1)
            new[unsure] = self.given[place] != asked
        values = values[new]
        self.twice[at[:, new]] = True
        self.given = np.sort(np.concatenate([self.given, values]))
        return values


def long_lines(docs: DataFrame, points: int = MIN_POINTS) -> DataFrame:
    """``doc_id, text_hash, h, rest, lines``: the long keys of each document, their digests' two
    halves, and the numbers of their lines."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, digests, lines = [], [], []
            for i, text in enumerate(batch["text"].to_pylist()):
                for key, numbers in long_keys(text, points).items():
                    at.append(i)
                    digests.append(digest_of(key))
                    lines.append(numbers)
            place = pa.array(at, pa.int64())
            halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            # the first of a batch's rows of a key, and the second one, are sent to the filters
            _, first = np.unique(halves[:, 0], return_index=True)
            rest = np.setdiff1d(np.arange(len(at)), first)
            sent = np.zeros(len(at), dtype=bool)
            sent[first] = True
            sent[rest[np.unique(halves[rest, 0], return_index=True)[1]]] = True
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(place), batch["text_hash"].take(place), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                 pa.array(lines, pa.list_(pa.int32())), pa.array(sent)], ["doc_id", "text_hash", "h", "rest", "lines", "sent"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, f"doc_id {kind}, text_hash long, h long, rest long, lines array<int>, sent boolean")


def suspects(lines: DataFrame, lines_per_part: int = LINES_PER_PART, least_parts: int = LEAST_PARTS) -> DataFrame:
    """``h`` of the long lines that may have been seen twice; every one that was is among them."""
    sent = lines.filter("sent").select("h")
    number = sent.count()
    parts = max(least_parts, -(-number // lines_per_part))
    expected = -(-number // parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filters(expected + expected // 4)
        held: list[np.ndarray] = []

        def given() -> pa.RecordBatch:
            found = own.repeats(np.concatenate(held))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["h"])

        for batch in batches:
            held.append(batch["h"].to_numpy().view(np.uint64))
            if sum(map(len, held)) >= TOGETHER:
                yield given()
        if held:
            yield given()

    return sent.repartition(parts, "h").mapInArrow(run, "h long")


def repeated_lines(docs: DataFrame, points: int = MIN_POINTS, documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``doc_id, text_hash, lines``: numbers of the lines that each document loses.

    ``text_hash`` tells apart rows that share a ``doc_id``.
    """
    lines = cut(long_lines(docs, points))
    again = cut(suspects(lines))
    found = cut(lines.drop("sent").join(again, "h", "left_semi"))
    # written, so that the join below meets plain rows on both sides and a hot line can be split
    confirmed = cut(found.groupBy("h", "rest").agg(F.count("*").alias("times"), F.max("doc_id").alias("keeper"))
                    .filter(F.col("times") >= documents).drop("times"))
    return (found.join(confirmed, ["h", "rest"]).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_set("lines")).alias("lines")))


@passes_columns
def drop_repeated_lines(docs: DataFrame, points: int = MIN_POINTS, documents: int = MIN_DOCUMENTS) -> DataFrame:
    """All columns of ``docs`` with the shortened ``text`` (a null text stays null), and the
    counts ``__n_lines`` and ``__n_dropped`` (so named to clash with no column of the table)."""
    lost = repeated_lines(docs, points, documents).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("lines").alias("__lost"))
    hashed = docs.withColumn("__text_hash", F.xxhash64("text"))
    joined = hashed.join(lost, hashed["doc_id"].eqNullSafe(lost["__id"])
                         & (hashed["__text_hash"] == lost["__hash"]), "left")
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__lost"))
    kept = F.when(F.col("__lost").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col("__lines"), i)), "\n"))
    return (joined.withColumn("__lines", lines)
            .withColumn("__n_lines", F.size("__lines").cast("long"))
            .withColumn("__n_dropped", F.when(F.col("__lost").isNull(), 0).otherwise(F.size("__lost")).cast("long"))
            .withColumn("text", kept).select(*docs.columns, "__n_lines", "__n_dropped"))
