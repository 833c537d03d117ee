"""SimHash near-dedup with a hierarchical index in Gray order.

A document's fingerprint has bit i set if bit i is set in over half of its shingle hashes.
Fingerprints within ``MAX_BITS`` differing bits are linked; a group is a connected component.

Only distinct fingerprints are compared.  The 64 bits are cut into ``MAX_BITS + 2`` segments;
two fingerprints that differ in ``MAX_BITS`` bits agree in two segments at least, so every
linked pair meets in one bucket of (pair of segments, their bits).  Inside a bucket the
fingerprints are sorted by Gray rank, which puts similar bit patterns side by side.  Runs of
``FAN`` neighbours become nodes that hold the bits all their members share; an upper node
takes the shared bits of its children out of them, so each bit is tested once on the way
down.  A search adds up the differences from the top and drops a node with all its members
as soon as the sum passes ``MAX_BITS``.  No candidate is left out: buckets and nodes have no
cap.  A bucket of over ``HOT_BUCKET`` members is dealt again by segments of its other bits
(as ``MAX_BITS + 1`` of these hold ``MAX_BITS`` differences, one must agree), so a bit pattern
that very many documents share does not meet in one task.  A bucket gives its linked members
as a star, not as pairs.

Cases: a text that is null or empty or has no word has fingerprint 0, which is linked like
any other; fewer words than a shingle are one shingle.  A null ``doc_id`` is never a
component's id unless all its ids are null.  Rows are not merged: repeated rows give repeated
results.  Columns other than ``doc_id`` and ``text`` are not read by ``near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlane.llm.common import cut, passes_columns, small_batches
from martlane.llm.components import components

SHINGLE, MAX_BITS, SEED = 4, 4, 42
FAN, HOT_BUCKET = 8, 50_000
#: Shingles whose bits are counted at once; queries that go down the index together.
COUNT_AT_ONCE, QUERIES_AT_ONCE, PAIRS_AT_ONCE = 1 << 15, 64, 1 << 20


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    body = b" ".join((text or "").encode().lower().split())  # of bytes, these know ASCII only
    if not body:
        return 0
    gaps = np.flatnonzero(np.frombuffer(body, dtype=np.uint8) == 32)
    n = max(1, len(gaps) + 2 - shingle)
    starts = [0, *(gaps[:n - 1] + 1).tolist()]
    ends = [*gaps[shingle - 1:].tolist(), len(body)]
    ones, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, COUNT_AT_ONCE):
        cut_to = slice(at, at + COUNT_AT_ONCE)
        h = np.array([digest(body[s:e], SEED) for s, e in zip(starts[cut_to], ends[cut_to], strict=True)], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


@passes_columns
def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """All columns of ``docs`` but ``text``, and ``__fp`` (the fingerprint's bits as a long)."""
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, shingle) for t in batch["text"].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(fp.view(np.int64))], [*kept, "__fp"])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in kept)
    return docs.mapInArrow(run, f"{kinds}__fp long")


def segments(bits: list[int], parts: int) -> list[int]:
    """Masks that deal the bits to ``parts`` runs of about the same length."""
    edges = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(edges, edges[1:])]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def bucket_masks(max_bits: int = MAX_BITS) -> list[int]:
    return [a | b for a, b in combinations(segments(list(range(64)), max_bits + 2), 2)]


def _dealt(rows: DataFrame, masks: list[tuple[int, int]], only: Column | None = None) -> DataFrame:
    choices = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(signed(m)).alias("mask")) for k, m in masks]))
    return rows.withColumn("x", choices).select(
        F.col("x.k").alias("kind"), F.col("fp").bitwiseAND(F.col("x.mask")).alias("key"), "fp")


def buckets(fps: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT_BUCKET) -> DataFrame:
    """``kind, key, fp``: every bucket that a fingerprint belongs to."""
    masks = bucket_masks(max_bits)
    rows = _dealt(fps, list(enumerate(masks)))
    large = cut(rows.groupBy("kind", "key").count().filter(F.col("count") > hot).select("kind", "key"))
    if large.isEmpty():
        return rows
    again = []
    for kind, mask in enumerate(masks):
        rest = segments([b for b in range(64) if not mask >> b & 1], max_bits + 1)
        inside = rows.join(large.filter(F.col("kind") == kind), ["kind", "key"], "left_semi").select("fp")
        again.append(_dealt(inside, [(len(masks) * (j + 1) + kind, mask | r) for j, r in enumerate(rest)]))
    rows = rows.join(large, ["kind", "key"], "left_anti")
    for more in again:
        rows = rows.unionByName(more)
    return rows


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of each bit pattern in the reflected Gray code."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp ^ (fp >> np.uint64(shift))
    return fp


class GrayIndex:
    """Fingerprints in Gray order under nodes of ``FAN`` children; ``levels`` from the top.

    Each level holds per node the shared pattern and the mask of the bits that are tested
    there: those shared by all members and not already tested by the parent.
    """

    def __init__(self, fps: np.ndarray):
        self.fps = fps[np.argsort(gray_rank(fps), kind="stable")]
        ones = zeros = self.fps
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        shared, patterns = [np.full(len(ones), full)], [self.fps]
        while len(ones) > FAN:
            at = np.arange(0, len(ones), FAN)
            ones, zeros = np.bitwise_and.reduceat(ones, at), np.bitwise_or.reduceat(zeros, at)
            shared.append(~(ones ^ zeros))
            patterns.append(ones)
        self.levels = []
        for depth in range(len(shared) - 1, -1, -1):
            mask = shared[depth]
            if depth + 1 < len(shared):
                mask = mask & ~np.repeat(shared[depth + 1], FAN)[:len(mask)]
            self.levels.append((patterns[depth], mask))

    def links(self, lo: int, hi: int, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs ``i < j`` within ``max_bits``, for i in ``[lo, hi)``."""
        pattern, mask = self.levels[0]
        i = np.repeat(np.arange(lo, hi), len(pattern))
        node = np.tile(np.arange(len(pattern)), hi - lo)
        off = np.bitwise_count((self.fps[i] ^ pattern[node]) & mask[node])
        width = FAN ** (len(self.levels) - 1)
        yield from self._down(0, i, node, off, width, max_bits)

    def _down(self, level, i, node, off, width, max_bits):
        stays = (off <= max_bits) & ((node + 1) * width - 1 > i)
        i, node, off = i[stays], node[stays], off[stays]
        if level == len(self.levels) - 1:
            if len(i):
                yield i, node
            return
        pattern, mask = self.levels[level + 1]
        for at in range(0, len(i), PAIRS_AT_ONCE // FAN):
            part = slice(at, at + PAIRS_AT_ONCE // FAN)
            below = (node[part, None] * FAN + np.arange(FAN)).ravel()
            q, sum_ = np.repeat(i[part], FAN), np.repeat(off[part], FAN)
            there = below < len(pattern)
            below, q, sum_ = below[there], q[there], sum_[there]
            sum_ = sum_ + np.bitwise_count((self.fps[q] ^ pattern[below]) & mask[below])
            yield from self._down(level + 1, q, below, sum_, width // FAN, max_bits)


def bucket_stars(fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the members of each component of a bucket: (member, representative)."""
    index = GrayIndex(fps)
    n = len(index.fps)
    parent = np.arange(n)

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for lo in range(0, n, QUERIES_AT_ONCE):
        for i, j in index.links(lo, min(n, lo + QUERIES_AT_ONCE), max_bits):
            while True:  # what is in one tree already costs nothing below
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
            a, b = parent[i], parent[j]
            apart = np.unique(np.stack([a, b])[:, a != b], axis=1)
            for x, y in apart.T.tolist():
                x, y = top(x), top(y)
                parent[max(x, y)] = min(x, y)
    roots = np.array([top(x) for x in range(n)]) if n else parent
    linked = roots != np.arange(n)
    return index.fps[linked], index.fps[roots[linked]]


def links(fps: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT_BUCKET) -> DataFrame:
    """``a, b``: stars over the distinct fingerprints ``fp`` that join each component."""
    rows = buckets(fps, max_bits, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def found(rows: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
            sizes = np.diff(np.r_[starts, len(rows)])
            stars = [bucket_stars(rows[s:s + n, 2].view(np.uint64), max_bits)
                     for s, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist())]
            none = np.zeros(0, dtype=np.uint64)
            a, b = (np.concatenate([none, *(s[k] for s in stars)]).view(np.int64) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if not len(batch):
                continue
            now = np.stack([batch[c].to_numpy() for c in ("kind", "key", "fp")], axis=1)
            if held and (now[-1, :2] == held[-1][-1, :2]).all() and (now[0, :2] == now[-1, :2]).all():
                held.append(now)  # a bucket longer than a batch goes on
                continue
            last = (now[:, :2] != now[-1, :2]).any(axis=1).sum()
            yield found(np.concatenate([*held, now[:last]])) if held or last else found(now[:0])
            held = [now[last:]]
        if held:
            yield found(np.concatenate(held))

    wide = rows.select(F.col("kind").cast("long").alias("kind"), "key", "fp")
    dealt = wide.repartition("kind", "key").sortWithinPartitions("kind", "key")
    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    small_batches(docs.sparkSession)
    marked = cut(fingerprints(docs.select("doc_id", "text"), shingle).withColumnRenamed("__fp", "fp"))
    groups = component_ids(marked, max_bits)
    return marked.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def component_ids(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp, root, component_id`` of the distinct fingerprints of ``doc_id, fp``."""
    least = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    spark = marked.sparkSession
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50000")  # these rows are 24 bytes
    try:
        found = cut(links(least.select("fp"), max_bits).distinct())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    roots = components(found)
    rooted = least.join(roots, least["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "root", "component_id")


@passes_columns
def one_of_each_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest ``doc_id``.

    A null id comes last; of different texts under one id the one with the smallest hash
    stays, of rows equal in id and text any one.
    """
    rows = docs.withColumn("__row", F.xxhash64("text"))
    marked = cut(fingerprints(rows.select("doc_id", "text", "__row"), shingle).withColumnRenamed("__fp", "fp"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")).alias("first")
    stays = (marked.join(component_ids(marked, max_bits), "fp").groupBy("root").agg(first)
             .select(F.col("first.doc_id").alias("__id"), F.col("first.__row").alias("__hash")))
    kept = rows.join(stays, rows["doc_id"].eqNullSafe(stays["__id"]) & (rows["__row"] == stays["__hash"]), "left_semi")
    if not marked.groupBy("doc_id", "__row").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "__row"])
    return kept.select(*docs.columns)
