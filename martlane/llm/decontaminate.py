"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Benchmark items are cut into overlapping windows of each size in ``WINDOWS`` (a shorter item
is one window): the small ones find short quotes, the large ones, with their larger budget,
copies whose edits stand close together.  A window of length m occurs in a document if some region of it is at most k
edits away, k being a tenth of m (of windows under 64 code points no more than lets
``LEAST_SHARED`` q-grams survive, and none of those under ``SHORTEST``, which must occur as they
are): by the q-gram lemma such a region shares m + 1 - Q (k + 1) q-grams with the window, on diagonals
that lie within k of each other.  So the shared q-grams of a document and a window are
counted in diagonal bands of twice the size's largest budget that overlap by half; bands that reach
the bound are verified by a banded alignment with free ends, or found to hold the window as it is.
The filter loses no region: hash collisions and repeated q-grams only add candidates.

Memory is bounded whatever the text: shared q-grams are counted ``HITS_AT_ONCE`` at a time, equal
pairs of window and region are aligned once, and a stretch that repeats a pattern of up to
``PERIODS`` code points over and over (a ruler, a run of one sign) is searched without its middle.
A stretch of over ``STRETCH`` code points holds each of its shorter pieces at both ends too, so
nothing that could be found is left out.

Texts are compared lower-cased, with each run of white space as one space.  The benchmark is
a stated query set: it is broadcast in blocks of about ``BLOCK_POINTS`` code points, each
block against all documents, and no row is joined or shuffled.

Cases: null and empty texts hold no leak; items of fewer than ``Q`` code points have no q-gram,
are no passage and are not searched for; equal items are found each; rows repeated are found
each.  An empty benchmark leaves all documents clean.  Columns of the documents are passed
on as they are; the findings are in ``__leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.llm.common import passes_columns, small_batches

Q, SHORTEST = 8, 30
#: (code points, stride) of the windows.
WINDOWS = ((64, 32), (96, 48))
EDIT_SHARE, LEAST_SHARED = 0.1, 4
BLOCK_POINTS = 4 << 20
#: Code points of documents that are hashed at once.
AT_ONCE = 1 << 20
#: Shared q-grams that are counted at once.
HITS_AT_ONCE = 1 << 20
#: Longest pattern of a repetitive stretch, and what stays of such a stretch: more than two windows.
PERIODS, STRETCH = 4, 256
#: Code points that are looked at, every half ``STRETCH``, to see whether there is such a stretch.
PROBED = 40
#: Regions that are aligned at once.
ALIGNED_AT_ONCE = 2048
#: Regions that wait to be aligned.
REGIONS_HELD = 1 << 16
TABLE_BITS = 22
LEAKS = "array<struct<item_id:{kind},start:long,edits:int>>"


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def budget(length: int) -> int:
    return 0 if length < SHORTEST else max(0, min(int(length * EDIT_SHARE), (length + 1 - LEAST_SHARED) // Q - 1))


def grams(p: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of Q = 8 code points, from those of 2 and 4."""
    prime = 0x9E3779B97F4A7C15
    power = lambda n: np.uint64(pow(prime, n, 1 << 64))
    one = p.astype(np.uint64) + np.uint64(0x632BE5AB)
    two = one[:-1] * power(1) + one[1:]
    four = two[:-2] * power(2) + two[2:]
    eight = four[:-4] * power(4) + four[4:]
    return eight ^ (eight >> np.uint64(31))


def banded_distances(windows: list[str], regions: list[str], width: int) -> np.ndarray:
    """Least edits between each window and any part of its region, along the diagonals 0 to
    ``width`` (window position 0 at region position 0 is diagonal 0); all pairs at once."""
    lengths = np.array([len(w) for w in windows])
    longest = int(lengths.max())
    rows = np.full((len(windows), longest), -2, dtype=np.int64)
    columns = np.full((len(windows), longest + width + 1), -1, dtype=np.int64)
    for i, (window, region) in enumerate(zip(windows, regions, strict=True)):
        rows[i, :len(window)] = points(window)
        part = points(region)[:columns.shape[1]]
        columns[i, :len(part)] = part
    offsets = np.arange(width + 1, dtype=np.int16)
    row = np.zeros((len(windows), width + 1), dtype=np.int16)
    for i in range(longest):
        step = row + (columns[:, i:i + width + 1] != rows[:, i:i + 1])
        np.minimum(step[:, :-1], row[:, 1:] + 1, out=step[:, :-1])
        new = np.minimum.accumulate(step - offsets, axis=1) + offsets
        row = np.where((lengths > i)[:, None], new, row)
    return row.min(axis=1)


@dataclass
class Windows:
    """Windows of a block of items and the index of their q-grams."""
    texts: list[str]
    items: list[int]  # place of the window's item
    reach: np.ndarray  # of each window, the largest budget of its size: half the width of its bands
    codes: np.ndarray  # sorted distinct q-grams
    first: np.ndarray  # of each, its first entry
    entry_window: np.ndarray
    entry_at: np.ndarray
    present: np.ndarray  # by the top bits of a code, whether any q-gram has them


def index(items: list[str]) -> Windows:
    texts, owner, reach, codes, windows, at = [], [], [], [], [], []
    for k, item in enumerate(items):
        if len(item) < Q:
            continue
        for n, (size, stride) in enumerate(WINDOWS):
            if n and len(item) <= WINDOWS[n - 1][0]:
                break  # the item was one window before
            last = max(0, len(item) - size)
            for start in sorted({*range(0, last + 1, stride), last}):
                text = item[start:start + size]
                g = grams(points(text))
                codes.append(g)
                windows.append(np.full(len(g), len(texts)))
                at.append(np.arange(len(g)))
                texts.append(text)
                owner.append(k)
                reach.append(budget(size))
    none = np.zeros(0, dtype=np.int64)
    all_codes = np.concatenate([none.astype(np.uint64), *codes])
    order = np.argsort(all_codes, kind="stable")
    distinct, first = np.unique(all_codes[order], return_index=True)
    present = np.zeros(1 << TABLE_BITS, dtype=bool)
    present[distinct >> np.uint64(64 - TABLE_BITS)] = True
    return Windows(texts, owner, np.array(reach, dtype=np.int64), distinct, np.append(first, len(all_codes)),
                   np.concatenate([none, *windows])[order], np.concatenate([none, *at])[order], present)


def hits(p: np.ndarray, own: Windows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions, number of hits at each, entry of each hit) of the q-grams that windows share,
    about ``HITS_AT_ONCE`` hits at a time."""
    for lo in range(0, max(0, len(p) - Q + 1), AT_ONCE):
        g = grams(p[lo:lo + AT_ONCE + Q - 1])
        pos = np.flatnonzero(own.present[g >> np.uint64(64 - TABLE_BITS)])
        code = np.searchsorted(own.codes, g[pos])
        same = own.codes[np.minimum(code, len(own.codes) - 1)] == g[pos]
        pos, code = pos[same], code[same]
        first, n = own.first[code], own.first[code + 1] - own.first[code]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        cuts = np.searchsorted(ends, np.arange(HITS_AT_ONCE, total, HITS_AT_ONCE))
        for a, z in zip([0, *cuts], [*cuts, len(pos)]):
            if a < z:
                own_n = n[a:z]
                yield pos[a:z] + lo, own_n, np.repeat(first[a:z] - (np.cumsum(own_n) - own_n), own_n) + np.arange(own_n.sum())


def without_middles(p: np.ndarray) -> np.ndarray | None:
    """Which code points are searched: all (None) but the middles of repetitive stretches."""
    kept = None
    probe = np.arange(0, len(p) - PROBED - PERIODS, STRETCH // 2)
    for period in range(1, PERIODS + 1):
        # such a stretch covers one of the probed places, with what follows it
        if not len(probe) or not np.logical_and.reduce([p[probe + k] == p[probe + k + period] for k in range(PROBED)]).any():
            continue
        differs = (p[period:] != p[:-period]) | (p[period:] == 0) | (p[:-period] == 0)
        ends = np.r_[-1, np.flatnonzero(differs), len(differs)]
        for k in np.flatnonzero(np.diff(ends) > STRETCH + period):
            first, last = ends[k] + 1, ends[k + 1] + period  # the stretch is p[first:last]
            drop = (last - first - STRETCH) // period * period
            kept = np.ones(len(p), dtype=bool) if kept is None else kept
            kept[first + STRETCH // 2:first + STRETCH // 2 + drop] = False
    return kept


def leaks(texts: list[str | None], own: Windows) -> list[list[tuple[int, int, int]]]:
    """For each text the (item, start in the compared text, edits) of the items it holds."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not own.texts:
        return out
    bodies = [plain(t) for t in texts]
    p = points("\0".join(bodies))
    starts = np.cumsum([0, *(len(b) + 1 for b in bodies)])
    kept = without_middles(p)
    place = None
    if kept is not None:  # of each searched code point, its place in the whole
        place = np.flatnonzero(kept)
        before, p, starts = starts, p[kept], np.searchsorted(place, starts)
        bodies = [p[a:z - 1].tobytes().decode("utf-32-le") for a, z in zip(starts, [*starts[1:-1], len(p) + 1])]
    # band numbers are made positive: no diagonal lies further before a document than a window is long
    lowest, span = 2 * max(map(len, own.texts)) + 2, int(max(map(len, bodies))) + 4 * max(map(len, own.texts)) + 8
    counted: list[tuple[np.ndarray, np.ndarray]] = []
    for position, n, entry in hits(p, own):
        doc = np.searchsorted(starts, position, side="right") - 1
        window = own.entry_window[entry]
        band = np.repeat(position - starts[doc], n) - own.entry_at[entry]
        band //= own.reach[window]
        band += lowest + (np.repeat(doc * len(own.texts), n) + window) * span
        counted.append(np.unique(band, return_counts=True))
        if len(counted) > 16:
            counted = [_added(counted)]
    if not counted:
        return out
    keys, shared = _added(counted)
    # a band and the next one together, which overlap with the bands before and after them; a region
    # whose diagonals lie in two bands is found with the lower one
    shared[:-1] += np.where(keys[1:] == keys[:-1] + 1, shared[1:], 0)
    bound = np.array([max(1, len(t) + 1 - Q * (budget(len(t)) + 1)) for t in own.texts])
    keys = keys[shared >= bound[keys // span % len(own.texts)]]
    best: dict[tuple[int, int], tuple[int, int]] = {}
    # regions of each window that have to be aligned, with where they stand
    unsure: dict[int, dict[tuple[int, str], list[tuple[int, int]]]] = {}
    held = 0

    def align() -> None:
        for reach, alike in unsure.items():
            pairs = [pair for pair, places in alike.items() if any((d, own.items[pair[0]]) not in best or best[d, own.items[pair[0]]][0] for d, _ in places)]
            for at in range(0, len(pairs), ALIGNED_AT_ONCE):
                part = pairs[at:at + ALIGNED_AT_ONCE]
                distances = banded_distances([own.texts[w] for w, _ in part], [r for _, r in part], 4 * reach)
                for (w, r), edits in zip(part, distances.tolist(), strict=True):
                    if edits <= budget(len(own.texts[w])):
                        for d, lo in alike[w, r]:
                            best[d, own.items[w]] = min(best.get((d, own.items[w]), (edits, lo)), (edits, lo))
        unsure.clear()

    for key in keys.tolist():
        (d, w), b = divmod(key // span, len(own.texts)), key % span - lowest
        text, reach = own.texts[w], max(1, int(own.reach[w]))
        lo = (b - 1) * reach
        # before the document's start stand signs that match nothing
        region = "\0" * -lo + bodies[d][max(0, lo):max(0, (b + 3) * reach + len(text))]
        if (exact := region.find(text)) >= 0:
            best[d, own.items[w]] = min(best.get((d, own.items[w]), (0, lo + exact)), (0, lo + exact))
        elif budget(len(text)):
            unsure.setdefault(reach, {}).setdefault((w, region), []).append((d, max(0, lo)))
            held += 1
            if held % REGIONS_HELD == 0:
                align()
    align()
    for (d, item), (edits, start) in sorted(best.items()):
        out[d].append((item, start if place is None else int(place[starts[d] + start] - before[d]), edits))
    return out


def _added(counted: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sums of counts by key, in key order."""
    if len(counted) == 1:
        return counted[0]
    keys, n = (np.concatenate([c[i] for c in counted]) for i in (0, 1))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(n, first)


@passes_columns
def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All columns of ``docs`` and ``__leaks``: an entry for each benchmark item held."""
    spark = docs.sparkSession
    small_batches(spark)
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    kind = LEAKS.format(kind=item_kind)
    size = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_POINTS))
    out = docs.withColumn("__leaks", F.expr(f"cast(array() as {kind})"))
    for block in range(blocks):
        own = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast([(r["item_id"], plain(r["text"])) for r in own.collect()])
        out = _one_block(out, shared, kind)
    return out


def _one_block(docs: DataFrame, shared, kind: str) -> DataFrame:
    names = docs.columns
    text_at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = [i for i, _ in shared.value]
        own = index([t for _, t in shared.value])
        for batch in batches:
            texts, before = batch.column(text_at).to_pylist(), batch.column(len(names) - 1)
            found, at, size = [], 0, 0
            for i, t in enumerate(texts):  # as many documents together as AT_ONCE holds
                size += len(t or "")
                if size >= AT_ONCE or i == len(texts) - 1:
                    found += leaks(texts[at:i + 1], own)
                    at, size = i + 1, 0
            if any(found):
                rows = [b + [{"item_id": ids[k], "start": s, "edits": e} for k, s, e in f]
                        for b, f in zip(before.to_pylist(), found, strict=True)]
                before = pa.array(rows, before.type)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], before], names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[:-1])
    return docs.mapInArrow(run, f"{kinds}, `__leaks` {kind}")
