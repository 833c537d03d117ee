"""Exact dedup, SimHash near-dedup and line dedup against brute force."""
import hashlib
import os
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from fixtures import documents, table  # noqa: E402

from martlane.llm import simhash_dedup  # noqa: E402
from martlane.llm.exact_dedup import exact_duplicates  # noqa: E402
from martlane.llm.line_dedup import Filters, digest_of, drop_repeated_lines, long_lines, suspects  # noqa: E402


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def expected_exact(rows):
    texts = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t, _ in rows]
    groups = defaultdict(list)
    for (i, _, _), t in zip(rows, texts, strict=True):
        groups[t].append(i)
    out = []
    for (i, _, _), t in zip(rows, texts, strict=True):
        ids = [x for x in groups[t] if x is not None]
        out.append((i, min(ids, default=None), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("block", [7, 64, 8192])
def test_exact_dedup(spark, block):
    rows = documents()
    got = exact_duplicates(table(spark, rows), block).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter(expected_exact(rows))
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({r.text_sha256 for r in got})


def test_exact_dedup_with_colliding_hashes(spark):
    """Names tell contents apart even if the hash does not."""
    rows = documents(20)
    got = exact_duplicates(table(spark, rows), 16, lambda b: F.length(b).cast("long") % 2).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter(expected_exact(rows))


def test_exact_dedup_empty(spark):
    assert exact_duplicates(table(spark, [])).count() == 0


def expected_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(values, bits):
    """Root index of each value under links of at most ``bits`` differing bits."""
    parent = list(range(len(values)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(values))]


def test_simhash(spark):
    rows = documents()
    prints = [expected_fingerprint(t) for _, t, _ in rows]
    roots = components_of(prints, 4)
    least = {}
    for (i, _, _), r in zip(rows, roots, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    expected = Counter((i, f"{p:016x}", least.get(r)) for (i, _, _), p, r in zip(rows, prints, roots, strict=True))
    got = simhash_dedup.near_duplicates(table(spark, rows)).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == expected
    docs = table(spark, rows)
    kept = simhash_dedup.one_of_each_group(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert Counter(ids) == Counter(least.get(r) for r in set(roots))
    assert simhash_dedup.near_duplicates(table(spark, [])).count() == 0


def near_values(seed=1, n=400):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = set()
    for _ in range(n):
        v = int(centres[rng.integers(len(centres))])
        for b in rng.choice(64, rng.integers(0, 6), replace=False):
            v ^= 1 << int(b)
        values.add(v)
    return sorted(values)


def test_gray_index_finds_every_pair():
    values = np.array(near_values(), dtype=np.uint64)
    index = simhash_dedup.GrayIndex(values)
    found = {(int(index.fps[a]), int(index.fps[b])) for i, j in index.links(0, len(values), 4) for a, b in zip(i, j)}
    found = {tuple(sorted(x)) for x in found}
    expected = {(int(a), int(b)) for a in values for b in values if a < b and (int(a) ^ int(b)).bit_count() <= 4}
    assert found == expected


@pytest.mark.parametrize("hot", [3, 50_000])
def test_links_join_all_components(spark, hot):
    """Also when every bucket of over three members is dealt again."""
    values = near_values()
    fps = spark.createDataFrame([(simhash_dedup.signed(v),) for v in values], "fp long")
    stars = simhash_dedup.links(fps, 4, hot).collect()
    at = {simhash_dedup.signed(v): k for k, v in enumerate(values)}
    parent = list(range(len(values)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in stars:
        a, b = top(at[a]), top(at[b])
        parent[max(a, b)] = min(a, b)
    assert [top(i) for i in range(len(values))] == components_of(values, 4)


def expected_lines(rows):
    strip = "\x20\x09\x0a\x0b\x0c\x0d"
    texts = [(i, (t or "").split("\n")) for i, t, _ in rows]
    holders = defaultdict(list)
    for i, lines in texts:
        for key in {lower(x.strip(strip)) for x in lines}:
            if len(key) >= 40:
                holders[key].append(i)
    keeper = {k: max((x for x in v if x is not None), default=None) for k, v in holders.items() if len(v) >= 5}
    out = []
    for i, lines in texts:
        kept = [x for x in lines if (k := lower(x.strip(strip))) not in keeper or keeper[k] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup(spark):
    rows = documents()
    docs = table(spark, rows)
    out = drop_repeated_lines(docs)
    assert out.columns == [*docs.columns, "__n_lines", "__n_dropped"]
    got = Counter((r["doc_id"], r["__n_lines"], r["__n_dropped"], r["text"] or "") for r in out.collect())
    expected = expected_lines(rows)
    assert got == Counter(expected) and sum(r[2] for r in expected) > 10
    assert drop_repeated_lines(table(spark, [])).count() == 0
    # columns of the names that the operator uses
    odd = docs.withColumns({c: F.lit(i) for i, c in enumerate(["__lines", "__lost", "__text_hash", "__id", "__n_lines"])})
    out = drop_repeated_lines(odd)
    assert out.columns == [*odd.columns[:-1], "__n_lines", "__n_dropped"]
    assert Counter((r["doc_id"], r["__n_lines"], r["__n_dropped"], r["text"] or "") for r in out.collect()) == got
    assert {(r["__lines"], r["__id"]) for r in out.collect()} == {(0, 3)}


def line_rows():
    lines = [f"a line of at least forty code points, number {i:06}" for i in range(6000)]
    return lines, [(i, x, None) for i, x in enumerate(lines + lines[:300])]


def test_filters_suspect_all_repeats_and_little_else(spark):
    lines, rows = line_rows()
    found = long_lines(table(spark, rows).repartition(7).withColumn("name", F.lit("x")), 40)
    got = {r.h for r in suspects(found, 100, 4).collect()}
    assert suspects(found, 100, 4).count() == len(got)  # each is given back once
    repeated = {h_of(x) for x in lines[:300]}
    assert repeated <= got and len(got - repeated) < 0.05 * 5700


def h_of(line):
    return int.from_bytes(digest_of(line)[:8], "little", signed=True)


def test_filters_grow_with_the_input():
    """Share of once-seen hashes that are suspected, where a filter of a fixed size suspects over
    70 in 100: with parts for the lines there are, it stays under 5."""
    rng = np.random.default_rng(1)

    def share(lines, parts, room):
        wrong = 0
        for _ in range(parts):
            own = Filters(room)
            for at in range(0, lines // parts, 4096):
                wrong += len(own.repeats(rng.integers(0, 1 << 63, min(4096, lines // parts - at), dtype=np.uint64)))
        return wrong / lines

    assert share(400_000, 1, 4_000) > 0.7
    assert share(400_000, 100, 5_000) < 0.05


def test_filters_lose_no_repeat_when_full():
    """Also when the twice filter answers yes to everything."""
    own, rng = Filters(8), np.random.default_rng(2)
    values = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    got = np.concatenate([own.repeats(part) for part in np.array_split(rng.permutation(np.repeat(values, 2)), 20)])
    assert sorted(got) == sorted(values)
