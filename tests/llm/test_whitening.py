"""Embedding whitening: the spectral split and the query against numpy."""
import math
import random

import numpy as np
import pytest

from martlane.llm.queries import op12_embedding_whitening
from martlane.llm.whitening import polar_factor, spectrum, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, x string, c int, cell long, component int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3, 4) for i, v in rows], SCHEMA)


def vectors(n=300, size=20, seed=4):
    rng = np.random.default_rng(seed)
    made = (rng.normal(size=(n, size)) * np.linspace(0.1, 1, size)) @ np.linalg.qr(rng.normal(size=(size, size)))[0]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.float32(made))]
    rows += [rows[0], (None, rows[1][1]), *((1000 + i, rows[2][1]) for i in range(200))]  # copies of one vector
    bad = [None, [], [None] * size, [float("nan")] * size, [math.inf] + [0.0] * (size - 1), [0.5] * (size - 1), [0.5, None]]
    return rows, [(5000 + i, v) for i, v in enumerate(bad)]


def expected(rows):
    x = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in enumerate(v for _, v in rows)}
    fit = sorted(set(map(tuple, x.values())))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, dtype=float) - np.array(sums) / n
    values, q = np.linalg.eigh(centred.T @ centred / n)
    values, q = values[::-1], q[:, ::-1]
    out = {}
    for i, (vec_id, _) in enumerate(rows):
        deviation = sum((n * a - s) ** 2 for a, s in zip(x[i], sums))
        z = (np.array(x[i]) - np.array(sums) / n) @ q / np.sqrt(values)
        out.setdefault(vec_id, []).append((deviation, z))
    return n, values / values.sum(), out


def test_whitening_matches_numpy(spark, tmp_path):
    rows, bad = vectors()
    frame(spark, rows + bad).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op12_embedding_whitening(spark, str(tmp_path)).collect()
    n, explained, want = expected(rows)
    assert len(got) == 16 * len(rows) and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error < 1e-9
    signs = {}
    for r in got:
        deviation, z = want[r.vec_id][0]
        assert r.deviation == deviation
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        sign = signs.setdefault(r.component, np.sign(r.whitened) * np.sign(z[r.component - 1]))
        assert r.whitened == pytest.approx(sign * z[r.component - 1], abs=1e-9)
    assert set(signs) == set(range(1, 17))


def test_few_dimensions_and_no_variance(spark):
    rows = [(i, [float(i % 3), 5.0, float(i % 3) * 2]) for i in range(9)]
    got = whiten(frame(spark, rows)).collect()  # of three dimensions one varies
    assert {r.component for r in got} == {1} and len(got) == 9 and got[0].explained == pytest.approx(1)
    assert got[0].identity_error < 1e-9
    assert whiten(frame(spark, [(1, [0.5, 0.25])] * 4)).count() == 0
    assert whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    assert whiten(frame(spark, [])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_do_not_overflow(spark):
    rows = [(i, [1e30 * (i % 2), float(i)]) for i in range(6)] + [(7, [-3e38, 2.0])]
    got = whiten(frame(spark, rows)).collect()
    assert {r.vec_id for r in got} == {*range(6), 7} and all(r.deviation is None for r in got)
    rows = [(i, [random.Random(i).uniform(-3e9, 3e9), float(i)]) for i in range(40)]
    n, _, want = expected([(i, [float(np.float32(x)) for x in v]) for i, v in rows])
    for r in whiten(frame(spark, rows)).collect():
        exact = want[r.vec_id][0][0]
        assert r.deviation == (exact if exact < 2**63 else None)


@pytest.mark.parametrize("values", [
    np.linspace(1, 20, 64) ** 2, 10.0 ** -np.arange(16), [3, 3, 3, 1, 1, 0, 0, 0], [4, 2, 2, 2, 0], [1] * 7, [0] * 5,
    [5], [2, 1], 1 + 1e-9 * np.arange(12), [1, 1, 1, 1 + 1e-15], [-3, -1, 0, 1, 3]])
def test_spectrum(values):
    values = np.sort(np.array(values, dtype=float))[::-1]
    size = len(values)
    turn = np.linalg.qr(np.random.default_rng(size).normal(size=(size, size)))[0]
    for a in (np.diag(values), turn @ np.diag(values) @ turn.T):
        a = (a + a.T) / 2
        found, q = spectrum(a)
        scale = max(np.abs(values).max(), 1e-300)
        assert np.abs(found - values).max() <= 1e-13 * scale
        assert np.abs(q.T @ q - np.eye(size)).max() < 1e-12
        assert np.abs(a @ q - q * found).max() <= 1e-13 * scale


def test_polar_factor():
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    values = np.concatenate([rng.uniform(1e-10, 1, 12), -rng.uniform(1e-6, 5, 18)])
    found = polar_factor(q @ np.diag(values) @ q.T)
    assert np.abs(found - q @ np.diag(np.sign(values)) @ q.T).max() < 1e-4
    assert np.abs(found @ found - np.eye(30)).max() < 1e-12
