"""Embedding whitening by QDWH spectral divide and conquer.

Vectors are put on a grid of whole numbers, so equal ones are equal exactly.  The fit uses each
distinct vector once: one pass for their number and sums, a second one for the covariance of
the centred vectors.  Both are sums of small matrices: a task adds up its batches, and the
cells of the tasks' matrices are added by a grouping, so the driver gets one d x d matrix.

The driver splits that matrix: the polar factor U of V - s I, found by the dynamically weighted
Halley iteration in its QR form, has eigenvalues -1 and 1, so (I + U) / 2 projects on the
eigenvectors above the shift s.  An orthonormal basis of the projector's range and of its
complement halves the problem, and so on down to single components.  Where a half's matrix is
a multiple of the identity, any basis will do.  The components (d x ``COMPONENTS`` doubles) are
broadcast and all vectors are projected.  ``identity_error`` is measured, not assumed: the
covariance of the fit list's whitened vectors is summed in a third pass.

Cases: a vector that is null, empty or holds a null or non-finite entry has no rows, nor has
one whose length is not the commonest (of equally common ones the longest); repeated rows give
repeated results; a null id is kept.  Components without variance (below ``NO_VARIANCE`` of
the largest) have none to be divided by and are left out, so a table of equal vectors gives no
rows, as does an empty one.  Entries beyond ``FARTHEST`` on the grid are read as that number;
``deviation`` is null where it is beyond a long.  Columns other
than ``vec_id`` and ``embedding`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.llm.common import cut, small_batches

COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
#: The driver and every task hold a square matrix of this size at most.
MAX_DIMENSIONS = 4096
NO_VARIANCE = 1e-12
#: Entries beyond this on the grid are put there, so that a batch's sums are within a long.
FARTHEST = 1 << 48
HALLEY_STEPS = 40
EPS = np.finfo(float).eps


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix: QDWH, inverse free."""
    size = len(a)
    x = a / np.linalg.norm(a, 2)
    # a lower bound of the least singular value; too low only costs a step or two
    low = max(EPS, np.linalg.norm(x, 1) and 1 / (np.sqrt(size) * _inverse_norm(x)))
    eye = np.eye(size)
    for _ in range(HALLEY_STEPS):
        squared = min(1.0, low) ** 2
        d = np.cbrt(4 * (1 - squared) / squared**2)
        root = np.sqrt(1 + d)
        alpha = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - squared) / (squared * root))) / 2
        beta = (alpha - 1) ** 2 / 4
        gamma = alpha + beta - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(gamma) * x, eye]))
        new = beta / gamma * x + (alpha - beta / gamma) / np.sqrt(gamma) * (q[:size] @ q[size:].T)
        new = (new + new.T) / 2
        low = min(1.0, low * (alpha + beta * squared) / (1 + gamma * squared))
        change = np.linalg.norm(new - x)
        x = new
        if change < np.cbrt(5 * EPS) and 1 - low < 10 * EPS:
            break
    return x


def _inverse_norm(x: np.ndarray) -> float:
    """1-norm of the inverse, from the triangular factor (infinite for a singular matrix)."""
    try:
        return float(np.linalg.norm(np.linalg.inv(np.linalg.qr(x, mode="r")), 1))
    except np.linalg.LinAlgError:
        return 1 / EPS


def split(a: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below some shift; None where all
    eigenvalues are equal to rounding."""
    size = len(a)
    middle = np.trace(a) / size
    spread = np.linalg.norm(a - middle * np.eye(size), 2)
    if spread <= 4 * EPS * norm:
        return None
    best = None
    # a shift on an eigenvalue leaves that direction undecided: then another one is taken
    for away in (0.0, 0.13, -0.17, 0.29, -0.37, 0.43, -0.53):
        unit = polar_factor(a - (middle + away * spread) * np.eye(size))
        projector = (np.eye(size) + unit) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < size:
            continue
        # columns in falling order of what of them is not yet spanned: a basis of the range
        basis, _ = np.linalg.qr(projector[:, _pivots(projector, rank)], mode="complete")
        basis, _ = np.linalg.qr(np.hstack([projector @ basis[:, :rank], (np.eye(size) - projector) @ basis[:, rank:]]))
        off = np.linalg.norm(basis[:, :rank].T @ a @ basis[:, rank:])
        if best is None or off < best[0]:
            best = off, basis[:, :rank], basis[:, rank:]
        if off <= 10 * size * EPS * norm:
            break
    return best[1:] if best else None


def _pivots(projector: np.ndarray, rank: int) -> list[int]:
    left, chosen = projector.copy(), []
    for _ in range(rank):
        k = int((left**2).sum(axis=0).argmax())
        chosen.append(k)
        unit = left[:, k] / np.linalg.norm(left[:, k])
        left -= np.outer(unit, unit @ left)
    return chosen


def rotate(a: np.ndarray) -> np.ndarray:
    """Eigenvectors of a symmetric 2 x 2 matrix."""
    angle = np.arctan2(2 * a[0, 1], a[0, 0] - a[1, 1]) / 2
    return np.array([[np.cos(angle), -np.sin(angle)], [np.sin(angle), np.cos(angle)]])


def eigenvectors(a: np.ndarray, norm: float | None = None) -> np.ndarray:
    """An orthogonal matrix that makes the symmetric matrix ``a`` diagonal."""
    norm = np.linalg.norm(a, 2) if norm is None else norm
    if len(a) <= 1:
        return np.eye(len(a))
    if len(a) == 2:
        return rotate(a)
    halves = split(a, norm)
    if halves is None:
        return np.eye(len(a))
    return np.hstack([basis @ eigenvectors((m + m.T) / 2, norm) for basis in halves
                      for m in [basis.T @ a @ basis]])


def spectrum(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and their eigenvectors as columns."""
    q = eigenvectors(a)
    # one step of first order takes away what rounding left in the halves
    for _ in range(2):
        residual, d = np.eye(len(a)) - q.T @ q, q.T @ a @ q
        d = (d + d.T) / 2
        values = np.diag(d) / (1 - np.diag(residual))
        gap = values[None, :] - values[:, None]
        safe = np.abs(gap) > 1e-6 * max(np.abs(values).max(initial=0), np.finfo(float).tiny)
        tilt = np.where(safe, (d + residual * values[None, :]) / np.where(safe, gap, 1), residual / 2)
        q = q + q @ tilt
    values = np.einsum("ij,ik,kj->j", q, a, q) / (q * q).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order], q[:, order] / np.linalg.norm(q[:, order], axis=0)


@dataclass
class Whitening:
    n: int
    sums: list[int]  # of each dimension of the fit list
    centre: np.ndarray  # whole numbers next to the means
    rest: np.ndarray  # the means less the centre
    values: np.ndarray
    vectors: np.ndarray  # columns
    total: float  # the covariance's trace

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) - self.rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)², exact."""
        small = x - self.centre
        left = np.array([s - self.n * int(c) for s, c in zip(self.sums, self.centre)], dtype=object)
        largest = self.n * (int(np.abs(small).max(initial=0)) + 1)
        if largest * largest * x.shape[1] < 2**63:
            return ((self.n * small - left.astype(np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * small.astype(object) - left) ** 2).sum(axis=1).tolist()
        return [int(v) if v < 2**63 else None for v in exact]


def on_grid(rows: DataFrame) -> DataFrame:
    """``vec_id, x`` of the rows whose vector is whole: x = floor(64 c) + 1000000."""
    c = F.transform("embedding", lambda v: v.cast("double"))
    whole = rows.select("vec_id", c.alias("c")).filter(
        F.coalesce((F.size("c") > 0) & F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))),
                   F.lit(False)))
    far = F.lit(float(FARTHEST))
    return whole.select("vec_id", F.transform(
        "c", lambda v: F.floor(F.greatest(-far, F.least(far, v * SCALE))) + F.lit(OFFSET)).alias("x"))


def matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    column = batch["x"]
    return column.flatten().to_numpy().reshape(len(column), size)


def summed(rows: DataFrame, size: int, of, exact: bool = False) -> np.ndarray:
    """The sum over ``x`` rows of ``of(batch matrix)``, an array of any fixed shape; whole
    numbers are added without overflow if ``exact``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                part = of(matrix(batch, size)).ravel()
                part = part.astype(object) if exact else part
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(
                [str(v) for v in total] if exact else total)], ["cell", "v"])

    found = rows.select("x").mapInArrow(run, f"cell long, v {'string' if exact else 'double'}")
    kind, number = ("decimal(38,0)", int) if exact else ("double", float)
    cells = {r["cell"]: number(r["v"]) for r in
             found.groupBy("cell").agg(F.sum(F.col("v").cast(kind)).alias("v")).collect()}
    return np.array([cells[i] for i in range(len(cells))], dtype=object if exact else float)


def _sums(x: np.ndarray) -> np.ndarray:
    return np.r_[len(x), x.sum(axis=0)]


def fit(distinct: DataFrame, size: int, components: int = COMPONENTS) -> tuple[Whitening, float]:
    """The whitening of the distinct vectors ``x``, and its measured identity error."""
    n, *sums = summed(distinct, size, _sums, exact=True)
    centre = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s - n * int(c)) / n for s, c in zip(sums, centre)])
    none = np.zeros(0)
    own = Whitening(n, sums, centre, rest, none, none, 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        y = own.centred(x)
        return y.T @ y

    covariance = summed(distinct, size, products).reshape(size, size) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = spectrum(covariance)
    count = int((values[:components] > NO_VARIANCE * max(values[0], 0.0)).sum())
    fitted = Whitening(n, sums, centre, rest, values[:count], vectors[:, :count], float(np.trace(covariance)))
    if not count:
        return fitted, 0.0

    def again(x: np.ndarray) -> np.ndarray:
        w = fitted.whitened(x)
        return np.r_[w.sum(axis=0), (w.T @ w).ravel()]

    found = summed(distinct, size, again) / n
    mean, products_ = found[:count], found[count:].reshape(count, count)
    return fitted, float(np.abs(products_ - np.outer(mean, mean) - np.eye(count)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each
    whole vector and component."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = vectors.sparkSession
    small_batches(spark)
    rows = cut(on_grid(vectors))
    commonest = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if commonest is None:
        return spark.createDataFrame([], schema)
    size = commonest["size"]
    if size > MAX_DIMENSIONS:
        raise ValueError(f"vectors of more than {MAX_DIMENSIONS} entries")
    rows = rows.filter(F.size("x") == size)
    fitted, error = fit(cut(rows.select("x").distinct()), size, components)
    shared = spark.sparkContext.broadcast(tuple(vars(fitted).values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Whitening(*shared.value)
        count = len(own.values)
        for batch in batches:
            rows = len(batch)
            if not count or not rows:
                continue
            x = matrix(batch, size)
            each = pa.array(np.repeat(np.arange(rows), count))
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"].take(each), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                 pa.array(np.full(rows * count, own.n)), pa.array(own.deviations(x), pa.int64()).take(each),
                 pa.array(own.whitened(x).ravel()), pa.array(np.tile(own.values / own.total, rows)),
                 pa.array(np.full(rows * count, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
