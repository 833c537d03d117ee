"""Toxicity by a classifier chain: each category's linear model also reads the probabilities
that the models of the earlier categories gave.

The categories and their order are ``CHAIN``, read from the columns of ``labels``.  Later
models are trained on out-of-fold probabilities of the earlier ones (``FOLDS`` folds), so
they see what they will see on new documents; for prediction each model is fitted to the
whole sample.  A model is a logistic regression over the presence of words and of letter
runs of ``GRAM`` letters, and over four shares of the text (capitals, digits, other signs,
repeated words).

The sample is bounded: at most about ``SAMPLE_PER_STRATUM`` documents of each combination of
labels, chosen by a hash of the id, weighted by how many documents they stand for.  The
words are chosen by their association with a category (log-likelihood ratio) among those in
``LEAST_DOCUMENTS`` sample documents at least, ``FEATURES`` for each category; the statistics
are sums over all sample texts.  Every document is predicted from its whole text.

A document is toxic if its probability reaches the threshold that gives the best F1 of the
out-of-fold predictions, ``LEAST_THRESHOLD`` at least.

Cases: a null text or one without a word is not toxic, with probability 0.  Of several label
rows of one id the worst of each category counts; label rows with a null are left out.  Without
labels of both kinds nothing is toxic.  Of several texts of one id the model learns from one.  Repeated rows get the same result each; columns other
than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlane.llm.common import cut, small_batches

#: Categories in chain order, with the condition on ``labels`` that makes one true.
CHAIN: tuple[tuple[str, str], ...] = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"))
TARGET = "toxic"
SAMPLE_PER_STRATUM, FEATURES, LEAST_DOCUMENTS, GRAM = 2000, 800, 4, 5
FOLDS, STEPS, RATE, PENALTY = 5, 250, 0.5, 1e-4
#: A document below this probability is never called toxic.
LEAST_THRESHOLD = 0.3
WORD = r"[^\W\d_]+"
SHARES = 4
#: Words whose features a task remembers.
MEMO = 200_000


def word_features(word: str) -> list[str]:
    """The word itself and, marked by a tilde, its letter runs."""
    return [word, *(f"~{word[i:i + GRAM]}" for i in range(len(word) - GRAM + 1))]


def features(text: str) -> set[str]:
    return {f for w in set(re.findall(WORD, text.lower())) for f in word_features(w)}


def shares(text: str, words: list[str], distinct: int) -> list[float]:
    n = max(1, len(text))
    letters = sum(map(len, words))
    digits = sum(map(text.count, "0123456789"))
    blank = text.count(" ") + text.count("\n")
    capitals = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return [capitals / n, digits / n, max(0, n - letters - digits - blank) / n, 1 - distinct / max(1, len(words))]


@dataclass
class Vectorizer:
    """Rows of the presence of chosen features and of the shares of a text."""
    index: dict[str, int]
    memo: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def row(self, text: str | None) -> tuple[list[int], list[float]] | None:
        """None for a text without a word."""
        words = re.findall(WORD, text.lower()) if text else []
        if not words:
            return None
        distinct, found, memo = set(words), set(), self.memo
        for w in distinct:
            at = memo.get(w)
            if at is None:
                if len(memo) >= MEMO:
                    memo.clear()
                memo[w] = at = tuple({self.index[f] for f in word_features(w) if f in self.index})
            if at:
                found.update(at)
        return sorted(found), shares(text, words, len(distinct))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a penalised logistic regression (the last for the constant), by accelerated
    gradient descent."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    weight = (weight / weight.sum()).astype(x.dtype)
    scale = 1 / np.sqrt(0.01 + weight @ x)  # rare features take longer steps
    w = np.zeros(x.shape[1], dtype=x.dtype)
    last = w
    for step in range(STEPS):
        ahead = w + step / (step + 3) * (w - last)
        p = 1 / (1 + np.exp(-np.clip(x @ (ahead * scale), -30, 30)))
        gradient = (x.T @ (weight * (p - y))) * scale + PENALTY * ahead
        last, w = w, ahead - RATE * gradient
    return (w * scale).astype(np.float64)


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


@dataclass
class Chain:
    categories: list[str]
    index: dict[str, int]
    weights: list[np.ndarray]
    threshold: float

    def predict(self, found: list[int], dense: list[float]) -> list[float]:
        """Probability of each category, in chain order."""
        out: list[float] = []
        n = len(self.index)
        for w in self.weights:
            z = w[found].sum() + w[n:n + SHARES] @ dense + w[n + SHARES:-1] @ out + w[-1]
            out.append(float(1 / (1 + np.exp(-min(30.0, max(-30.0, z))))))
        return out


def fit(rows: list[tuple[list[int], list[float]]], truth: dict[str, np.ndarray], weight: np.ndarray,
        index: dict[str, int]) -> Chain | None:
    """None where the target has no row of one kind."""
    if TARGET not in truth or truth[TARGET].all() or not truth[TARGET].any():
        return None
    x = np.zeros((len(rows), len(index) + SHARES), dtype=np.float32)
    for i, (found, dense) in enumerate(rows):
        x[i, found] = 1
        x[i, len(index):] = dense
    fold = np.arange(len(rows)) % FOLDS
    weights = []
    for name, y in truth.items():
        unseen = np.zeros(len(rows))
        for k in range(FOLDS):
            own = fold == k
            if own.any() and not own.all():
                unseen[own] = probability(x[own], logistic(x[~own], y[~own].astype(x.dtype), weight[~own]))
        weights.append(logistic(x, y.astype(x.dtype), weight))
        x = np.hstack([x, unseen[:, None].astype(x.dtype)])
        if name == TARGET:
            order = np.argsort(-unseen, kind="stable")
            hit, all_ = np.cumsum((weight * y)[order]), np.cumsum(weight[order])
            f1 = 2 * hit / (all_ + (weight * y).sum())
            best = int(f1.argmax())
            after = unseen[order[best + 1]] if best + 1 < len(order) else 0.0
            # between the last document taken and the first one left
            threshold = max(LEAST_THRESHOLD, float((unseen[order[best]] + after) / 2))
    return Chain(list(truth), index, weights, threshold)


def association(n: np.ndarray, n_true: np.ndarray, total: float, total_true: float) -> np.ndarray:
    """Log-likelihood ratio of a feature's presence against a category."""
    def part(a: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(a > 0, a * np.log(np.maximum(a, 1e-9) / np.maximum(expected, 1e-9)), 0.0)
    rest = total - total_true
    n_false = n - n_true
    return (part(n_true, n * total_true / total) + part(n_false, n * rest / total)
            + part(total_true - n_true, (total - n) * total_true / total)
            + part(rest - n_false, (total - n) * rest / total))


def train(docs: DataFrame, labels: DataFrame, per_stratum: int = SAMPLE_PER_STRATUM) -> Chain | None:
    small_batches(docs.sparkSession)
    names = [name for name, _ in CHAIN]
    flags = [F.max(F.expr(cond)).alias(name) for name, cond in CHAIN]
    known = cut(labels.groupBy("doc_id").agg(*flags).dropna())
    sizes = {tuple(r[:-1]): r[-1] for r in known.groupBy(*names).count().collect()}
    share: Column = F.lit(0)
    for stratum, size in sizes.items():
        same = F.lit(True)
        for name, value in zip(names, stratum, strict=True):
            same = same & (F.col(name) == value)
        share = share + F.when(same, size).otherwise(0)
    # at most about 2 ** len(CHAIN) * per_stratum rows: a bound that allows the broadcast
    chosen = known.withColumn("size", share).filter(F.pmod(F.xxhash64("doc_id"), F.col("size")) < per_stratum)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.drop("size")), "doc_id")
    # of several texts under one id the one with the least hash
    sample = cut(texts.groupBy("doc_id", *names).agg(F.min_by("text", F.xxhash64("text")).alias("text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals: list[Counter] = [Counter() for _ in range(len(names) + 1)]
            flags = [batch[name].to_pylist() for name in names]
            for i, text in enumerate(batch["text"].to_pylist()):
                own = features(text or "")
                totals[0].update(own)
                for k, flag in enumerate(flags):
                    if flag[i]:
                        totals[k + 1].update(own)
            keys = list(totals[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *(pa.array([t[key] for key in keys], pa.int64()) for t in totals)],
                ["feature", "n", *names])

    columns = "".join(f", {name} long" for name in names)
    counted = cut(sample.mapInArrow(count, f"feature string, n long{columns}").groupBy("feature")
                  .agg(F.sum("n").alias("n"), *(F.sum(name).alias(name) for name in names))
                  .filter(F.col("n") >= LEAST_DOCUMENTS))
    total = sample.agg(F.count("*"), *(F.coalesce(F.sum(F.col(name).cast("long")), F.lit(0)) for name in names)).first()

    def score(name: str, n_true: int):
        @F.pandas_udf("double")
        def scored(n, true):
            import pandas as pd
            return pd.Series(association(n.to_numpy(float), true.to_numpy(float), float(total[0]), float(n_true)))
        return scored("n", name)

    picked: set[str] = set()
    for k, name in enumerate(names):
        best = counted.orderBy(F.desc(score(name, total[k + 1])), "feature").select("feature").limit(FEATURES)
        picked.update(r[0] for r in best.collect())
    index = {f: i for i, f in enumerate(sorted(picked))}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vectorizer(index)
        for batch in batches:
            found = [(i, *r) for i, t in enumerate(batch["text"].to_pylist()) if (r := own.row(t))]
            at = pa.array([r[0] for r in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(at), *(batch[name].take(at) for name in names),
                 pa.array([r[1] for r in found], pa.list_(pa.int32())),
                 pa.array([r[2] for r in found], pa.list_(pa.float64()))], ["doc_id", *names, "found", "dense"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    flags_kind = "".join(f", {name} boolean" for name in names)
    got = sample.mapInArrow(vectors, f"doc_id {kind}{flags_kind}, found array<int>, dense array<double>").toPandas()
    got = got.sort_values("doc_id", kind="stable")
    truth = {name: got[name].to_numpy(bool) for name in names}
    strata = Counter(zip(*truth.values(), strict=True))
    weight = np.array([sizes[s] / strata[s] for s in zip(*truth.values(), strict=True)], dtype=float)
    rows = [(list(map(int, f)), list(d)) for f, d in zip(got["found"], got["dense"], strict=True)]
    return fit(rows, truth, weight, index) if rows else None


def predict(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """``doc_id, toxic`` and the probability ``p_<category>`` of every row."""
    small_batches(docs.sparkSession)
    names = [name for name, _ in CHAIN]
    shared = docs.sparkSession.sparkContext.broadcast(
        (chain.categories, chain.index, chain.weights, chain.threshold) if chain else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Chain(*shared.value) if shared.value else None
        vectorizer = Vectorizer(own.index) if own else None
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                row = vectorizer.row(text) if vectorizer else None
                out.append(own.predict(*row) if row else [0.0] * len(names))
            toxic = [own is not None and p[names.index(TARGET)] >= max(own.threshold, 1e-9) for p in out]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(toxic, pa.bool_()),
                 *(pa.array([p[k] for p in out], pa.float64()) for k in range(len(names)))],
                ["doc_id", "toxic", *(f"p_{name}" for name in names)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, toxic boolean" + "".join(f", p_{name} double" for name in names))
