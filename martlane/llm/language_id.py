"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text is the bag of the byte n-grams of its lower-cased words; each n-gram is hashed to one
row of an embedding table, the rows are averaged over the whole text and a linear softmax
reads the language.  The model is trained by stochastic gradient descent in numpy on a
bounded sample (``SAMPLE_PER_LANGUAGE`` documents of each language, whole texts, reduced to
their hashed counts by the executors).  A part of the sample that training does not see
calibrates the probabilities (one temperature) and two rejection thresholds.

A text is rejected if the languages learned are about equally likely: its best probability is
below the lowest ``REJECT_QUANTILE`` of the rightly predicted ones, at most ``MOST_THRESHOLD`` or, with
few languages, ``MARGIN`` above the probability that all of them share evenly.  It is also rejected
if it is no text of the predicted language at all: the softmax compares languages, and gives the
least unlike one for any text.  So each language also has the shares of its n-grams, and a text's
familiarity is the mean logarithm of its n-grams' shares, less what is usual for the language.
Texts below the ``REJECT_QUANTILE`` of the calibration part are unfamiliar, but none whose n-grams are
less than exp(``UNFAMILIAR``) times rarer than usual; a text of d distinct n-grams may be
``SHORT`` / sqrt(d) lower, as its mean says less.

As averaging and the softmax's input are linear, prediction looks up one row of logits per
n-gram.  The model (``BUCKETS`` x languages floats) is broadcast.

Nulls: a text that is null or has no letter is ``und`` with score 0 and rejected.  Rows are
predicted one by one, so ties, repeated rows and empty tables need no care.  Rows whose
label is null are not learned from; with no labelled row at all every text is ``und``.
Other columns are not read, and the label, the source and the id are no input of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlane.llm.common import cut, passes_columns, small_batches

BUCKET_BITS, DIMENSIONS, LONGEST = 14, 16, 4
BUCKETS = 1 << BUCKET_BITS
#: Sampled documents of a language, and of all together (some 70 kB each on the driver).
SAMPLE_PER_LANGUAGE, SAMPLE_IN_ALL = 600, 12_000
EPOCHS, RATE, CALIBRATION_SHARE = 6, 0.5, 5
#: Steps of an embedding row are so much larger than its share of the text, 1 at most.
ROW_RATE = 20
#: The model and its labels are held by the driver; more languages than this are an error.
MAX_LANGUAGES = 1000
NO_LETTERS = regex.compile(r"\P{L}+")
REJECT_QUANTILE, MOST_THRESHOLD, MARGIN = 0.0005, 0.4, 0.15
UNFAMILIAR, SHORT = 2.6, 6.0
#: Temperatures that are tried, and what a calibration row counts for the languages it is not of.
TEMPERATURES, DOUBT = np.exp(np.linspace(-8, 4, 97)), 0.5
#: Added to each bucket's count before its share of a language is taken.
PRIOR = 0.5
#: Bytes of a text that are hashed at once, so that memory does not grow with its length.
CHUNK = 1 << 16
UNDETERMINED = "und"


def pieces(text: str) -> Iterator[np.ndarray]:
    """The lower-cased letters of a text with one space between and around words, as bytes,
    in pieces of ``CHUNK`` bytes that end at a space (only a longer word is cut)."""
    body = f" {NO_LETTERS.sub(' ', text.lower()).strip()} ".encode()
    at = 0
    while at < len(body) - 2:
        end = body.rfind(b" ", at + 1, at + CHUNK)
        end = end if end > 0 else min(at + CHUNK, len(body)) - 1
        yield np.frombuffer(body[at:end + 1], dtype=np.uint8)
        at = end


def counts(text: str | None) -> np.ndarray:
    """How often each bucket occurs among the hashed n-grams of a text."""
    out = np.zeros(BUCKETS, dtype=np.int64)
    for data in pieces(text or ""):
        wide = data.astype(np.uint32)
        code = np.zeros(len(wide), dtype=np.uint32)
        for n in range(1, LONGEST + 1):
            if len(wide) < n:
                break
            code = code[:len(wide) - n + 1] * np.uint32(0x01000193) ^ wide[n - 1:]
            mixed = (code + np.uint32(n)) * np.uint32(0x9E3779B1) >> np.uint32(32 - BUCKET_BITS)
            out += np.bincount(mixed, minlength=BUCKETS)
    return out


@dataclass
class Model:
    languages: list[str]
    logits: np.ndarray  # BUCKETS x languages
    temperature: float = 1.0
    threshold: float = 0.0
    shares: np.ndarray | None = None  # languages x BUCKETS: logarithm of each bucket's share
    usual: np.ndarray | None = None  # of each language, the mean of that over its texts
    least: float = -np.inf  # familiarity

    def probabilities(self, mean_logits: np.ndarray) -> np.ndarray:
        z = mean_logits / self.temperature
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        bag = counts(text)
        if not self.languages or not bag.any():
            return UNDETERMINED, 0.0, True
        p = self.probabilities((bag / bag.sum()) @ self.logits)
        best = int(p.argmax())
        found = np.flatnonzero(bag)
        strange = self.shares is not None and self.familiarity(best, found, bag[found]) < self.least
        return self.languages[best], float(p[best]), bool(p[best] < self.threshold or strange)

    def familiarity(self, language: int, buckets: np.ndarray, times: np.ndarray) -> float:
        mean = self.shares[language, buckets] @ times / times.sum()
        return float(mean - self.usual[language] + SHORT / np.sqrt(len(buckets)))


def most_threshold(languages: int) -> float:
    """The largest threshold, above what a text that tells nothing gets."""
    return max(MOST_THRESHOLD, min(1.0, 1 / languages + MARGIN))


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[str]) -> Model:
    """SGD over (buckets, counts) bags."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), dtype=np.float32))
    rng = np.random.default_rng(7)
    table = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    weights = rng.normal(0, 0.1, (DIMENSIONS, len(languages)))
    wanted = np.array([languages.index(x) for x in labels])
    shares = [(b, (c / c.sum()).astype(np.float32)) for b, c in bags]
    held = np.arange(len(bags)) % CALIBRATION_SHARE == 0
    if len(bags) < 2 * CALIBRATION_SHARE:
        held[:] = False
    train = np.flatnonzero(~held)
    steps = EPOCHS * len(train)
    for step, i in enumerate(i for _ in range(EPOCHS) for i in rng.permutation(train)):
        rate = RATE * (1 - step / steps)
        b, share = shares[i]
        hidden = share @ table[b]
        z = hidden @ weights
        error = np.exp(z - z.max())
        error /= error.sum()
        error[wanted[i]] -= 1
        back = weights @ error
        weights -= rate * np.outer(hidden, error)
        table[b] -= rate * np.minimum(1.0, share * ROW_RATE)[:, None] * back
    model = Model(languages, (table @ weights).astype(np.float32))
    checked = np.flatnonzero(held)
    if len(checked):
        z = np.array([shares[i][1] @ model.logits[shares[i][0]] for i in checked], dtype=float)
        # half a row of doubt: where all are told apart, the best temperature would be zero
        target = np.full((len(z), len(languages)), DOUBT / len(z) / len(languages))
        target[np.arange(len(z)), wanted[checked]] += 1 - DOUBT / len(z)
        loss = []
        for t in TEMPERATURES:
            model.temperature = float(t)
            loss.append(-(target * np.log(np.maximum(model.probabilities(z), 1e-300))).sum(axis=1).mean())
        model.temperature = float(TEMPERATURES[int(np.argmin(loss))])
        p = model.probabilities(z)
        right = p.max(axis=1)[p.argmax(axis=1) == wanted[checked]]
        if len(right):
            model.threshold = float(min(most_threshold(len(languages)), np.quantile(right, REJECT_QUANTILE)))
        learn_familiarity(model, bags, wanted, train, checked)
    return model


def learn_familiarity(model: Model, bags: list[tuple[np.ndarray, np.ndarray]], wanted: np.ndarray,
                      train: np.ndarray, checked: np.ndarray) -> None:
    """Shares from the training part; what is usual, and the least, from the calibration part."""
    totals = np.full((len(model.languages), BUCKETS), PRIOR)
    for i in train:
        totals[wanted[i], bags[i][0]] += bags[i][1]
    model.shares = np.log(totals / totals.sum(axis=1, keepdims=True)).astype(np.float32)
    model.usual = np.zeros(len(model.languages))
    for k in range(len(model.languages)):
        own = [i for i in checked if wanted[i] == k] or [i for i in train if wanted[i] == k]
        mass = sum(bags[i][1].sum() for i in own)
        model.usual[k] = sum(model.shares[k, bags[i][0]] @ bags[i][1] for i in own) / max(1, mass)
    known = [model.familiarity(wanted[i], *bags[i]) for i in checked]
    model.least = float(min(-UNFAMILIAR, np.quantile(known, REJECT_QUANTILE)))


def training_rows(docs: DataFrame) -> Column:
    """Documents that may be learned from: labelled, and crc32 of the id not divisible by 5."""
    return F.col("lang").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0)


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit on about ``per_language`` documents of each language (fewer where that would be over
    ``SAMPLE_IN_ALL``), chosen by a hash of the id, and never more than twice as many."""
    small_batches(docs.sparkSession)
    rows = docs.filter(training_rows(docs) & F.col("text").isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    per_language = max(1, min(per_language, SAMPLE_IN_ALL // max(1, len(sizes))))
    size = F.element_at(F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair]), F.col("lang")) if sizes else F.lit(1)
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id"), size) < per_language).select("doc_id", "lang", "text")

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, ids, times = [], [], []
            for at, text in enumerate(batch["text"].to_pylist()):
                c = counts(text)
                if c.any():
                    keep.append(at)
                    ids.append(np.flatnonzero(c).astype(np.int32))
                    times.append(c[ids[-1]].astype(np.int32))
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(at), batch["lang"].take(at), pa.array(ids, pa.list_(pa.int32())),
                 pa.array(times, pa.list_(pa.int32()))], ["doc_id", "lang", "buckets", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    sample = cut(chosen.mapInArrow(reduced, f"doc_id {kind}, lang string, buckets array<int>, times array<int>"))
    # many rows of one id could pass the share: a hard bound, in an order that is the same each time
    got = (sample.orderBy("doc_id", "lang", F.xxhash64("buckets", "times")).limit(2 * per_language * max(1, len(sizes)))
           .toArrow().combine_chunks())
    bags = zip(*([row.values.to_numpy() for row in got[c]] for c in ("buckets", "times")), strict=True)
    return fit(list(bags), got["lang"].to_pylist())


@passes_columns
def predict_languages(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` with ``__lang``, ``__score`` and ``__rejected``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.logits, model.temperature, model.threshold, model.shares, model.usual, model.least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            rows = [own.predict(text) for text in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r[0] for r in rows], pa.string()),
                 pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.bool_())],
                [*passed, "__lang", "__score", "__rejected"])

    passed = docs.columns
    at = passed.index("text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kinds}, __lang string, __score double, __rejected boolean")
