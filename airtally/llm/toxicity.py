"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Every distinct hashed character n-gram of a lower-cased text is a binary feature. On a
bounded sample of labelled rows the log ratio ``r`` of its rates in toxic and other texts
is computed; n-grams whose counts do not differ clearly between the classes get ``r = 0``.
Logistic regression is then trained on the features ``r * presence``. Scoring adds up
the weights of the n-grams a text holds.

Cases: a null or empty text scores as a text without n-grams (the intercept); a text of any
length is read whole, in pieces; a score of exactly 0.5 predicts 1; repeated rows each get a row; a null id gets a score and is not held out; without labelled rows of both
classes every score is the share of toxic labels (0.5 without any). Other input columns are
not read, so clashing names cannot matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtally.llm import common

BITS = 18
LENGTHS = (3, 4, 5)
#: Training rows of each class at most.
PER_CLASS = 3000
#: Standard deviations by which an n-gram's counts must differ between the classes.
CLEAR = 4.0
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                         0xA0761D6478BD642F], np.uint64)


def hashed(text: str) -> Iterator[np.ndarray]:
    """Feature numbers of a text's n-grams, repeats included, in arrays of bounded size.

    The lower-cased text has a blank at each end. Pieces overlap, so the n-grams over their edges
    are those of the whole text; shorter ones in the overlap come twice.
    """
    text = f" {text.lower()} "
    for at in range(0, len(text), common.PIECE):
        piece = text[max(0, at - LENGTHS[-1] + 1):at + common.PIECE]
        codes = np.frombuffer(piece.encode("utf-32-le"), np.uint32).astype(np.uint64)
        total = codes * _MULTIPLIERS[0]
        for k in range(1, LENGTHS[-1]):
            if len(codes) <= k:
                break
            total = total[:-1] + codes[k:] * _MULTIPLIERS[k]
            if k + 1 >= LENGTHS[0]:
                yield (((total ^ (total >> np.uint64(29))) * _MULTIPLIERS[4]) >> np.uint64(64 - BITS)).view(np.int64)


def ngrams(text: str) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    seen = np.zeros(1 << BITS, bool)
    for found in hashed(text):
        seen[found] = True
    return np.flatnonzero(seen)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        """Only n-grams with a weight are made distinct; the others add nothing."""
        hits = [found[self.weights[found] != 0] for found in hashed(text)]
        return common.sigmoid(self.bias + float(self.weights[np.unique(np.concatenate(hits or [[]])).astype(int)].sum()))


def ratios(features: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Naive Bayes log-count ratio of each n-gram, 0 where the classes do not differ clearly."""
    size = 1 << BITS
    counts = [np.bincount(np.concatenate([f for f, y in zip(features, labels) if y == c]), minlength=size)
              for c in (0, 1)]
    share = labels.mean()
    total = counts[0] + counts[1]
    spread = np.sqrt(np.maximum(total, 1) * share * (1 - share))
    clear = np.abs(counts[1] - total * share) >= CLEAR * spread
    rates = [(1.0 + counts[c]) / (1.0 + (labels == c).sum()) for c in (0, 1)]
    return np.where(clear, np.log(rates[1] / rates[0]), 0.0)


def fit(texts: list[str], labels: np.ndarray, epochs: int = 12, rate: float = 0.2, l2: float = 1e-4) -> Model:
    """Logistic regression on ratio-scaled n-grams by adaptive stochastic gradient steps."""
    size = 1 << BITS
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        return Model(np.zeros(size), float(np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -40, 40)))
    features = [ngrams(text) for text in texts]
    r = ratios(features, labels)
    features = [f[r[f] != 0] for f in features]
    w, squares = np.zeros(size), np.full(size, 1e-3)
    bias, bias_squares = 0.0, 1e-3
    weight = len(labels) / (2.0 * np.array([(labels == c).sum() for c in (0, 1)]))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(labels)):
            f = features[i]
            slope = (common.sigmoid(bias + float(w[f] @ r[f])) - labels[i]) * weight[labels[i]]
            step = slope * r[f] + l2 * w[f]
            squares[f] += step * step
            w[f] -= rate * step / np.sqrt(squares[f])
            bias_squares += slope * slope
            bias -= rate * slope / np.sqrt(bias_squares)
    return Model(w * r, float(bias))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, fold: int = 0,
          per_class: int = PER_CLASS) -> Model:
    rows = common.training_rows(docs, labels, label, folds, fold, per_class)

    def work(texts: list[str], values: np.ndarray) -> list[bytes]:
        model = fit(texts, values)
        return [model.weights.astype(np.float32).tobytes(), np.float64(model.bias).tobytes()]

    weights, bias = common.fit_in_one_task(rows, work)
    return Model(np.frombuffer(weights, np.float32), float(np.frombuffer(bias, np.float64)[0]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [shared.value.score(text) for text in common.texts_of(batch)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())],
                                          ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return common.map_batches(docs.select("doc_id", "text"), work, f"doc_id {kind}, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores with the held-out flag and the decision at 0.5."""
    return score(docs, train(docs, labels)).select(
        "doc_id", common.in_fold(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
