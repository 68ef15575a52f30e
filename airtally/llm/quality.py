"""Quality classifier: learned hashed word and character n-gram vectors, averaged per document.

Words, pairs of neighbouring words and byte n-grams are hashed into one table of vectors. A
document is the mean of its vectors and a softmax layer gives the classes; both are learned by
stochastic gradient descent in numpy on a bounded sample of labelled rows. As the
mean and the layer are linear, the difference of the two outputs is stored per bucket, and
scoring is the mean of one number per n-gram: exactly the model's output.

A pair hashes as the exclusive or of its words, so a word next to itself always meets one
bucket and repetition can be learned.

Cases: a null or empty text has no n-gram and scores by the intercept; a text of any length is
read whole, in pieces cut between words; a score of exactly 0.3 predicts 1; repeated rows each get
a row; a null id gets a score and is not held out; without labelled rows of both classes every
score is the share of good labels (0.5 without any). Other input columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtally.llm import common, words

BITS = 16
WIDTH = 12
GRAMS = (3, 4)
#: Training rows of each class at most.
PER_CLASS = 3000
_BLANKS = " \t\n\v\f\r"


def _cuts(text: str) -> Iterator[str]:
    """The text in pieces that end after white space, or with the text.

    A piece without white space grows by the next one, so that no word is cut.
    """
    held = ""
    for at in range(0, len(text), common.PIECE):
        held += text[at:at + common.PIECE]
        if at + common.PIECE >= len(text):
            yield held
        elif end := max(held.rfind(blank) for blank in _BLANKS) + 1:
            yield held[:end]
            held = held[end:]


def hashed(text: str) -> Iterator[np.ndarray]:
    """Bucket of every n-gram of a text, repeats included, in arrays of bounded size.

    Words are bound by ASCII white space. The last word and the last bytes of a piece go with the
    next one, so the n-grams are those of the whole text.
    """
    word, tail = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    for piece in _cuts(text):
        data = np.frombuffer(piece.encode("utf-8"), np.uint8)
        hashes = words.word_hashes(data)
        chain = np.concatenate([word, hashes])
        out = [words.mixed(hashes), words.mixed((chain[1:] ^ chain[:-1]) + np.uint64(1))]
        wide = np.concatenate([tail, data.astype(np.uint64) + np.uint64(1)])
        for n in GRAMS:
            # Runs that lie in the tail alone came with the piece before.
            run = wide[max(len(tail) - n + 1, 0):]
            if len(run) >= n:
                total = np.zeros(len(run) - n + 1, np.uint64)
                for k in range(n):
                    total = (total << np.uint64(9)) | run[k:len(run) - n + 1 + k]
                out.append(words.mixed(total + np.uint64(n << 60)))
        word, tail = chain[-1:], wide[-(GRAMS[-1] - 1):]
        yield (np.concatenate(out) >> np.uint64(64 - BITS)).astype(np.int64)


def buckets(text: str) -> np.ndarray:
    """Bucket of every n-gram of a text, repeats included."""
    return np.concatenate([np.zeros(0, np.int64), *hashed(text)])


@dataclass(frozen=True)
class Model:
    """``logits``: what a bucket adds to the log odds of class 1."""

    logits: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        total, count = 0.0, 0
        for found in hashed(text):
            total, count = total + float(self.logits[found].sum(dtype=np.float64)), count + len(found)
        return common.sigmoid(self.bias + total / max(count, 1))


def fit(texts: list[str], labels: np.ndarray, epochs: int = 6, rate: float = 1.0) -> Model:
    """Vectors and output layer by stochastic gradient descent with a falling rate."""
    size = 1 << BITS
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        return Model(np.zeros(size), float(np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -40, 40)))
    features = []
    for text in texts:
        found, counts = np.unique(buckets(text), return_counts=True)
        features.append((found, (counts / max(counts.sum(), 1)).astype(np.float32)))
    order = np.random.default_rng(11)
    vectors = order.uniform(-1.0 / WIDTH, 1.0 / WIDTH, (size, WIDTH)).astype(np.float32)
    layer, bias = np.zeros((2, WIDTH), np.float32), np.zeros(2, np.float32)
    weight = len(labels) / (2.0 * np.array([(labels == c).sum() for c in (0, 1)]))
    done, total = 0, epochs * len(labels)
    for _ in range(epochs):
        for i in order.permutation(len(labels)):
            found, share = features[i]
            hidden = share @ vectors[found]
            out = layer @ hidden + bias
            out = np.exp(out - out.max())
            slope = out / out.sum()
            slope[labels[i]] -= 1.0
            slope *= rate * (1.0 - done / total) * weight[labels[i]]
            back = slope @ layer
            layer -= np.outer(slope, hidden)
            bias -= 0.1 * slope
            # A document's mean spreads a step over all its n-grams; the factor undoes that.
            vectors[found] -= np.outer(share * min(len(found), 200), back)
            done += 1
    # The same numbers, but what is computed from them is not rounded to single precision.
    logits = (vectors @ (layer[1] - layer[0])).astype(np.float64)
    return Model(logits, float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, fold: int = 0,
          per_class: int = PER_CLASS) -> Model:
    rows = common.training_rows(docs, labels, label, folds, fold, per_class)

    def work(texts: list[str], values: np.ndarray) -> list[bytes]:
        model = fit(texts, values)
        return [model.logits.astype(np.float32).tobytes(), np.float64(model.bias).tobytes()]

    logits, bias = common.fit_in_one_task(rows, work)
    return Model(np.frombuffer(logits, np.float32), float(np.frombuffer(bias, np.float64)[0]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [shared.value.score(text) for text in common.texts_of(batch)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())],
                                          ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return common.map_batches(docs.select("doc_id", "text"), work, f"doc_id {kind}, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores with the held-out flag and the decision at 0.3."""
    return score(docs, train(docs, labels)).select(
        "doc_id", common.in_fold(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))
