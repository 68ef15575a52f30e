"""Language identification with hyperdimensional profiles.

Every letter of Unicode, lower-cased, and the gap between words have a random vector of +1 and
-1 of their own, derived from the code point. A letter trigram is the product of its letters'
vectors, rotated by their place; a document is the sum (bundle) of its trigrams' vectors, a
language the sum of its documents. The language with the largest cosine wins. Bundling is
linear, so each distinct trigram of a text is bound once; all training rows count.

Cases: null text, or text without a letter: ``und``, score 0; texts of any length are read whole,
in pieces; ties go to the smaller language name; repeated rows each get a row and count as often
as they occur; null languages are not learned from; a null id is not held out; nothing to learn
from: ``und`` for all; over ``MOST_LANGUAGES`` languages training is refused. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtally.llm import common

DIMENSIONS = 1024
#: Languages that a model may hold; beyond it training is refused, not cut.
MOST_LANGUAGES = 10_000
#: Languages a task sums before it hands them on.
_HELD = 64
#: Distinct trigrams bound at a time, and trigrams whose vectors a worker remembers.
_BOUND, _KNOWN = 1 << 12, 1 << 15
#: Bits of a code point.
_CODE = 21


@cache
def _letters() -> np.ndarray:
    """Lower-case code point of each letter, 0 for other characters."""
    out = np.zeros(0x110000, np.int64)
    for code in range(0x110000):
        if (letter := chr(code)).isalpha():
            out[code] = ord(letter.lower()[0])
    return out


@lru_cache(1 << 14)
def letter_vector(code: int) -> np.ndarray:
    """The random vector of a letter, or of the gap (0)."""
    return np.random.default_rng((3, code)).choice(np.array([-1, 1], np.int8), DIMENSIONS)


def bound(grams: np.ndarray) -> np.ndarray:
    """The vector of each trigram: its letters' vectors rotated by their place and multiplied."""
    out = np.ones((len(grams), DIMENSIONS), np.int8)
    for place in range(3):
        codes = (grams >> (_CODE * (2 - place))) & ((1 << _CODE) - 1)
        found, which = np.unique(codes, return_inverse=True)
        out *= np.roll(np.array([letter_vector(int(c)) for c in found]), 2 - place, axis=1)[which]
    return out


class _Vectors:
    """Vectors of the trigrams met first, for as many as fit; others are bound when asked for."""

    def __init__(self) -> None:
        self.grams = np.zeros(0, np.int64)
        self.rows = np.zeros((0, DIMENSIONS), np.int8)

    def of(self, grams: np.ndarray) -> np.ndarray:
        """The vectors of sorted distinct trigrams."""
        at = np.searchsorted(self.grams, grams)
        known = at < len(self.grams)
        known[known] = self.grams[at[known]] == grams[known]
        if known.all():
            return self.rows[at]
        new = grams[~known]
        made = bound(new)
        out = np.empty((len(grams), DIMENSIONS), np.int8)
        out[known], out[~known] = self.rows[at[known]], made
        if len(self.grams) + len(new) <= _KNOWN:
            order = np.argsort(both := np.concatenate([self.grams, new]))
            self.grams, self.rows = both[order], np.concatenate([self.rows, made])[order]
        return out


_vectors = cache(_Vectors)


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Sorted distinct trigrams of letters and their counts, runs of other characters being one
    gap; None without a letter."""
    grams, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    last, any_letter = np.zeros(1, np.int64), False
    for at in range(0, len(text) + 1, common.PIECE):
        piece = text[at:at + common.PIECE]
        codes = _letters()[np.frombuffer(piece.encode("utf-32-le"), np.uint32)]
        any_letter |= bool(codes.any())
        end = at + common.PIECE > len(text)
        codes = np.concatenate([last, codes, np.zeros(int(end), np.int64)])
        keep = codes != 0
        keep[1:] |= codes[:-1] != 0
        keep[0] = True
        codes = codes[keep]
        if len(codes) >= 3:
            found = np.unique((codes[:-2] << (2 * _CODE)) | (codes[1:-1] << _CODE) | codes[2:], return_counts=True)
            grams, counts = found if not len(grams) else _added((grams, counts), found)
        last = codes[-2:]
    return (grams, counts) if any_letter else None


def _added(*parts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram counts added up."""
    grams, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.zeros(len(grams), np.int64)
    np.add.at(counts, which, np.concatenate([p[1] for p in parts]))
    return grams, counts


def bundle(found: tuple[np.ndarray, np.ndarray], kind: type = np.float32) -> np.ndarray:
    """The sum of the trigrams' vectors. Sums are whole numbers: exact in float64."""
    grams, counts = found
    total = np.zeros(DIMENSIONS, kind)
    for at in range(0, len(grams), _BOUND):
        part = slice(at, at + _BOUND)
        total += counts[part].astype(kind) @ _vectors().of(grams[part]).astype(kind)
    return total


def train(docs: DataFrame, folds: int = 4, fold: int = 2) -> tuple[list[str], np.ndarray]:
    """Languages and their unit vectors, from all documents outside the held-out fold."""
    rows = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                       & ~common.in_fold(F.col("doc_id"), folds, fold)).select("lang", "text"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array([v.tolist() for v in held.values()], pa.list_(pa.int64()))],
                ["lang", "bundle"])

        for batch in batches:
            found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), common.texts_of(batch)):
                if (grams := trigrams(text)) is not None:
                    found.setdefault(lang, []).append(grams)
            for lang, parts in found.items():
                if lang not in held and len(held) == _HELD:
                    yield out()
                    held.clear()
                vector = bundle(_added(*parts), np.float64).astype(np.int64)
                held[lang] = held[lang] + vector if lang in held else vector
        if held:
            yield out()

    totals = (rows.mapInArrow(sums, "lang string, bundle array<bigint>")
              .select("lang", F.posexplode("bundle").alias("place", "value"))
              .groupBy("lang", "place").agg(F.sum("value").alias("value"))
              .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("cells"))
              .limit(MOST_LANGUAGES + 1).collect())
    if len(totals) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages")
    totals.sort(key=lambda row: row["lang"])
    vectors = np.array([[cell["value"] for cell in row["cells"]] for row in totals], np.float64).reshape(
        len(totals), DIMENSIONS)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return [row["lang"] for row in totals], vectors / np.maximum(norms, 1e-12)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, prototypes = shared.value
        langs, scores = [], []
        for text in common.texts_of(batch):
            found = trigrams(text) if names else None
            if found is None:
                langs.append("und")
                scores.append(0.0)
                continue
            vector = bundle(found)
            near = prototypes @ vector / max(float(np.linalg.norm(vector)), 1e-12)
            best = int(near.argmax())
            langs.append(names[best])
            scores.append(float(np.clip(near[best], 0.0, 1.0)))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
            ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return common.map_batches(docs.select("doc_id", "text"), work,
                              f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs)).select(
        "doc_id", common.in_fold(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
