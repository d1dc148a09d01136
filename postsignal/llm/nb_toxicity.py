"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Wang and Manning, "Baselines and bigrams" (2012). A text's features are the hashed 3- to 5-grams of its
distinct words, word ends included. The log-count ratios come from all documents to learn from; a logistic
regression on the scaled features is fitted to a bounded sample of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsignal.llm.common import (
    ALPHANUMERIC,
    COUNT_ROWS,
    LOWER,
    Texts,
    batches,
    count_rows,
    labelled,
    labelled_sample,
    mix,
    remainder,
    slices,
    total_counts,
)

FEATURES = 1 << 17
GRAMS = (3, 4, 5)
#: Labelled documents in the regression at most, its rounds, and the weight of its penalty.
SAMPLE = 5000
ROUNDS = 80
PENALTY = 1e-3
THRESHOLD = 0.5
#: Features of the regression that the driver works on at a time.
ENTRIES = 1 << 19
_BYTES = np.random.default_rng(4).integers(1, 1 << 62, (max(GRAMS), 256), dtype=np.uint64)
_PLAIN = np.where(ALPHANUMERIC, LOWER, 32).astype(np.uint8)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for ``counts[0]`` numbers, and so on."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def grams(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features of the slice's distinct words, their number per word, each token's word, and ``bounds``."""
    starts, ends, hashes, bounds = texts.tokens(ALPHANUMERIC)
    _, first, word = np.unique(hashes, return_index=True, return_inverse=True)
    low, high = starts[first], ends[first]
    data = np.concatenate(([32], _PLAIN[texts.data])).astype(np.uint8)  # place p of the text is p + 1 here
    length = high - low
    own, sizes, keys = [], [], []
    for n in GRAMS:
        number = np.maximum(length + 3 - n, 0)
        at = _ragged(low, number)
        total = np.full(len(at), n, np.uint64)
        for i in range(n):
            total += _BYTES[i][data[at + i]]
        own.append((mix(total) % np.uint64(FEATURES)).astype(np.int64))
        sizes.append(number)
        keys.append(np.repeat(np.arange(len(number)), number))
    order = np.argsort(np.concatenate(keys), kind="stable")
    return np.concatenate(own)[order], np.sum(sizes, axis=0), word, bounds


def _distinct(word: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    for low, high in zip(bounds[:-1], bounds[1:]):
        yield np.unique(word[low:high])


def _class_counts(rows: DataFrame) -> np.ndarray:
    """Per label and feature, the distinct words of documents that hold it."""

    def work(parts):
        counts = np.zeros(2 * FEATURES, np.int64)
        for part in parts:
            labels = part.column(1).to_numpy(zero_copy_only=False)
            for texts in slices(part.column(0)):
                found, number, word, bounds = grams(texts)
                times = np.zeros((2, len(number)), np.int64)
                for row, words in zip(texts.rows, _distinct(word, bounds)):
                    times[labels[row], words] += 1
                for label in (0, 1):
                    counts[label * FEATURES : (label + 1) * FEATURES] += np.bincount(
                        found, weights=np.repeat(times[label], number), minlength=FEATURES
                    ).astype(np.int64)
        yield from count_rows(counts)

    return total_counts(batches(rows, work, COUNT_ROWS), 2 * FEATURES).reshape(2, FEATURES)


def _blocks(ends: np.ndarray) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """Documents, their places in the features, and each place's document in the block, ``ENTRIES`` places at a time."""
    low = 0
    while low < len(ends):
        start = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, start + ENTRIES, side="right")))
        sizes = np.diff(ends[low:high], prepend=start)
        yield slice(low, high), slice(start, ends[high - 1]), np.repeat(np.arange(high - low), sizes)
        low = high


def _regression(at: np.ndarray, ends: np.ndarray, ratio: np.ndarray, labels: np.ndarray) -> Model:
    """Weights that lower the logistic loss, classes weighted alike, by accelerated gradient steps (Adam).

    The features of document i are ``at[ends[i - 1]:ends[i]]``, each of the value that ``ratio`` gives it.
    """
    n = len(labels)
    share = np.clip(np.bincount(labels, minlength=2) / max(n, 1), 1e-9, None)
    cost = (0.5 / share)[labels] / max(n, 1)
    weights, bias = np.zeros(FEATURES), 0.0
    first, second, first_b, second_b = np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 0.0
    for step in range(1, ROUNDS + 1):
        scaled, slope, slope_b = weights * ratio, np.zeros(FEATURES), 0.0
        for documents, places, row in _blocks(ends):
            own = at[places]
            margin = np.bincount(row, weights=scaled[own], minlength=documents.stop - documents.start) + bias
            error = cost[documents] * (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels[documents])
            slope += np.bincount(own, weights=error[row], minlength=FEATURES)
            slope_b += error.sum()
        slope = slope * ratio + PENALTY / FEATURES * weights
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        first_b, second_b = 0.9 * first_b + 0.1 * slope_b, 0.99 * second_b + 0.01 * slope_b**2
        rate = 0.05 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        weights -= rate * first / (np.sqrt(second) + 1e-6)
        bias -= rate * first_b / (np.sqrt(second_b) + 1e-6)
    return Model(weights, float(bias))


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of the labelled documents that are there; several rows of one id count in the ratios, one in the sample."""
    # One plan at every size: both sides are dealt by id, so what is shuffled grows with the input.
    known = labelled(labels, "toxic").hint("shuffle_hash")
    learn = documents.filter("doc_id IS NOT NULL").join(known, "doc_id").select("text", "label")
    counts = _class_counts(learn) + 1.0
    if (counts == 1).all():
        return Model(np.zeros(FEATURES), 0.0)
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())

    def work(parts):
        for part in parts:
            for texts in slices(part.column(1)):
                found, number, word, bounds = grams(texts)
                ends = np.cumsum(number)
                data = []
                for words in _distinct(word, bounds):
                    data.append(np.unique(found[_ragged((ends - number)[words], number[words])]).astype(np.int32).tobytes())
                rows = slice(texts.rows.start, texts.rows.stop)
                yield pa.record_batch([part.column(0)[rows], pa.array(data, pa.binary()), part.column(2)[rows]], ["doc_id", "features", "label"])

    chosen, _ = labelled_sample(documents, labels, "toxic", sample)
    rows = batches(chosen.select("doc_id", "text", "label"), work, "doc_id long, features binary, label int").orderBy("doc_id").collect()
    own = [np.frombuffer(row.features, np.int32) for row in rows]
    given = np.array([row.label for row in rows], np.int64)
    at, ends = np.concatenate(own), np.cumsum([len(o) for o in own])
    del rows, own
    fitted = _regression(at, ends, ratio, given)
    return Model(fitted.weights * ratio, fitted.bias)


def toxicity_scores(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; labels of held-out documents are not read.

    A null or empty text, or one without words, scores by the bias alone. Repeated rows get equal scores;
    without labels every score is 0.5. Other columns are not read.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = documents.sparkSession.sparkContext.broadcast(fit(documents, labels))

    def work(parts):
        weights, bias = model.value.weights, model.value.bias
        for part in parts:
            margin = np.full(part.num_rows, bias)
            for texts in slices(part.column(1)):
                found, number, word, bounds = grams(texts)
                ends = np.cumsum(number)
                for row, words in zip(texts.rows, _distinct(word, bounds)):
                    own = np.unique(found[_ragged((ends - number)[words], number[words])])
                    margin[row] += weights[own].sum()
            score = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
            yield pa.record_batch([part.column(0), pa.array(score)], ["doc_id", "score"])

    scored = batches(documents, work, "doc_id long, score double")
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
