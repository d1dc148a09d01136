"""Quality classifier: similarity-weighted votes of the nearest labelled documents in a latent-semantic space.

A document is a bag of words and word pairs, and one of word shapes (letter case, digits and symbols, runs cut to
one) and of words that repeat the word before them. Both are hashed, weighted by inverse document frequencies of all
documents, and brought to a fixed share of the vector's length, so neither drowns the other. A bounded sample of
labelled documents gives the singular vectors of both together and the labelled vectors, which are broadcast; every
document is compared with all of them, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsignal.llm.common import NOT_SPACE, Texts, batches, labelled_sample, mix, remainder, slices

#: Features: hashed shapes, then the repeated words, then hashed words and word pairs.
SHAPES = 2048
REPEATS = SHAPES - 1
FEATURES = 8192
#: Share of a vector's squared length that words and pairs have.
WORD_SHARE = 0.3
#: Labelled documents to learn from at most, latent dimensions, neighbours that vote, documents in a block.
SAMPLE = 4000
RANK = 96
NEIGHBOURS = 15
BLOCK = 256
THRESHOLD = 0.3
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("a") : ord("z") + 1] = _SHAPE[128:] = ord("a")
_SHAPE[ord("0") : ord("9") + 1] = ord("0")


@dataclass(frozen=True)
class Model:
    """Weights of the features, their latent directions, and the labelled vectors with their labels.

    ``rates``: how many labelled documents each vector stands for.
    """

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    rates: np.ndarray

    @property
    def prior(self) -> float:
        return float((self.labels * self.rates).sum() / self.rates.sum()) if len(self.labels) else 0.5


def features(texts: Texts) -> np.ndarray:
    """Counts of every feature in every text of a slice."""
    _, _, words, bounds = texts.tokens(NOT_SPACE)
    shaped = Texts(texts.rows, [])
    shape = _SHAPE[texts.data]
    shaped.data = shape[np.concatenate(([True], shape[1:] != shape[:-1]))]
    shaped.offsets = texts.offsets[:1]
    _, _, shapes, _ = shaped.tokens(NOT_SPACE, lower=False)
    text = np.repeat(np.arange(len(texts.rows)), np.diff(bounds))
    ids = (shapes % np.uint64(REPEATS)).astype(np.int64)
    again = np.zeros(len(words), bool)
    after = np.flatnonzero(text[1:] == text[:-1]) + 1
    again[after] = words[after] == words[after - 1]
    hashed = np.concatenate((mix(words), mix(words[after] + mix(words[after - 1]))))
    known = SHAPES + (hashed % np.uint64(FEATURES - SHAPES)).astype(np.int64)
    owner = np.concatenate((text, text[after]))
    places = np.concatenate((text * FEATURES + ids, text[again] * FEATURES + REPEATS, owner * FEATURES + known))
    return np.bincount(places, minlength=len(texts.rows) * FEATURES).reshape(-1, FEATURES)


def _frequencies(documents: DataFrame) -> tuple[int, np.ndarray]:
    """All documents, and those in which each feature occurs."""

    def work(parts):
        found, rows = np.zeros(FEATURES + 1, np.int64), 0
        for part in parts:
            for texts in slices(part.column(0)):
                found[:-1] += (features(texts) > 0).sum(axis=0)
                found[-1] += len(texts.rows)
        at = np.flatnonzero(found)
        yield pa.record_batch([pa.array(at), pa.array(found[at])], ["feature", "n"])

    rows = batches(documents.select("text"), work, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    counts = np.zeros(FEATURES + 1, np.int64)
    for row in rows.collect():
        counts[row.feature] = row.n
    return int(counts[-1]), counts[:-1]


def _weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Roots of counts, weighted; shapes and words each have their share of a length of 1. A text without words is 0."""
    out = np.empty(counts.shape, np.float32)
    for part, share in ((slice(0, SHAPES), 1 - WORD_SHARE), (slice(SHAPES, FEATURES), WORD_SHARE)):
        out[:, part] = _unit(np.sqrt(counts[:, part].astype(np.float32)) * weights[part].astype(np.float32)) * np.float32(share**0.5)
    return out


class _Sample:
    """Weighted vectors of the labelled documents, kept as their non-zero places; products run over dense blocks of them."""

    def __init__(self, rows: list, weights: np.ndarray):
        self.places, self.values = [], []
        for row in rows:
            own = np.zeros((1, FEATURES), np.int64)
            own[0, np.frombuffer(row.features, np.int32)] = np.frombuffer(row.counts, np.int64)
            vector = _weighted(own, weights)[0]
            self.places.append(np.flatnonzero(vector).astype(np.int32))
            self.values.append(vector[self.places[-1]])

    def _blocks(self) -> Iterator[tuple[slice, np.ndarray]]:
        for low in range(0, len(self.places), BLOCK):
            rows = slice(low, min(low + BLOCK, len(self.places)))
            dense = np.zeros((rows.stop - low, FEATURES), np.float32)
            for i, (places, values) in enumerate(zip(self.places[rows], self.values[rows])):
                dense[i, places] = values
            yield rows, dense

    def times(self, right: np.ndarray) -> np.ndarray:
        out = np.empty((len(self.places), right.shape[1]), np.float32)
        for rows, dense in self._blocks():
            out[rows] = dense @ right
        return out

    def turned_times(self, left: np.ndarray) -> np.ndarray:
        """Feature by column: the transposed vectors times ``left``."""
        out = np.zeros((FEATURES, left.shape[1]), np.float32)
        for rows, dense in self._blocks():
            out += dense.T @ left[rows]
        return out

    def directions(self, rank: int) -> np.ndarray:
        """The leading right singular vectors, by subspace iteration from a fixed start."""
        if not self.places:
            return np.zeros((FEATURES, 0), np.float32)
        start = np.random.default_rng(9).normal(size=(FEATURES, rank + 16)).astype(np.float32)
        base, _ = np.linalg.qr(self.times(start))
        for _ in range(3):
            base, _ = np.linalg.qr(self.times(self.turned_times(base)))
        left, _, _ = np.linalg.svd(self.turned_times(base), full_matrices=False)
        return left[:, :rank].astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return (rows / np.where(length > 0, length, 1)).astype(np.float32)


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, rank: int = RANK) -> Model:
    total, found = _frequencies(documents)
    weights = np.log((1 + total) / (1 + found)) + 1

    def work(parts):
        for part in parts:
            for texts in slices(part.column(1)):
                counts = features(texts)
                at = [np.flatnonzero(row) for row in counts]
                yield pa.record_batch(
                    [
                        part.column(0)[texts.rows.start : texts.rows.stop],
                        pa.array([a.astype(np.int32).tobytes() for a in at], pa.binary()),
                        pa.array([row[a].astype(np.int64).tobytes() for row, a in zip(counts, at)], pa.binary()),
                        part.column(2)[texts.rows.start : texts.rows.stop],
                    ],
                    ["doc_id", "features", "counts", "label"],
                )

    chosen, rates = labelled_sample(documents, labels, "quality", sample)
    rows = batches(chosen.select("doc_id", "text", "label"), work, "doc_id long, features binary, counts binary, label int")
    rows = rows.orderBy("doc_id").collect()
    vectors = _Sample(rows, weights)
    directions = vectors.directions(rank)
    labelled = np.array([row.label for row in rows], np.float64)
    return Model(weights, directions, _unit(vectors.times(directions)), labelled, np.array([rates[row.label] for row in rows], np.float64))


def votes(model: Model, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Share of label 1 among the nearest labelled vectors (all tied ones included), weighted by cosine and by
    the documents that a vector stands for."""
    out = np.full(len(counts), model.prior)
    n = len(model.labels)
    for at in range(0, len(counts) if n else 0, BLOCK):
        vectors = _unit(_weighted(counts[at : at + BLOCK], model.weights) @ model.directions)
        cosine = vectors @ model.vectors.T
        least = np.partition(cosine, max(0, n - neighbours), axis=1)[:, [max(0, n - neighbours)]]
        weight = np.where(cosine >= least, np.maximum(cosine, 0), 0).astype(np.float64) * model.rates
        total = weight.sum(axis=1)
        share = (weight @ model.labels) / np.where(total > 0, total, 1)
        out[at : at + BLOCK] = np.where(total > 0, np.clip(share, 0, 1), model.prior)
    return out


def with_quality(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All rows and columns of ``documents`` and each text's score, from 0 to 1, as column ``name``.

    An empty or null text, or one of white space, gets the share of label 1 in the sample (0.5 without a sample).
    """
    known = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    def work(parts):
        for part in parts:
            score = np.zeros(part.num_rows)
            for texts in slices(part.column(at)):
                score[texts.rows.start : texts.rows.stop] = votes(known.value, features(texts))
            yield pa.record_batch([*part.columns, pa.array(score)], [*part.schema.names, name])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return batches(documents, work, f"{kinds}, `{name}` double")


def quality_scores(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; labels of held-out documents are not read.

    Repeated rows get equal scores. Without labels every score is 0.5. Other columns are not read.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = with_quality(documents, fit(documents, labels))
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
