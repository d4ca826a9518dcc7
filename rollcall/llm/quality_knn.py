"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text is a bag of terms: its words in lower case and its trigrams of code points, hashed to
a wide sparse space, and three surface shares (distinct words, words equal to the one
before, distinct lines).  Sublinear term weights, times the inverse document frequency in a
bounded labelled sample, are decomposed by a truncated SVD (randomised subspace iteration);
the leading directions are the latent space.  The directions and the labelled vectors are
broadcast (at most ``TERMS`` and ``SAMPLE`` rows of ``DIMENSIONS`` floats, whatever the
corpus size), every document is projected, its exact cosines with all
labelled vectors are computed in blocks, and the nearest neighbours vote with their
similarity as weight.

Defined results: a null text is an empty one; an empty text has no direction and gets the
mean label of the sample; with no labelled row at all every score is 0.5; repeated rows
get equal scores; further columns of the input are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import PrefixHash, mix

#: Labelled rows that are learned from at most; chosen by a hash of their id.
SAMPLE = 3000
DIMENSIONS = 48
NEIGHBOURS = 15
#: Documents whose cosines are computed in one block.
BLOCK = 256
THRESHOLD = 0.7

#: Places of words, then of trigrams, then the surface shares; a place fits 16 bits.
WORDS = 2**15
TERMS = 2**16
SURFACE = TERMS - 3
#: Directions iterated besides the wanted ones, and rounds of the iteration.
SPARE = 16
ROUNDS = 4

_HASH = PrefixHash(31)


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places of a text's terms, ascending, and their sublinear weights."""
    if not text:
        return np.zeros(0, np.uint16), np.zeros(0, np.float32)
    at = []
    data = b" ".join(text.lower().encode("utf-8", "replace").split())
    if data:
        raw = np.frombuffer(data, np.uint8)
        gaps = np.flatnonzero(raw == 32)
        hashes = _HASH.ranges(_HASH.prefixes(raw), np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(raw)])))
        at.append(hashes % np.uint64(WORDS))
    c = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    grams = mix((c[:-2] << np.uint64(42)) + (c[1:-1] << np.uint64(21)) + c[2:])
    at.append(grams % np.uint64(SURFACE - WORDS) + np.uint64(WORDS))
    places, counts = np.unique(np.concatenate(at), return_counts=True)
    weights = 1 + np.log(counts)
    words, lines = text.split(), text.split("\n")
    if words:
        same = sum(map(str.__eq__, words, words[1:]))
        shares = len(set(words)) / len(words), same / len(words), len(set(lines)) / len(lines)
        places, weights = np.concatenate((places, np.arange(SURFACE, TERMS))), np.concatenate((weights, shares))
    return places.astype(np.uint16), weights.astype(np.float32)


def scaled(places: np.ndarray, weights: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weights times ``idf``; those of the words, and those of the trigrams, of unit length."""
    out = weights * idf[places]
    ends = np.searchsorted(places, (0, WORDS, SURFACE))
    for a, b in zip(ends, ends[1:], strict=False):
        out[a:b] /= np.linalg.norm(out[a:b]) if b > a else 1
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


@dataclass
class Model:
    idf: np.ndarray  # by term
    axes: np.ndarray  # terms by latent dimensions
    centre: np.ndarray  # of the sample, in the latent space
    vectors: np.ndarray  # labelled rows, unit length
    labels: np.ndarray

    def project(self, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return scaled(places, weights, self.idf) @ self.axes[places] - self.centre

    @property
    def prior(self) -> float:
        return float(self.labels.mean()) if len(self.labels) else 0.5


def decompose(rows: list[tuple[np.ndarray, np.ndarray]], dimensions: int) -> np.ndarray:
    """Leading right singular vectors of sparse rows less their mean, by subspace iteration."""
    mean = np.zeros(TERMS)
    for places, weights in rows:
        mean[places] += weights / len(rows)
    width = min(dimensions + SPARE, len(rows))
    basis = np.random.default_rng(7).standard_normal((TERMS, width)).astype(np.float32)

    def times(basis: np.ndarray) -> np.ndarray:
        return np.stack([weights @ basis[places] for places, weights in rows]) - mean.astype(np.float32) @ basis

    for _ in range(ROUNDS):
        left = np.linalg.qr(times(basis))[0]
        basis = -np.outer(mean, left.sum(axis=0)).astype(np.float32)
        for (places, weights), row in zip(rows, left, strict=True):
            basis[places] += np.outer(weights, row)
        basis = np.linalg.qr(basis)[0]
    return basis @ np.linalg.svd(times(basis), full_matrices=False)[2].T[:, :dimensions]


def fit(labelled: DataFrame, sample: int = SAMPLE, dimensions: int = DIMENSIONS) -> Model:
    """Learn from (doc_id, text, label) rows, at most ``sample`` of them."""
    frame = labelled.select("doc_id", "text", F.col("label").cast("double").alias("label")).filter("label is not null")
    chosen = frame.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    vector = F.pandas_udf(_vectors, "binary")
    rows = (
        frame.join(chosen, "doc_id")
        .groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.avg("label").alias("label"))
        .select("doc_id", vector("text").alias("v"), "label").collect()
    )
    rows.sort(key=lambda r: r["doc_id"])
    if not rows:
        none = np.zeros((0, 1), np.float32)
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros(1, np.float32), none, np.zeros(0))
    found = [_unpacked(r["v"]) for r in rows]
    holders = np.zeros(TERMS)
    for places, _ in found:
        holders[places] += 1
    idf = (1 + np.log((1 + len(found)) / (1 + holders))).astype(np.float32)
    idf[SURFACE:] = 1
    axes = decompose([(places, scaled(places, weights, idf)) for places, weights in found], dimensions)
    model = Model(idf, axes, np.zeros(axes.shape[1], np.float32), np.zeros((0, 1)), np.array([r["label"] for r in rows], np.float32))
    raw = np.stack([model.project(*row) for row in found])
    model.centre = raw.mean(axis=0)
    model.vectors = _unit(raw - model.centre)
    return model


def _vectors(column: pd.Series) -> pd.Series:
    """Four bytes a term, since those of the sample go to the driver."""
    found = map(terms, column)
    return pd.Series([places.tobytes() + weights.astype(np.float16).tobytes() for places, weights in found], dtype=object)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    half = len(data) // 2
    return np.frombuffer(data[:half], np.uint16), np.frombuffer(data[half:], np.float16).astype(np.float32)


def votes(model: Model, column: list[str | None], neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest labelled vectors."""
    found = [terms(t) for t in column]
    out = np.full(len(found), model.prior)
    full = np.array([len(places) > 0 for places, _ in found], bool)
    k = min(neighbours, len(model.labels))
    if not k or not full.any():
        return out
    cosines = _unit(np.stack([model.project(*row) for row in found if len(row[0])])) @ model.vectors.T
    near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    weight = np.clip(np.take_along_axis(cosines, near, axis=1), 0, None).astype(np.float64) + 1e-9
    out[full] = (weight * model.labels[near]).sum(axis=1) / weight.sum(axis=1)
    return np.clip(out, 0, 1)


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The score of each text as a column expression; the model is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def voted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            values = batch.tolist()
            blocks = [votes(shared.value, values[i : i + BLOCK]) for i in range(0, len(values), BLOCK)]
            yield pd.Series(np.concatenate(blocks) if blocks else np.zeros(0))

    return voted(F.col(text))


def held_out(doc_id: str = "doc_id") -> Column:
    """The quarter of the ids that no label is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit_documents(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the labelled documents outside the held-out quarter.

    Of several labels of a document the mean counts; null ones are no labels.
    """
    known = labels.select("doc_id", F.col("quality").alias("label")).filter(F.col("label").isNotNull() & ~held_out())
    rows = known.groupBy("doc_id").agg(F.avg("label").alias("label"))
    return fit(docs.select("doc_id", "text").join(rows, "doc_id"))


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    scored = docs.select("doc_id", held_out().alias("held_out"), score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns kept."""
    return docs.filter(score(docs, model) >= threshold)
