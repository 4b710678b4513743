"""Quality scores by nearest neighbours among labelled latent-semantic vectors.

A text becomes the counts of its hashed three-byte sequences, damped by a logarithm, weighted by
inverse document frequency, joined by two terms for repetition (of near words, of lines), and
projected on the leading singular vectors of the labelled sample.
The labelled vectors are broadcast; for every block of documents the cosines with all of them are
one matrix product, and the labels of the nearest are averaged, weighted by the cosine.

The sample has at most ``rows`` labelled documents of each class, those with the smallest hash
of the id, so that what passes the driver and what is broadcast have a fixed largest size. A
balanced sample keeps a rare class from being outvoted. All documents are scored, whole.

Defined cases: a text without three bytes has no vector and gets the mean label of the sample, as
does every text if nothing is similar to it; without any labelled row the score is 0.5; a
document with two labels counts with the smaller one; null labels and null ids teach nothing;
repeated documents get equal scores; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.llm.common import map_texts, text_of

#: Labelled documents of each class that a classifier is fitted on at most.
FIT_ROWS = 1_000

BITS = 12
DIMENSIONS = 48
NEIGHBOURS = 15
#: Neighbours' votes count by this power of the cosine.
SHARPNESS = 4

#: Columns of a text's row: buckets and two terms for repetition.
TERMS = (1 << BITS) + 2

_HASH = np.uint32(2654435761)


def gram_counts(text: str) -> np.ndarray:
    """How often each bucket of hashed three-byte sequences occurs in the text."""
    flat = np.frombuffer(text.encode(), np.uint8).astype(np.uint32)
    grams = flat[:-2] << 16 | flat[1:-1] << 8 | flat[2:]
    return np.bincount((grams * _HASH) >> np.uint32(32 - BITS), minlength=1 << BITS)


def repetition(text: str) -> tuple[float, float]:
    """Share of words that repeat one of the three words before; of characters in repeated lines."""
    words = text.split()
    near = 0.0
    if words:
        again = [a == b or a == c or a == d for a, b, c, d in zip(
            words[3:], words[2:], words[1:], words, strict=False)]
        near = (sum(again) + sum(w in words[:i] for i, w in enumerate(words[:3]))) / len(words)
    lines = text.split("\n")
    total = sum(map(len, lines))
    return near, 1 - sum(map(len, set(lines))) / total if total else 0.0


def _matrix(texts: list[str]) -> np.ndarray:
    """Damped counts of the hashed sequences and, in the last columns, the repetition terms."""
    out = np.zeros((len(texts), TERMS), np.float32)
    for i, text in enumerate(texts):
        if len(text) > 2:
            out[i, : 1 << BITS] = np.log1p(gram_counts(text))
            out[i, 1 << BITS :] = repetition(text)
    return out


def _normal(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(size > 0, size, 1)


class Classifier:
    """Labelled vectors and the projection that they live in."""

    def __init__(self, damped: np.ndarray, labels: np.ndarray):
        self.prior = float(labels.mean()) if len(labels) else 0.5
        self.labels = labels.astype(np.float32)
        held = (damped[:, : 1 << BITS] > 0).sum(axis=0)
        self.weight = (np.log((1 + len(damped)) / (1 + held)) + 1).astype(np.float32)
        rows = self._weighted(damped)
        # Leading right singular vectors by subspace iteration; the start is fixed.
        rank = min(DIMENSIONS, *rows.shape)
        basis = np.random.default_rng(1).standard_normal((rows.shape[1], rank)).astype(np.float32)
        for _ in range(6 if len(rows) else 0):
            basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
        self.basis = basis
        self.vectors = _normal(rows @ basis)

    def _weighted(self, damped: np.ndarray) -> np.ndarray:
        grams = _normal(damped[:, : 1 << BITS] * self.weight)
        return _normal(np.hstack([grams, damped[:, 1 << BITS :]]))

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        for a in range(0, len(texts), 512):
            near = _normal(self._weighted(_matrix(texts[a : a + 512])) @ self.basis) @ self.vectors.T
            k = min(NEIGHBOURS, near.shape[1])
            nearest = np.argpartition(-near, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(near, nearest, 1), 0).astype(float) ** SHARPNESS
            total = vote.sum(axis=1)
            score = (vote * self.labels[nearest]).sum(axis=1) / np.where(total > 0, total, 1)
            out[a : a + 512] = np.where(total > 0, np.clip(score, 0, 1), self.prior)
        return out


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = FIT_ROWS,
) -> Classifier:
    """A classifier from the labelled documents; ``labels`` holds those it may learn from."""
    marked = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("id")
        .agg(F.min("label").alias("label"))
    )
    picked = None
    for label in (0, 1):
        one = (
            marked.where(F.col("label") == label)
            .orderBy(F.xxhash64("id"), "id")
            .limit(rows)
        )
        picked = one if picked is None else picked.unionByName(one)
    sample = (
        docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
        .join(F.broadcast(picked), "id")  # at most 2 * rows ids
        .groupBy("id", "label")
        .agg(F.min("text").alias("text"))
    )

    def start():
        def work(texts: list[str], _) -> list:
            return [[row.tobytes() for row in _matrix(texts)]]

        return work

    vectors = map_texts(
        sample, F.col("text"), ("id", "label"), [("row", T.BinaryType(), pa.binary())], start
    ).toArrow()
    vectors = vectors.sort_by("id")
    found = [np.frombuffer(row, np.float32) for row in vectors.column("row").to_pylist()]
    damped = np.array(found, np.float32).reshape(len(found), TERMS)
    return Classifier(damped, vectors.column("label").to_numpy())


def score(
    docs: DataFrame,
    classifier: Classifier,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    score_col: str = "score",
) -> DataFrame:
    """``keep`` and the probability-like score of label 1 for every text."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def start():
        model = shared.value
        return lambda texts, _: [model.scores(texts).tolist()]

    return map_texts(
        docs, text_of(text_col), keep, [(score_col, T.DoubleType(), pa.float64())], start
    )
