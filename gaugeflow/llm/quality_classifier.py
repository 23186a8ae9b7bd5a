"""Supervised subword embeddings: a text is the mean of the learned vectors of its words,
word pairs and character n-grams, and a softmax layer over that mean gives its quality.

Training takes a bounded sample of labelled rows and runs in one task by plain stochastic
gradient descent. Scoring needs the vectors only through the softmax layer, which is linear,
so each feature carries the difference it makes between the two classes: one number. Texts
are scored whole, in Arrow batches, in the tasks that scan them.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import features
from gaugeflow.llm.common import sigmoid

SAMPLE_ROWS = 4000


@dataclass
class Settings:
    bits: int = 17
    dimensions: int = 8
    passes: int = 8
    rate: float = 2.0
    seed: int = 7


@dataclass
class QualityModel:
    """``vectors`` of all features, and the softmax layer: ``output`` (2 x d) and ``bias``."""

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    bits: int

    def weights(self) -> np.ndarray:
        """What each feature adds to the log-odds of class 1."""
        return (self.vectors @ (self.output[1] - self.output[0])).astype(np.float64)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, v=self.vectors, o=self.output, b=self.bias, bits=self.bits)
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> QualityModel:
        x = np.load(io.BytesIO(data))
        return QualityModel(x["v"], x["o"], x["b"], int(x["bits"]))


def fit(texts: pa.Array, labels: np.ndarray, settings: Settings) -> QualityModel:
    """Gradient descent over one document at a time, the rate falling to zero.

    Classes weigh alike in the loss, whatever their shares, so 0.5 is where a text speaks for
    either class as much.
    """
    draw = np.random.default_rng(settings.seed)
    rows = features.counted(texts, settings.bits, np.float32)
    vectors = draw.uniform(-1, 1, (1 << settings.bits, settings.dimensions)) / settings.dimensions
    vectors = vectors.astype(np.float32)
    output, bias = np.zeros((2, settings.dimensions), np.float32), np.zeros(2, np.float32)
    shares = np.bincount(labels, minlength=2) / max(1, len(labels))
    steps, done = settings.passes * len(rows), 0
    for _ in range(settings.passes):
        for i in draw.permutation(len(rows)):
            rate = settings.rate * (1 - done / steps)
            done += 1
            ids, share = rows[i]
            if not len(ids):
                continue
            hidden = share @ vectors[ids]
            scores = output @ hidden + bias
            odds = np.exp(scores - scores.max())
            error = odds / odds.sum()
            error[labels[i]] -= 1
            error *= rate * 0.5 / max(shares[labels[i]], 1e-6)
            back = error @ output
            output -= np.outer(error, hidden)
            bias -= error
            vectors[ids] -= share[:, None] * back
    return QualityModel(vectors, output, bias, settings.bits)


def train(
    documents: DataFrame, labels: DataFrame, label: str = "quality",
    sample_rows: int = SAMPLE_ROWS, settings: Settings | None = None,
) -> QualityModel:
    """Learns from at most ``sample_rows`` labelled documents.

    Without a labelled row, or with one class only, the model scores that class's share.
    """
    settings = settings or Settings()

    def run(table: pa.Table) -> bytes:
        known = table.column("label").to_numpy()
        texts = table.column("text").combine_chunks()
        return fit(texts, known, settings).to_bytes()

    sample = features.labelled_sample(documents, labels, label, sample_rows)
    data = features.fit_in_a_task(sample, run)
    if data is None:
        shape = (1 << settings.bits, settings.dimensions)
        zero = np.zeros((2, settings.dimensions), np.float32)
        return QualityModel(np.zeros(shape, np.float32), zero, np.zeros(2, np.float32), settings.bits)
    return QualityModel.from_bytes(data)


def score(documents: DataFrame, model: QualityModel, columns: list[str]) -> DataFrame:
    """``columns`` of every row, with ``score`` (0 to 1) and ``predicted`` (score >= 0.5).

    A null text counts as empty; an empty text has no feature and gets the score of the bias.
    Equal texts get equal scores. No rows give no rows.
    """
    weights, bits = model.weights(), model.bits
    bias = float(model.bias[1] - model.bias[0])

    def run(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        return {"score": sigmoid(features.mean_weights(data, bounds, weights, bits) + bias)}

    scored = features.map_texts(documents, columns, run, "score double")
    return scored.withColumn("score", F.round("score", 9)).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
