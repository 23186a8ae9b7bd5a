"""Toxicity by a classifier chain of sparse linear models.

Categories are predicted one after another. The model of a category sees the words of a text
(and the beginnings of words, for languages that inflect) and the probabilities of all earlier
categories. In training those probabilities are out-of-fold predictions, so a later model
learns from inputs as uncertain as those that it meets in use. The verdict is the last
category, toxic, which is fed by those of its higher degrees. Where the degrees are read off
the training rows themselves, a fold reads them off its own rows only.

A word counts once in a text however long the text is, and an L1 penalty leaves weights only
to words that tell the categories apart; the model is a short list of hashes and weights.
Training takes a bounded sample of labelled rows and runs in one task; scoring runs in Arrow
batches over whole texts in the tasks that scan them.
"""

from __future__ import annotations

import io
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import features
from gaugeflow.llm.common import U64, flat, mix, row_of, sigmoid, span_hashes, word_spans

SAMPLE_ROWS = 12_000
PREFIXES = (5, 6)
# Upper-case ASCII letters to lower case; other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Bytes that are trimmed from both ends of a word.
LETTER = np.zeros(256, bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Settings:
    folds: int = 3
    penalty: float = 2e-4
    steps: int = 300
    least_rows: int = 4
    most_features: int = 20_000


@dataclass
class ChainModel:
    """For each category the weights of ``keys``, of the earlier categories, and a bias."""

    names: list[str]
    keys: np.ndarray
    weights: np.ndarray
    links: np.ndarray
    biases: np.ndarray

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(
            out, n=np.array(self.names), k=self.keys, w=self.weights, l=self.links, b=self.biases
        )
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> ChainModel:
        x = np.load(io.BytesIO(data))
        return ChainModel([str(n) for n in x["n"]], x["k"], x["w"], x["l"], x["b"])


def word_keys(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, is whole word) of the distinct words and word beginnings of each row."""
    plain = LOWER[data]
    inner = np.where(LETTER[data], data, np.uint8(0x20))
    starts, ends, _ = word_spans(inner, bounds)
    rows, lengths = row_of(bounds, starts), ends - starts
    found = [(rows, span_hashes(plain, starts, ends), True)]
    for size in PREFIXES:
        long = lengths > size
        begin = starts[long]
        hashes = mix(span_hashes(plain, begin, begin + size) + U64(size))
        found.append((rows[long], hashes, False))
    out = []
    for r, k, whole in found:
        order = np.lexsort((k, r))
        r, k = r[order], k[order]
        new = np.ones(len(k), bool)
        new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
        out.append((r[new], k[new], np.full(int(new.sum()), whole)))
    return tuple(np.concatenate(x) for x in zip(*out))


class Matrix:
    """Ones at (row, column), rows and columns in any order."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, shape: tuple[int, int]):
        self.rows, self.columns, self.shape = rows, columns, shape

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.columns], self.shape[0])

    def back(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, errors[self.rows], self.shape[1])

    def only(self, chosen: np.ndarray) -> Matrix:
        kept = chosen[self.rows]
        place = np.cumsum(chosen) - 1
        return Matrix(place[self.rows[kept]], self.columns[kept], (int(chosen.sum()), self.shape[1]))


def sparse_regression(
    ones: Matrix, extra: np.ndarray, labels: np.ndarray, settings: Settings
) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, link weights and bias: accelerated proximal gradient with an L1 penalty.

    Columns are scaled to unit length, so that rare words learn as fast as frequent ones.
    """
    count = max(1, len(labels))
    scale = 1 / np.sqrt(np.maximum(ones.back(np.ones(len(labels))), 1))
    size = ones.shape[1]
    now = np.zeros(size + extra.shape[1] + 1)
    ahead, momentum, step = now.copy(), 1.0, 0.5
    share = np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3)
    now[-1] = ahead[-1] = np.log(share / (1 - share))
    threshold = settings.penalty * np.sqrt(count)
    for _ in range(settings.steps):
        z = ones.times(ahead[:size] * scale) + extra @ ahead[size:-1] + ahead[-1]
        error = sigmoid(z) - labels
        slope = np.concatenate([ones.back(error) * scale, extra.T @ error / 8, [error.sum() / count]])
        new = ahead - step * slope
        new[:size] = np.sign(new[:size]) * np.maximum(abs(new[:size]) - step * threshold, 0)
        after = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead = new + (momentum - 1) / after * (new - now)
        now, momentum = new, after
    return now[:size] * scale, now[size:-1], float(now[-1])


def telling(rows, keys, labels: np.ndarray, settings: Settings) -> np.ndarray:
    """Keys that toxic and other rows have in clearly different shares."""
    distinct, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
    hits = np.bincount(place, labels[rows], len(distinct))
    share = labels.mean()
    surprise = abs(hits - counts * share) / np.sqrt(counts * share * (1 - share) + 1e-9)
    surprise[counts < settings.least_rows] = 0
    best = np.argsort(-surprise, kind="stable")[: settings.most_features]
    return np.sort(distinct[best[surprise[best] > 3]])


def degrees(rows, keys, whole, labels: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Labels of falling degree for data that only say toxic or not: at least 4 different
    words that only toxic rows have, at least 2, any.

    Those words are told by the rows that are ``known``.
    """
    words, place = np.unique(keys[whole], return_inverse=True)
    at, own = rows[whole], known[rows[whole]]
    counts = np.bincount(place[own], minlength=len(words))
    hits = np.bincount(place[own], labels[at[own]], len(words))
    abusive = (counts >= 8) & (hits == counts)
    number = np.bincount(at, abusive[place], len(labels))
    return np.stack([labels * (number >= 4), labels * (number >= 2), labels])


def fit(
    names, targets: Callable[[np.ndarray], np.ndarray], labels: np.ndarray, rows, keys,
    settings: Settings,
) -> ChainModel:
    """A chain in the order of ``names``; ``targets`` gives categories x rows by what the rows
    of a mask tell."""
    count = len(labels)
    every = np.ones(count, bool)
    chosen = telling(rows, keys, labels, settings)
    at = np.searchsorted(chosen, keys)
    known = (at < len(chosen)) & (chosen[np.minimum(at, len(chosen) - 1)] == keys) if len(chosen) else np.zeros(len(keys), bool)
    ones = Matrix(rows[known], at[known], (count, len(chosen)))
    fold = np.arange(count) % settings.folds
    folds = [(fold != f, fold == f) for f in range(settings.folds)]
    within = [targets(inner).astype(float) for inner, _ in folds]
    whole = targets(every).astype(float)
    earlier = np.zeros((count, 0))
    weights, links, biases = [], np.zeros((len(names), len(names))), []
    for number in range(len(names)):
        held = np.zeros(count)
        for (inner, outer), own in zip(folds, within):
            w, l, b = sparse_regression(ones.only(inner), earlier[inner], own[number][inner], settings)
            held[outer] = sigmoid(ones.only(outer).times(w) + earlier[outer] @ l + b)
        w, l, b = sparse_regression(ones, earlier, whole[number], settings)
        weights.append(w)
        links[number, :number] = l
        biases.append(b)
        earlier = np.column_stack([earlier, held])
    weights = np.array(weights).reshape(len(names), len(chosen))
    used = (weights != 0).any(axis=0)
    return ChainModel(list(names), chosen[used], weights[:, used], links, np.array(biases))


DEGREES = ("severe", "repeated", "toxic")


def train(
    documents: DataFrame, labels: DataFrame, label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS, settings: Settings | None = None,
) -> ChainModel:
    """A chain over the three degrees of toxicity from at most ``sample_rows`` rows.

    Without labelled rows every probability is one half.
    """
    settings = settings or Settings()

    def run(table: pa.Table) -> bytes:
        known = table.column("label").to_numpy().astype(float)
        data, bounds = flat(table.column("text").combine_chunks())
        rows, keys, whole = word_keys(data, bounds)
        targets = lambda mask: degrees(rows, keys, whole, known, mask)
        return fit(DEGREES, targets, known, rows, keys, settings).to_bytes()

    sample = features.labelled_sample(documents, labels, label, sample_rows)
    data = features.fit_in_a_task(sample, run)
    if data is None:
        n = len(DEGREES)
        return ChainModel(
            list(DEGREES), np.zeros(0, U64), np.zeros((n, 0)), np.zeros((n, n)), np.zeros(n)
        )
    return ChainModel.from_bytes(data)


def score(documents: DataFrame, model: ChainModel, columns: list[str]) -> DataFrame:
    """``columns`` of every row, and ``p_<category>`` for each category of the chain.

    A null text counts as empty; an empty text gets what the biases say. Equal texts get equal
    probabilities. No rows give no rows.
    """

    def run(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        rows, keys, _ = word_keys(data, bounds)
        at = np.searchsorted(model.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(model.keys):
            known = model.keys[np.minimum(at, len(model.keys) - 1)] == keys
        ones = Matrix(rows[known], at[known], (len(bounds) - 1, len(model.keys)))
        earlier = np.zeros((len(bounds) - 1, 0))
        for number in range(len(model.names)):
            z = ones.times(model.weights[number]) + model.biases[number]
            p = sigmoid(z + earlier @ model.links[number, :number])
            earlier = np.column_stack([earlier, p])
        return {f"p_{n}": earlier[:, i] for i, n in enumerate(model.names)}

    told = ", ".join(f"p_{n} double" for n in model.names)
    scored = features.map_texts(documents, columns, run, told)
    return scored.withColumns({f"p_{n}": F.round(f"p_{n}", 9) for n in model.names})
