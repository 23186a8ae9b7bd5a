"""Fixed quality rules over counts of a text, and a calibrated logistic regression.

The regression sees hashed words, word pairs and character n-grams as shares of the text. It
is trained on a bounded sample of labelled rows in one task; its log-odds are calibrated to
probabilities by a logistic curve fitted to out-of-fold predictions. Counts, rules and the
regression are then computed together, in Arrow batches, in the tasks that scan the texts.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gaugeflow.llm import features
from gaugeflow.llm.common import mix, rolling, row_of, sigmoid, span_hashes, sums_by_row, word_spans

SAMPLE_ROWS = 4000
# The symbols, window and limits of the rules.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
WINDOW = 5
LEAST_WORDS = 10
REPEATED_PERCENT = 20
THRESHOLD = 0.5


@dataclass
class Settings:
    bits: int = 17
    passes: int = 12
    rate: float = 0.3
    decay: float = 1e-6
    folds: int = 3
    seed: int = 11


@dataclass
class RuleModel:
    """``weights`` by feature; probability = sigmoid(slope * (mean weight + bias) + offset)."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    bits: int

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, w=self.weights, n=[self.bias, self.slope, self.offset, self.bits])
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> RuleModel:
        x = np.load(io.BytesIO(data))
        bias, slope, offset, bits = x["n"]
        return RuleModel(x["w"], bias, slope, offset, int(bits))


def regress(rows: list, labels: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Logistic regression by adaptive gradient steps, one document at a time."""
    draw = np.random.default_rng(settings.seed)
    weights, squares = np.zeros(1 << settings.bits), np.full(1 << settings.bits, 1e-8)
    bias, bias_squares = 0.0, 1e-8
    for _ in range(settings.passes):
        for i in draw.permutation(len(rows)):
            ids, share = rows[i]
            error = sigmoid(share @ weights[ids] + bias) - labels[i]
            slope = error * share + settings.decay * weights[ids]
            squares[ids] += slope * slope
            weights[ids] -= settings.rate * slope / np.sqrt(squares[ids])
            bias_squares += error * error
            bias -= settings.rate * error / np.sqrt(bias_squares)
    return weights, bias


def calibrate(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve that fits labels to scores, by Newton steps.

    Labels are drawn in by one imagined row of each class, which keeps the curve finite.
    """
    ones = labels.sum()
    goal = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    slope, offset = 1.0, 0.0
    x = np.stack([scores, np.ones(len(scores))])
    for _ in range(50):
        p = sigmoid(slope * scores + offset)
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2), x @ (p - goal))
        step = np.clip(step, -2, 2)
        slope, offset = slope - step[0], offset - step[1]
        if abs(step).max() < 1e-9:
            break
    return (slope, offset) if slope > 0 else (1.0, 0.0)


def fit(texts: pa.Array, labels: np.ndarray, settings: Settings) -> RuleModel:
    rows = features.counted(texts, settings.bits)
    fold = np.arange(len(rows)) % settings.folds
    held = np.zeros(len(rows))
    for f in range(settings.folds):
        inner, outer = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
        weights, bias = regress([rows[i] for i in inner], labels[inner], settings)
        held[outer] = [rows[i][1] @ weights[rows[i][0]] + bias for i in outer]
    slope, offset = calibrate(held, labels) if len(rows) > 1 else (1.0, 0.0)
    weights, bias = regress(rows, labels, settings)
    return RuleModel(weights, bias, slope, offset, settings.bits)


def train(
    documents: DataFrame, labels: DataFrame, label: str = "quality",
    sample_rows: int = SAMPLE_ROWS, settings: Settings | None = None,
) -> RuleModel:
    """Learns from at most ``sample_rows`` labelled documents; without any, all score 0.5."""
    settings = settings or Settings()

    def run(table: pa.Table) -> bytes:
        known = table.column("label").to_numpy()
        return fit(table.column("text").combine_chunks(), known, settings).to_bytes()

    sample = features.labelled_sample(documents, labels, label, sample_rows)
    data = features.fit_in_a_task(sample, run)
    if data is None:
        return RuleModel(np.zeros(1 << settings.bits), 0.0, 1.0, 0.0, settings.bits)
    return RuleModel.from_bytes(data)


def covered(starts: np.ndarray, width: int, count: int) -> np.ndarray:
    """Which of ``count`` places lie in one of the windows [start, start + width)."""
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change[:-1]) > 0


def repeats(keys: np.ndarray) -> np.ndarray:
    """Which entries have a key that some other entry has too."""
    _, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[place] > 1


def repeated_words(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each row, how many of its words lie in a 5-word window found twice in the row."""
    if len(words) < WINDOW:
        return np.zeros(len(first) - 1, np.int64)
    rows = row_of(first, np.arange(len(words)))
    keys = rolling(words, WINDOW)
    at = np.flatnonzero(rows[: len(keys)] == rows[WINDOW - 1 :])
    again = at[repeats(mix(keys[at] + mix(rows[at].astype(np.uint64) + np.uint64(1))))]
    return sums_by_row(covered(again, WINDOW, len(words)).astype(np.int64), first)


def repeated_lines(data: np.ndarray, bounds: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For each row, how many lines with a word equal an earlier line of the row."""
    if not len(data):
        return np.zeros(len(bounds) - 1, np.int64)
    breaks = np.flatnonzero(data == 10)
    starts = np.union1d(bounds[:-1][bounds[:-1] < len(data)], breaks + 1)
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    ends = ends - (data[np.maximum(ends - 1, starts)] == 10)
    has_word = np.searchsorted(words, ends) > np.searchsorted(words, starts)
    starts, ends = starts[has_word], ends[has_word]
    rows = row_of(bounds, starts)
    keys = mix(span_hashes(data, starts, ends) + mix(rows.astype(np.uint64) + np.uint64(1)))
    _, seen_first = np.unique(keys, return_index=True)
    later = np.ones(len(keys), np.int64)
    later[seen_first] = 0
    return sums_by_row(later, np.searchsorted(starts, bounds))


def base_counts(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The counts that the fixed rules are about."""
    starts, ends, first = word_spans(data, bounds)
    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=letters[1:])
    n_words = np.diff(first)
    return {
        "n_words": n_words,
        "word_chars": sums_by_row(letters[ends] - letters[starts], first),
        "n_symbols": sums_by_row(SYMBOLS[data].astype(np.int64), bounds),
        "n_dup_lines": repeated_lines(data, bounds, starts),
        "n_repeat_words": repeated_words(span_hashes(data, starts, ends), first),
    }


def judge(documents: DataFrame, model: RuleModel, columns: list[str]) -> DataFrame:
    """Counts, ``base_failed``, ``probability`` of good quality and ``kept`` of every row.

    A null or empty text has no words, so it fails the rules. No rows give no rows.
    """

    def run(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        counts = base_counts(data, bounds)
        words, again = counts["n_words"], counts["n_repeat_words"]
        failed = (words < LEAST_WORDS) | (100 * again > REPEATED_PERCENT * words)
        odds = features.mean_weights(data, bounds, model.weights, model.bits) + model.bias
        probability = sigmoid(model.slope * odds + model.offset)
        kept = ~failed & (probability >= THRESHOLD)
        return counts | {"base_failed": failed, "probability": probability, "kept": kept}

    told = (
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, probability double, kept boolean"
    )
    return features.map_texts(documents, columns, run, told)
