"""Hashed word and character n-grams of whole texts, and linear scores over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import (
    SEPARATOR,
    U64,
    blocks,
    flat,
    mix,
    row_of,
    span_hashes,
    word_spans,
)

# A word that follows itself is one feature, whatever the word.
REPEAT = U64(0x5EED)
# Odd multipliers that keep the kinds of character n-grams apart.
GRAM_FACTORS = {3: np.uint32(0x9E3779B1), 4: np.uint32(0x85EBCA77)}


def word_features(words: np.ndarray, first: np.ndarray, bits: int) -> list[tuple]:
    """(ids, bounds by row) of words and of pairs of neighbours."""
    shift = U64(64 - bits)
    out = [((mix(words + U64(1)) >> shift).astype(np.int32), first)]
    if len(words) > 1:
        left, right = words[:-1], words[1:]
        pairs = mix(left * U64(3) + right + U64(2))
        pairs[left == right] = mix(np.array([REPEAT]))[0]
        same = np.ones(len(pairs), bool)
        inner = first[(first > 0) & (first < len(words))]
        same[inner - 1] = False
        kept = np.flatnonzero(same)
        out.append(((pairs[kept] >> shift).astype(np.int32), np.searchsorted(kept, first)))
    return out


def gram_features(data: np.ndarray, bounds: np.ndarray, bits: int) -> Iterator[tuple]:
    """(ids, bounds by row) of the byte n-grams of words, with their edges as spaces."""
    edge = SEPARATOR[data]
    plain = np.where(edge, np.uint8(0x20), data).astype(np.uint32)
    ends = np.zeros(len(data) + 1, bool)
    ends[bounds] = True  # no n-gram may cross these
    for width, factor in GRAM_FACTORS.items():
        count = len(data) - width + 1
        if count <= 0:
            yield np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
            continue
        code = plain[:count].copy()
        bad = np.zeros(count, bool)
        for j in range(1, width):
            code |= plain[j : j + count] << np.uint32(8 * j)
            bad |= ends[j : j + count]
            if j < width - 1:
                bad |= edge[j : j + count]
        code ^= code >> np.uint32(15)
        code *= factor
        code ^= code >> np.uint32(13)
        code *= factor
        kept = np.flatnonzero(~bad)
        ids = (code[kept] >> np.uint32(32 - bits)).astype(np.int32)
        yield ids, np.searchsorted(kept, bounds)


def features(data: np.ndarray, bounds: np.ndarray, bits: int) -> Iterator[tuple]:
    starts, ends, first = word_spans(data, bounds)
    yield from word_features(span_hashes(data, starts, ends), first, bits)
    yield from gram_features(data, bounds, bits)


def mean_weights(
    data: np.ndarray, bounds: np.ndarray, weights: np.ndarray, bits: int
) -> np.ndarray:
    """For each row the mean weight over all its features; 0 where there is none."""
    total, count = np.zeros(len(bounds) - 1), np.zeros(len(bounds) - 1, np.int64)
    for ids, at in features(data, bounds, bits):
        full = np.flatnonzero(np.diff(at) > 0)
        if len(full):
            total[full] += np.add.reduceat(weights[ids], at[full])
        count += np.diff(at)
    return total / np.maximum(count, 1)


def counted(
    texts: pa.Array, bits: int, kind: type = np.float64
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each row its distinct feature ids and the share each has of all features.

    A block of texts at a time: a feature takes many times the memory of its byte of text until
    it is counted, and only the counts are kept.
    """
    out = []
    for block in blocks([pa.record_batch([texts], names=["text"])]):
        data, bounds = flat(block.column("text"))
        ids, rows = [], []
        for found, at in features(data, bounds, bits):
            ids.append(found)
            rows.append(row_of(at, np.arange(len(found))))
        keys = np.concatenate(rows).astype(np.int64) << 32 | np.concatenate(ids).astype(np.int64)
        keys, counts = np.unique(keys, return_counts=True)
        at = np.searchsorted(keys >> 32, np.arange(len(bounds)))
        for a, b in zip(at[:-1], at[1:]):
            share = counts[a:b] / max(1, counts[a:b].sum())
            out.append(((keys[a:b] & 0xFFFFFFFF).astype(np.int32), share.astype(kind)))
    return out


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents, a bounded sample.

    Chosen by a hash of the id, so the same rows each time. Rows without an id, or with a
    label other than 0 or 1, are not used; of several labels of a document the largest is.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = (
        known.groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(rows)
    )
    # The sample is bounded by ``rows``, so it may be broadcast.
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    joined = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return joined.select("doc_id", "text", "label")


def fit_in_a_task(sample: DataFrame, fit) -> bytes:
    """``fit(table)`` of the whole sample, run once in a task; its bytes."""

    def run(table: pa.Table) -> pa.Table:
        texts = table.sort_by("doc_id")
        return pa.table({"model": pa.array([fit(texts)], pa.binary())})

    gathered = sample.withColumn("_all", F.lit(1)).groupBy("_all")
    rows = gathered.applyInArrow(run, "model binary").collect()
    return rows[0].model if rows else None


def map_texts(documents: DataFrame, columns: list[str], score, told: str) -> DataFrame:
    """``score(data, bounds) -> dict of arrays`` over blocks of whole texts, after ``columns``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            data, bounds = flat(batch.column("text"))
            made = score(data, bounds)
            arrays = [batch.column(c) for c in columns] + [pa.array(a) for a in made.values()]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, *made])

    fields = [documents.schema[c] for c in columns]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    rows = documents.select(*columns, F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"{kept}, {told}")
