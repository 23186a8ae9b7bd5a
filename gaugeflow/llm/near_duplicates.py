"""Near duplicates: consistent weighted sampling of TF-IDF shingles, banded and verified.

A text is its shingles of five words. A shingle weighs its count times the mean inverse
document frequency of its words. (The frequency of whole shingles would not do: in a large
group of copies all that is shared becomes frequent and weighs little, and what differs
decides.) Document frequencies below a fixed share of all documents count as that share, so
the table of frequencies holds a bounded number of words and can go to every task.

Improved consistent weighted sampling draws samples that agree between two texts with the
probability of their weighted Jaccard similarity. Samples form bands; texts that agree in a
band share a bucket and are compared in full. Equal texts count once. A bucket too large for
a task is cut into chunks that all hold the bucket's first texts; what these do not join is
then compared with every chunk. Links lead to classes by connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm.common import (
    U64,
    blocks,
    flat,
    mix,
    row_of,
    rolling,
    span_hashes,
    stage,
    sums_by_row,
    text_or_empty,
    word_spans,
)
from gaugeflow.llm.components import components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, BAND_SAMPLES = 14, 4
LEAST_SHARE = 1000
CHUNK_TEXTS, CHUNK_BYTES, LEADERS = 1000, 16 << 20, 16
HELD_WORDS = 2 << 20

_draw = np.random.default_rng(2024)
_TABLE = 1 << 16
# Draws of Gamma(2, 1), for the step of a sample, and the logarithm of such draws.
_STEPS = _draw.gamma(2, 1, _TABLE).astype(np.float32)
_LOG_LEVELS = np.log(_draw.gamma(2, 1, _TABLE)).astype(np.float32)
_FACTORS = _draw.integers(1 << 63, 1 << 64, BANDS * BAND_SAMPLES, dtype=U64) | U64(1)


@dataclass
class Frequencies:
    """Sorted word hashes with their inverse document frequencies, and that of other words."""

    words: np.ndarray
    idf: np.ndarray
    other: float

    def of(self, words: np.ndarray) -> np.ndarray:
        out = np.full(len(words), self.other, np.float32)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            known = self.words[at] == words
            out[known] = self.idf[at[known]]
        return out


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    words, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.bincount(place, np.concatenate([p[1] for p in parts]), len(words))
    return words, counts.astype(np.int64)


def document_frequencies(documents: DataFrame) -> Frequencies:
    """Over all documents. Kept are words in at least one of 1000 documents: at most 1000
    times as many as a document has different words on average."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(words, counts):
            return pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "n"]
            )

        parts, held = [], 0
        for block in blocks(batches):
            data, bounds = flat(block.column("text"))
            starts, ends, first = word_spans(data, bounds)
            words = span_hashes(data, starts, ends)
            rows = row_of(first, np.arange(len(words)))
            order = np.lexsort((words, rows))
            words, rows = words[order], rows[order]
            new = np.ones(len(words), bool)
            new[1:] = (words[1:] != words[:-1]) | (rows[1:] != rows[:-1])
            parts.append(merged([(words[new], np.ones(int(new.sum()), np.int64))]))
            held += len(parts[-1][0])
            if held > HELD_WORDS:
                parts = [merged(parts)]
                held = len(parts[0][0])
                if held > HELD_WORDS // 2:
                    yield batch(*parts[0])
                    parts, held = [], 0
        if parts:
            yield batch(*merged(parts))

    total = documents.count()
    counts = documents.select(text_or_empty().alias("text")).mapInArrow(count, "word long, n long")
    frequent = counts.groupBy("word").agg(F.sum("n").alias("n"))
    rows = frequent.filter(F.col("n") * LEAST_SHARE >= total).toArrow()
    words = rows.column("word").to_numpy().view(U64)
    order = np.argsort(words)
    shares = rows.column("n").to_numpy()[order] / max(1, total)
    idf = (1 + np.log(1 / np.maximum(shares, 1 / LEAST_SHARE))).astype(np.float32)
    return Frequencies(words[order], idf, 1 + float(np.log(LEAST_SHARE)))


def weighted_shingles(
    data: np.ndarray, bounds: np.ndarray, frequencies: Frequencies
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, weight), by row; each shingle of a row once.

    A text of fewer than five words is one shingle of all its words.
    """
    starts, ends, first = word_spans(data, bounds)
    words = span_hashes(data, starts, ends)
    idf = frequencies.of(words)
    rows = row_of(first, np.arange(len(words)))
    hashes = rolling(words, SHINGLE_WORDS)
    at = np.flatnonzero(rows[: len(hashes)] == rows[SHINGLE_WORDS - 1 :])
    sums = np.concatenate([[0], np.cumsum(idf, dtype=np.float64)])
    means = (sums[at + SHINGLE_WORDS] - sums[at]) / SHINGLE_WORDS
    found, keys = [rows[at]], [hashes[at]]
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS))
    if len(short):
        one = np.array([rolling(words[a:b], b - a)[0] for a, b in zip(first[short], first[short + 1])])
        found.append(short)
        keys.append(mix(one + counts[short].astype(U64)))
        means = np.append(means, sums_by_row(idf.astype(np.float64), first)[short] / counts[short])
    row, key = np.concatenate(found), np.concatenate(keys)
    order = np.lexsort((key, row))
    row, key, means = row[order], key[order], means[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    begins = np.flatnonzero(new)
    counts = np.diff(np.append(begins, len(row)))
    # Rounded, so that a text's weights do not depend on where in a block it lies.
    return row[new], key[new], np.round(counts * means[begins], 4)


def band_keys(
    rows: np.ndarray, shingles: np.ndarray, weights: np.ndarray, count: int
) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have shingles, and their keys: one for each band."""
    begins = np.searchsorted(rows, np.arange(count))
    full = np.flatnonzero(np.diff(np.append(begins, len(rows))) > 0)
    keys = np.zeros((len(full), BANDS), U64)
    if not len(full):
        return full, keys
    begins = begins[full]
    place = np.repeat(np.arange(len(full)), np.diff(np.append(begins, len(rows))))
    logs = np.log(weights).astype(np.float32)
    for sample, factor in enumerate(_FACTORS):
        bits = shingles * factor
        bits ^= bits >> U64(29)
        bits *= factor
        step = _STEPS[(bits >> U64(48)).astype(np.int32)]
        shift = ((bits >> U64(16)).astype(np.uint16)).astype(np.float32) / np.float32(65536)
        level = np.floor(logs / step + shift)
        height = _LOG_LEVELS[(bits >> U64(32)).astype(np.uint16)] - step * (level - shift + 1)
        least = np.minimum.reduceat(height, begins)
        hits = np.flatnonzero(height == least[place])
        owner, chosen = np.unique(place[hits], return_index=True)
        hit = hits[chosen]
        drawn = mix(shingles[hit] + mix(level[hit].astype(np.int64).view(U64) + U64(sample + 1)))
        band = sample // BAND_SAMPLES
        keys[owner, band] = mix(keys[owner, band] * U64(31) + drawn + U64(band))
    return full, keys


def signatures(documents: DataFrame, frequencies: Frequencies) -> DataFrame:
    """(doc_id, text_id, size, bands); no bands for a text without words."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            data, bounds = flat(block.column("text"))
            rows, shingles, weights = weighted_shingles(data, bounds, frequencies)
            full, keys = band_keys(rows, shingles, weights, block.num_rows)
            lengths = np.zeros(block.num_rows, np.int32)
            lengths[full] = BANDS
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            bands = pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("text_id"), pa.array(np.diff(bounds)), bands],
                names=["doc_id", "text_id", "size", "bands"],
            )

    texts = documents.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    texts = texts.withColumn("text_id", F.unhex(F.md5("text")))
    return texts.mapInArrow(draw, "doc_id long, text_id binary, size long, bands array<long>")


def link_group(table: pa.Table, frequencies: Frequencies) -> pa.Table:
    """Links that join the classes of a group, by full comparison.

    Texts marked ``asks`` are compared with all others of another class, unless the class of
    both has become one; the links found make a forest.
    """
    table = table.sort_by("id")
    ids = table.column("id").to_numpy()
    asks = table.column("asks").to_numpy(zero_copy_only=False)
    _, known = np.unique(table.column("class").to_numpy(), return_inverse=True)
    data, bounds = flat(table.column("text").combine_chunks())
    rows, shingles, weights = weighted_shingles(data, bounds, frequencies)
    distinct, codes = np.unique(shingles, return_inverse=True)
    begins = np.searchsorted(rows, np.arange(len(ids) + 1))
    totals = np.bincount(rows, weights, len(ids))
    own = np.zeros(len(distinct))
    links = []
    for i in np.flatnonzero(asks):
        other = known != known[i]
        if not other.any():
            continue
        a, b = begins[i], begins[i + 1]
        own[codes[a:b]] = weights[a:b]
        common = np.bincount(rows, np.minimum(weights, own[codes]), len(ids))
        own[codes[a:b]] = 0
        alike = common >= SIMILARITY * (totals + totals[i] - common) - 1e-9
        for j in np.flatnonzero(alike & other & (totals > 0)):
            if known[j] != known[i]:
                known[known == known[j]] = known[i]
                links.append((ids[i], ids[j]))
    return pa.table({
        "a": pa.array([x for x, _ in links], pa.int64()),
        "b": pa.array([y for _, y in links], pa.int64()),
    })


def compare(documents: DataFrame, places: DataFrame, frequencies: Frequencies) -> DataFrame:
    """Links within each group of ``places`` (group, part, id, class, asks)."""
    texts = documents.select(
        F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("text")
    )
    grouped = places.join(texts, "id").groupBy("group", "part")
    return grouped.applyInArrow(lambda t: link_group(t, frequencies), "a long, b long")


def bucket_members(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """(group, id, chunks, chunk) for buckets of several texts; buckets with the same members
    count once."""
    rows = texts.select(
        F.col("id"), F.col("size"), F.posexplode("bands").alias("band", "key")
    ).select("id", "size", F.xxhash64("band", "key").alias("group"))
    buckets = rows.groupBy("group").agg(
        F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"),
        F.bit_xor(F.xxhash64("id")).alias("members"), F.sum("size").alias("bytes"),
    ).filter("n > 1")
    once = buckets.groupBy("n", "low", "high", "members", "bytes").agg(F.min("group").alias("group"))
    chunks = F.greatest(
        F.ceil(F.col("n") / CHUNK_TEXTS), F.ceil(F.col("bytes") / CHUNK_BYTES)
    ).cast("int")
    once = stage(spark, once.select("group", chunks.alias("chunks")), "buckets")
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    return rows.join(once, "group").select("group", "id", "chunks", chunk.alias("chunk"))


def within_chunks(members: DataFrame) -> DataFrame:
    """Every chunk with all its texts, and as guests the first texts of its bucket."""
    leads = members.filter(F.col("chunk") < LEADERS).groupBy("group", "chunks", "chunk").agg(
        F.min("id").alias("id")
    )
    chunks = F.sequence(F.lit(0), F.col("chunks") - 1)
    others = F.filter(chunks, lambda c: c != F.col("chunk"))
    guests = leads.filter("chunks > 1").select("group", F.explode(others).alias("part"), "id")
    own = members.select("group", F.col("chunk").alias("part"), "id")
    return own.union(guests).withColumns({"class": F.col("id"), "asks": F.lit(True)})


def across_chunks(spark: SparkSession, split: DataFrame, labels: DataFrame) -> DataFrame:
    """What is not in a bucket's largest class asks the texts of all its chunks.

    Askers come in blocks that fit a task, each to every chunk but its own.
    """
    label = F.coalesce("label", "id").alias("class")
    known = stage(spark, split.join(labels, "id", "left").select(*split.columns, label), "split")
    sizes = known.groupBy("group", "class").agg(F.count("*").alias("n"))
    main = sizes.groupBy("group").agg(
        F.max(F.struct("n", (-F.col("class")).alias("c"))).alias("m"), F.sum("n").alias("all")
    )
    main = main.filter(F.col("m.n") < F.col("all")).select(
        "group", (-F.col("m.c")).alias("main"),
        F.ceil((F.col("all") - F.col("m.n")) / CHUNK_TEXTS).cast("int").alias("askers"),
    )
    rows = known.join(stage(spark, main, "main_classes"), "group")
    block = F.pmod(F.xxhash64("id", F.lit("asker")), F.col("askers")).cast("int")
    every_block = F.sequence(F.lit(0), F.col("askers") - 1)
    other_chunks = F.filter(
        F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: c != F.col("chunk")
    )
    held = rows.withColumn("to", F.explode(every_block)).select(
        "group", (F.col("chunk") * F.col("askers") + F.col("to")).alias("part"), "id", "class",
        F.lit(False).alias("asks"),
    )
    asking = rows.filter("class != main").withColumn("to", F.explode(other_chunks)).select(
        "group", (F.col("to") * F.col("askers") + block).alias("part"), "id", "class",
        F.lit(True).alias("asks"),
    )
    return held.union(asking)


def link_texts(spark: SparkSession, documents: DataFrame, texts: DataFrame, frequencies) -> DataFrame:
    """Links between texts of similarity 0.8 or more, enough to join every class."""
    members = stage(spark, bucket_members(spark, texts), "members")
    links = stage(spark, compare(documents, within_chunks(members), frequencies), "links_within")
    split = members.filter("chunks > 1")
    if split.isEmpty():
        return links
    places = across_chunks(spark, split, components(spark, links))
    return links.union(stage(spark, compare(documents, places, frequencies), "links_across"))


def classes(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(doc_id, class_id) of every row; ``class_id`` is the least doc_id of the class.

    Null text counts as empty; texts without words are in one class if they are equal. Texts
    of fewer than five words are alike if all their words are. Rows that repeat a doc_id share
    a class. A row without doc_id gets the class of its text and is never the one a class is named by.
    """
    frequencies = document_frequencies(documents)
    drawn = stage(spark, signatures(documents, frequencies), "signatures")
    least = F.min(F.struct("doc_id", "size", "bands")).alias("t")
    texts = drawn.filter("doc_id IS NOT NULL").groupBy("text_id").agg(least).select(
        "text_id", F.col("t.doc_id").alias("id"), "t.size", "t.bands"
    )
    texts = stage(spark, texts, "texts")
    links = link_texts(spark, documents, texts, frequencies)
    labels = components(spark, links)
    named = texts.select("text_id", "id").join(labels, "id", "left").select(
        "text_id", F.coalesce("label", "id").alias("class_id")
    )
    named = stage(spark, named, "text_classes")
    return drawn.select("doc_id", "text_id").join(named, "text_id", "left").select(
        "doc_id", "class_id"
    )
