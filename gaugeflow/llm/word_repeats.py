"""Long repeats of words by a compacted de Bruijn graph.

Windows of 50 words are the edges of the graph. Edges that follow each other under one anchor
are a path, and equal paths of all documents become one through a join on the path: that is
the compacted form of a passage which does not branch. Where an anchor has several paths, the
graph branches there; those paths, each once, are taken apart into edges, and edges of equal
hash under an anchor are one.

Every repeat found so has coordinates: its place in the document, and the place of the same
words in its source, a document with a smaller doc_id. Repeats that follow each other in both
become one long span, and the words of every span are compared with those at its source before
anything is removed. Where they differ, two contents had one hash: all is done again with
another seed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.llm import repeats
from gaugeflow.llm.common import SEPARATOR, flat, rolling, span_hashes, stage, word_spans

GROUP = 8
# Spans are compared in pieces cut at these places of the source, so that spans of many
# extents over one passage share pieces.
PIECE = 256
# Seeds tried before giving up; one fails about once in 2**60 pairs compared.
SEEDS = (0, 0x5DEECE66D, 0x2545F4914F6CDD1D)

PLACE = ["segment", "doc_id", "mark"]
SOURCE = ["source_segment", "source_id", "source_mark"]


def words(
    data: np.ndarray, bounds: np.ndarray, seed: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = word_spans(data, bounds)
    return span_hashes(data, starts, ends, seed), first


def edges(data: np.ndarray, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Array:
    """The hashes of each path's edges."""
    hashes = rolling(values, repeats.WINDOW).view(np.int64)
    parts, offsets = repeats.gather(hashes, low, high - low)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(parts))


def sourced_paths(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """(anchor, path, owner, repeated, source): distinct paths, each with its first place in
    the smallest doc_id."""
    told = paths.groupBy("anchor", "path").agg(
        F.min(F.struct("doc_id", "segment", "mark", "start")).alias("source"),
        F.max("doc_id").alias("last"),
    )
    owner = F.col("source.doc_id")
    return stage(spark, told.select(
        "anchor", "path", owner.alias("owner"), (owner < F.col("last")).alias("repeated"), "source"
    ), "distinct_paths")


def branch_edges(spark: SparkSession, branches: DataFrame) -> DataFrame:
    """(anchor, path, offset, source_path, source_offset): edges of a path that belong to an
    earlier document too, and where."""
    single = branches.select(
        "anchor", "path", "owner", F.posexplode("body").alias("offset", "edge")
    )
    least = single.groupBy("anchor", "edge").agg(
        F.min(F.struct("owner", "path", "offset")).alias("least"), F.max("owner").alias("most")
    ).filter("least.owner < most").select("anchor", "edge", "least")
    rows = single.join(stage(spark, least, "shared_edges"), ["anchor", "edge"])
    return rows.filter("least.owner < owner").select(
        "anchor", "path", "owner", "offset", F.col("least.path").alias("source_path"),
        F.col("least.offset").alias("source_offset"),
    )


def claims(paths: DataFrame, distinct: DataFrame, covered: DataFrame) -> DataFrame:
    """Windows ``start`` to ``end`` of a document, and the source where they begin ``shift``
    windows further on."""
    rows = paths.select(*PLACE, "anchor", "path", "start", "end")

    def at(source_start) -> list:
        names = zip(("segment", "doc_id", "mark"), SOURCE)
        return [F.col(f"source.{a}").alias(b) for a, b in names] + [
            (source_start - F.col("start")).alias("shift")
        ]

    later = rows.join(distinct.filter("repeated"), ["anchor", "path"]).filter("doc_id > owner")
    whole = later.select(*PLACE, "start", "end", *at(F.col("source.start")))
    places = distinct.select("anchor", F.col("path").alias("source_path"), "source")
    found = covered.join(places, ["anchor", "source_path"])
    single = rows.join(found, ["anchor", "path"]).filter("doc_id = owner").withColumns({
        "start": F.col("start") + F.col("offset"), "end": F.col("start") + F.col("offset") + 1
    })
    return whole.union(
        single.select(*PLACE, "start", "end", *at(F.col("source.start") + F.col("source_offset")))
    )


def long_spans(claimed: DataFrame) -> DataFrame:
    """Claims that follow each other in the document and in its source, as one."""
    order = Window.partitionBy(*PLACE).orderBy("start", "end")
    follows = F.lag("end").over(order) == F.col("start")
    for name in [*SOURCE, "shift"]:
        follows &= F.lag(name).over(order) == F.col(name)
    first = F.when(follows, 0).otherwise(1).alias("first")
    runs = claimed.select("*", first).withColumn(
        "run", F.sum("first").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    return runs.groupBy(*PLACE, "run", *SOURCE, "shift").agg(
        F.min("start").alias("start"), F.max("end").alias("end")
    )


def joined_words(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of a text, a space after each, and the places of these spaces."""
    text = np.append(text, np.uint8(0x20))
    inside = ~SEPARATOR[text]
    kept = inside.copy()
    kept[1:] |= inside[:-1]
    joined = np.where(inside, text, np.uint8(0x20))[kept]
    return joined, np.flatnonzero(joined == 0x20)


def piece_digests(rows: DataFrame, folder: str) -> DataFrame:
    """For each piece that ``folder`` names: its source, and a 128-bit digest of its words."""
    columns = ["doc_id", "mark", "start", "length", *SOURCE, "source_start"]
    carried = [*SOURCE, "source_start", "length"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, asked = None, None, {}
        for segment, block in repeats.by_segment(batches):
            if segment != now:
                now, known, asked = segment, repeats.side_rows(folder, segment, columns), {}
                if known is not None:
                    known = known.sort_by([("doc_id", "ascending"), ("mark", "ascending")])
                    ids, marks, starts, lengths = (
                        known.column(c).to_numpy() for c in columns[:4]
                    )
                    cuts = np.flatnonzero((np.diff(ids) != 0) | (np.diff(marks) != 0)) + 1
                    for a, b in zip([0, *cuts], [*cuts, len(ids)]):
                        asked.setdefault(int(ids[a]), {})[int(marks[a])] = (int(a), int(b))
            if not asked:
                continue
            data, bounds = flat(block.column("text"))
            chosen, digests = [], []
            for i, doc_id in enumerate(block.column("doc_id").to_pylist()):
                if doc_id not in asked:
                    continue
                a, b = asked[doc_id].get(repeats.mark(data, bounds, i), (0, 0))
                if a == b:
                    continue
                joined, spaces = joined_words(data[bounds[i] : bounds[i + 1]])
                begins = np.append(0, spaces + 1)
                low, high = begins[starts[a:b]], spaces[starts[a:b] + lengths[a:b] - 1]
                view = memoryview(joined)
                digests += [
                    hashlib.blake2b(view[x:y], digest_size=16).digest()
                    for x, y in zip(low.tolist(), high.tolist())
                ]
                chosen.append(np.arange(a, b))
            if chosen:
                part = known.select(carried).take(pa.array(np.concatenate(chosen)))
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                arrays = [part.column(c).combine_chunks() for c in carried]
                arrays += [pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*carried, "upper", "lower"])

    told = ", ".join(f"{c} long" for c in [*carried, "upper", "lower"])
    return rows.mapInArrow(read, told)


def differing(spark: SparkSession, rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Pieces of sources whose words are not those of every span that was led there."""
    words_end = F.col("source_start") + F.col("end") - F.col("start") + repeats.WINDOW - 1
    whole = spans.withColumn("source_start", (F.col("start") + F.col("shift")).cast("long"))
    whole = whole.withColumn("source_end", words_end)
    cell = F.sequence(
        F.floor(F.col("source_start") / PIECE), F.floor((F.col("source_end") - 1) / PIECE)
    )
    cut = whole.withColumn("cell", F.explode(cell)).withColumns({
        "source_start": F.greatest("source_start", F.col("cell") * PIECE),
        "source_end": F.least("source_end", (F.col("cell") + 1) * PIECE),
    })
    length = (F.col("source_end") - F.col("source_start")).alias("length")
    start = (F.col("source_start") - F.col("shift")).alias("start")
    targets = cut.select(*PLACE, start, length, *SOURCE, "source_start")
    sources = cut.select(*SOURCE, "source_start", length).distinct().select(
        *[F.col(b).alias(a) for a, b in zip(PLACE, SOURCE)],
        F.col("source_start").alias("start"), "length", *SOURCE, "source_start",
    )
    folder = repeats.side_files(spark, targets.union(sources), "span_pieces")
    told = piece_digests(rows, folder).groupBy(*SOURCE, "source_start", "length").agg(
        F.count("*").alias("n"),
        (F.min("upper") < F.max("upper")).alias("upper"),
        (F.min("lower") < F.max("lower")).alias("lower"),
    )
    return told.filter("upper OR lower OR n < 2")


def verified_spans(
    spark: SparkSession, rows: DataFrame, copies: DataFrame, symbols
) -> DataFrame:
    """The long spans of all documents, each compared with its source."""
    for seed in SEEDS:
        seeded = partial(symbols, seed=seed)
        paths = repeats.find_paths(spark, rows, copies, seeded, GROUP)
        distinct = sourced_paths(spark, paths)
        several = distinct.groupBy("anchor").agg(F.count("*").alias("variants"))
        several = stage(spark, several.filter("variants > 1"), "branching")
        branches = repeats.branch_bodies(
            spark, rows, distinct, several, seeded, GROUP, edges, "array<long>"
        )
        covered = stage(spark, branch_edges(spark, branches), "covered")
        spans = stage(spark, long_spans(claims(paths, distinct, covered)), "long_spans")
        if differing(spark, rows, spans).isEmpty():
            return spans
    raise RuntimeError("repeated words differ from their sources under every seed")


def digests(data: np.ndarray, bounds: np.ndarray, gone) -> dict[str, pa.Array]:
    starts, ends, first = word_spans(data, bounds)
    rows = []
    for i, count in enumerate(np.diff(first).tolist()):
        cut = gone(i, count)
        left = first[i] + np.flatnonzero(~cut)
        kept = b" ".join(data[s:e].tobytes() for s, e in zip(starts[left], ends[left]))
        rows.append((count, int(cut.sum()), hashlib.sha256(kept).hexdigest()))
    return dict(zip(("n_words", "n_removed", "kept_sha256"), map(pa.array, zip(*rows))))


def remove_repeats(spark: SparkSession, documents: DataFrame, symbols=words) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row.

    Removed is each word in a 50-word window that also starts in a document with a smaller
    doc_id. Null texts have no words. Rows of equal doc_id do not count as earlier than each
    other. A row without doc_id is returned whole. No rows give no rows. ``symbols(data,
    bounds, seed)`` hashes words; results do not depend on it.
    """
    rows = repeats.texts_of(repeats.with_segments(spark, documents))
    copies = repeats.find_copies(spark, rows)
    spans = verified_spans(spark, rows, copies, symbols)
    found = F.collect_list(F.struct(F.col("start").alias("a"), F.col("end").alias("b")))
    spans = spans.groupBy(*PLACE).agg(found.alias("found"))
    none = F.lit(None).cast(spans.schema["found"].dataType).alias("found")
    folder = repeats.side_files(spark, spans.union(copies.select(*PLACE, none)), "spans")
    told = "n_words long, n_removed long, kept_sha256 string"
    return repeats.render(rows, folder, ["doc_id"], digests, told)
