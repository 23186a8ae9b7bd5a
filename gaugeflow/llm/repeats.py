"""Passages of at least 50 symbols that repeat across documents: what both operators share.

A window is 50 consecutive symbols (bytes, or words) of one document. Its anchor is the least
hash of the short symbol groups in it, so equal windows have equal anchors, and a text of n
symbols has only some n/20 of them. Windows that follow each other and share an anchor form a
path. Anchors seen in one document only cannot lie in a repeated window; all that follows
looks at the paths of the other anchors:

1. Each segment of the table (rows of a file that stand together) sends its anchors, sorted
   and packed, to the ranges that a second hash of them falls in (they are minima, so their
   own values crowd at the low end), and learns which occur elsewhere.
2. Paths of such anchors are kept. Of equal texts only the first goes on; in all others every
   window is a repeat.
3. Equal paths are counted once: their owner is the smallest doc_id. In other documents all
   windows of the path repeat. Whether windows of the owner repeat one of an even smaller
   doc_id, in another path of the anchor, is what the operators find out by their methods; for
   this alone the contents of paths are fetched, of owners and where an anchor branches.

Texts are scanned four times and never shuffled: what a segment learns is written to a file
of its own in the shared folder, and the tasks that scan its rows read that file.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs, parquet
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm.common import (
    U64,
    blocks,
    flat,
    mix,
    open_folder,
    rolling,
    row_of,
    scratch,
    shuffle_partitions,
    shuffles_dropped,
    stage,
    stretch_hashes,
    text_or_empty,
)

WINDOW = 50
SEGMENT_ROWS = 8192
HELD_ANCHORS = 1 << 21
# Anchors that a range holds by reckoning: 8 MB packed.
RANGE_ANCHORS = 1 << 20

# (data, bounds) -> symbols end to end, and the number of each row's first symbol.
Symbols = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
# (data, symbols, first windows, ends) -> what the windows of each path hold.
Bodies = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], pa.Array]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``values[i:i + width]`` for each i."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[: len(values) - span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def window_anchors(symbols: np.ndarray, first: np.ndarray, group: int):
    """(row, anchor) for each window start; -1 as row where the window leaves its document.

    The lowest bit of an anchor is free.
    """
    count = len(symbols) - WINDOW + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    rows = row_of(first, np.arange(len(symbols)))
    anchors = sliding_least(rolling(symbols, group), WINDOW - group + 1) & ~U64(1)
    return np.where(rows[:count] == rows[WINDOW - 1 :], rows[:count], -1), anchors


def with_segments(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Each row whole, as ``doc``, and its ``segment``, the same whenever the files are read.

    Columns of ``documents`` can have any name.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("doc")
    place = F.xxhash64(
        F.col("_metadata.file_path"), F.floor(F.col("_metadata.row_index") / SEGMENT_ROWS)
    ).alias("segment")
    try:
        return documents.select(whole, place)
    except AnalysisException:  # not read from files: write it first
        return stage(spark, documents, "documents").select(whole, place)


def texts_of(rows: DataFrame) -> DataFrame:
    """(segment, doc_id, text) of rows with segments; null text is empty."""
    return rows.select(
        "segment", F.col("doc.doc_id").cast("long").alias("doc_id"),
        text_or_empty("doc.text").alias("text"),
    )


def side_files(spark: SparkSession, rows: DataFrame, name: str) -> str:
    """Writes ``rows``, a file for each segment; the folder."""
    folder = scratch(spark, name)
    with shuffles_dropped(spark):
        rows.repartition("segment").write.partitionBy("segment").parquet(folder)
    return folder


def side_rows(folder: str, segment: int, columns: list[str]) -> pa.Table | None:
    """What ``side_files`` wrote for a segment."""
    store, root = open_folder(folder)
    path = f"{root}/segment={segment}"
    if store.get_file_info(path).type == fs.FileType.NotFound:
        return None
    return parquet.read_table(path, columns=columns, filesystem=store, partitioning=None)


def by_segment(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Blocks whose rows are all of one segment."""
    for block in blocks(batches):
        segments = block.column("segment").to_numpy()
        cuts = np.flatnonzero(np.diff(segments)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(segments)]):
            if b > a:
                yield int(segments[a]), block.slice(a, b - a)


def mark(data: np.ndarray, bounds: np.ndarray, row: int) -> int:
    """Tells texts of one doc_id apart."""
    return zlib.crc32(data[bounds[row] : bounds[row + 1]].tobytes())


def anchor_ranges(spark: SparkSession, rows: DataFrame, group: int) -> int:
    """How many ranges the anchors of all texts go to, by the measured size of the texts.

    Of n symbols some 2 n / (width + 1) are the least of ``width`` groups that follow each
    other, and a text has no more symbols than bytes.
    """
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    anchors = 2 * size // (WINDOW - group + 2)
    return max(4 * shuffle_partitions(spark), 1 + anchors // RANGE_ANCHORS)


def send_anchors(rows: DataFrame, symbols: Symbols, group: int, buckets: int) -> DataFrame:
    """(bucket, segment, anchors): sorted, packed; the low bit marks several documents."""

    def packed(segment: int, parts: list[np.ndarray]) -> Iterator[dict]:
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        ranges = ((mix(keys) >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int32)
        order = np.argsort(ranges, kind="stable")
        keys = (keys | (counts > 1).astype(U64))[order]
        edges = np.searchsorted(ranges[order], np.arange(buckets))
        for bucket, (a, b) in enumerate(zip(edges, [*edges[1:], len(keys)])):
            if b > a:
                yield {"bucket": bucket, "segment": segment, "anchors": keys[a:b].tobytes()}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("bucket", pa.int32()), ("segment", pa.int64()), ("anchors", pa.binary())
        ])
        now, parts, held = None, [], 0
        for segment, block in by_segment(batches):
            if parts and (segment != now or held > HELD_ANCHORS):
                yield pa.RecordBatch.from_pylist(list(packed(now, parts)), schema)
                parts, held = [], 0
            now = segment
            values, first = symbols(*flat(block.column("text")))
            owner, anchors = window_anchors(values, first, group)
            for key in ("run", "document"):
                if key == "document":
                    order = np.lexsort((anchors, owner))
                    owner, anchors = owner[order], anchors[order]
                new = np.ones(len(owner), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (anchors[1:] != anchors[:-1])
                new &= owner >= 0
                owner, anchors = owner[new], anchors[new]
            if len(anchors):
                parts.append(anchors)
                held += len(anchors)
        if parts:
            yield pa.RecordBatch.from_pylist(list(packed(now, parts)), schema)

    return rows.select("segment", "text").mapInArrow(
        send, "bucket int, segment long, anchors binary"
    )


def shared_anchors(sent: DataFrame) -> DataFrame:
    """(segment, anchors): of each segment those that are in several documents."""

    def share(table: pa.Table) -> pa.Table:
        segments, parts = table.column("segment").to_pylist(), table.column("anchors")
        parts = [np.frombuffer(p.as_py(), U64) for p in parts]
        keys = np.concatenate(parts)
        _, place, counts = np.unique(keys >> U64(1), return_inverse=True, return_counts=True)
        many = np.bincount(place, (keys & U64(1)).astype(float)) + (counts > 1)
        kept = many[place] > 0
        ends = np.cumsum([len(p) for p in parts])
        out = []
        for segment, part, end in zip(segments, parts, ends):
            own = part[kept[end - len(part) : end]]
            if len(own):
                out.append({"segment": segment, "anchors": (own & ~U64(1)).tobytes()})
        return pa.Table.from_pylist(
            out, pa.schema([("segment", pa.int64()), ("anchors", pa.binary())])
        )

    return sent.groupBy("bucket").applyInArrow(share, "segment long, anchors binary")


class BlockPaths:
    """The paths of a block of documents, all in order of place."""

    def __init__(self, block: pa.RecordBatch, symbols: Symbols, group: int):
        self.data, self.bounds = flat(block.column("text"))
        self.values, self.first = symbols(self.data, self.bounds)
        owner, anchors = window_anchors(self.values, self.first, group)
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (anchors[1:] != anchors[:-1])
        self.low = np.flatnonzero(new)
        self.high = np.append(self.low[1:], len(owner))
        self.row, self.anchor = owner[self.low], anchors[self.low]
        self.keep(self.row >= 0)

    def keep(self, chosen: np.ndarray) -> None:
        for name in ("low", "high", "row", "anchor"):
            setattr(self, name, getattr(self, name)[chosen])

    def hashes(self) -> np.ndarray:
        return stretch_hashes(self.values, self.low, self.high + WINDOW - 1).view(np.int64)


def among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which ``keys`` are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def paths_of(rows: DataFrame, folder: str, symbols: Symbols, group: int) -> DataFrame:
    """(segment, doc_id, mark, anchor, path, start, end) of paths with shared anchors.

    A path is the windows ``start`` to ``end`` (excluded) of one anchor, ``path`` the hash of
    their symbols. ``folder`` has a segment's shared anchors and its documents that are copies.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shared, skip = None, np.zeros(0, U64), set()
        for segment, block in by_segment(batches):
            if segment != now:
                now, known = segment, side_rows(folder, segment, ["anchors", "doc_id", "mark"])
                known = known.to_pylist() if known is not None else []
                packed = [np.frombuffer(r["anchors"], U64) for r in known if r["anchors"] is not None]
                shared = np.unique(np.concatenate(packed)) if packed else np.zeros(0, U64)
                skip = {(r["doc_id"], r["mark"]) for r in known if r["anchors"] is None}
            if not len(shared):
                continue
            paths = BlockPaths(block, symbols, group)
            doc_ids = block.column("doc_id").to_pylist()
            marks = [mark(paths.data, paths.bounds, i) for i in range(len(doc_ids))]
            wanted = np.array([
                d is not None and (d, m) not in skip for d, m in zip(doc_ids, marks)
            ])
            paths.keep(wanted[paths.row] & among(paths.anchor, shared))
            row = pa.array(paths.row)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(row), segment)),
                pa.array(doc_ids, pa.int64()).take(row), pa.array(marks, pa.int64()).take(row),
                pa.array(paths.anchor.view(np.int64)), pa.array(paths.hashes()),
                pa.array((paths.low - paths.first[paths.row]).astype(np.int32)),
                pa.array((paths.high - paths.first[paths.row]).astype(np.int32)),
            ], names=["segment", "doc_id", "mark", "anchor", "path", "start", "end"])

    return rows.mapInArrow(
        find, "segment long, doc_id long, mark long, anchor long, path long, start int, end int"
    )


def branch_bodies(
    spark: SparkSession, rows: DataFrame, distinct: DataFrame, several: DataFrame,
    symbols: Symbols, group: int, bodies: Bodies, body: str,
) -> DataFrame:
    """(anchor, path, owner, body) of the paths of anchors that branch, each once."""
    wanted = distinct.join(several, "anchor").select("path", F.col("owner").alias("doc_id"))
    places = rows.select("segment", "doc_id").distinct()
    folder = side_files(spark, wanted.join(places, "doc_id"), "wanted_paths")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked = None, {}
        for segment, block in by_segment(batches):
            if segment != now:
                now, known, asked = segment, side_rows(folder, segment, ["doc_id", "path"]), {}
                if known is not None:
                    ids, keys = (known.column(n).to_numpy() for n in ("doc_id", "path"))
                    order = np.lexsort((keys, ids))
                    ids, keys = ids[order], keys[order]
                    cuts = np.flatnonzero(np.diff(ids)) + 1
                    groups = zip([0, *cuts], [*cuts, len(ids)])
                    asked = {int(ids[a]): keys[a:b] for a, b in groups}
            doc_ids = block.column("doc_id").to_pylist()
            some = pa.array([i for i, d in enumerate(doc_ids) if d in asked], pa.int64())
            if not len(some):
                continue
            block = block.take(some)
            doc_ids = block.column("doc_id").to_numpy()
            paths = BlockPaths(block, symbols, group)
            keys, chosen = paths.hashes(), np.zeros(len(paths.row), bool)
            edges = np.searchsorted(paths.row, np.arange(len(doc_ids) + 1))
            for d, a, b in zip(doc_ids.tolist(), edges[:-1], edges[1:]):
                chosen[a:b] = among(keys[a:b], asked[d])
            paths.keep(chosen)
            yield pa.RecordBatch.from_arrays([
                pa.array(paths.anchor.view(np.int64)), pa.array(keys[chosen]),
                pa.array(doc_ids[paths.row]),
                bodies(paths.data, paths.values, paths.low, paths.high),
            ], names=["anchor", "path", "owner", "body"])

    found = rows.mapInArrow(fetch, "anchor long, path long, owner long, body " + body)
    # A document that has a path twice gives it twice.
    return stage(spark, found, "branch_bodies").dropDuplicates(["anchor", "path"])


def gather(values: np.ndarray, low: np.ndarray, lengths: np.ndarray):
    """Stretches of ``values`` end to end, and their offsets."""
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    at = np.repeat(low - offsets[:-1], lengths) + np.arange(offsets[-1])
    return values[at], offsets.astype(np.int32)


def find_copies(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(segment, doc_id, mark) of documents whose text a smaller doc_id has too."""
    known = stage(spark, rows.select(
        "segment", "doc_id", F.unhex(F.md5("text")).alias("text_id"),
        F.crc32(F.encode("text", "UTF-8")).alias("mark"),
    ), "texts")
    firsts = known.groupBy("text_id").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    ).filter("first_id < last_id").select("text_id", "first_id")
    # Staged, so that a text which many documents share can be split in the join.
    copies = known.join(stage(spark, firsts, "first_of_text"), "text_id")
    return stage(
        spark, copies.filter("doc_id > first_id").select("segment", "doc_id", "mark"), "copies"
    )


def find_paths(
    spark: SparkSession, rows: DataFrame, copies: DataFrame, symbols: Symbols, group: int
) -> DataFrame:
    buckets = anchor_ranges(spark, rows, group)
    replies = shared_anchors(send_anchors(rows, symbols, group, buckets)).select(
        "segment", "anchors", F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("long").alias("mark"),
    )
    skips = copies.select("segment", F.lit(None).cast("binary").alias("anchors"), "doc_id", "mark")
    folder = side_files(spark, replies.union(skips), "shared_anchors")
    return stage(spark, paths_of(rows, folder, symbols, group), "paths")


def own_paths(spark: SparkSession, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(anchor, path, owner, repeated) of distinct paths, and (anchor, variants) where there
    are several."""
    told = paths.groupBy("anchor", "path").agg(
        F.min("doc_id").alias("owner"), (F.min("doc_id") < F.max("doc_id")).alias("repeated")
    )
    distinct = stage(spark, told, "distinct_paths")
    several = distinct.groupBy("anchor").agg(F.count("*").alias("variants")).filter("variants > 1")
    return distinct, stage(spark, several, "branching")


def span_files(
    spark: SparkSession, paths: DataFrame, distinct: DataFrame, covered: DataFrame,
    copies: DataFrame,
) -> str:
    """A folder of ``side_files``: pairs (first window, end) that repeat, by document; null
    for a copy, of which every window does.

    ``covered`` (anchor, path, offsets): windows of the owner's path that an earlier document
    has too.
    """
    rows = paths.select("segment", "doc_id", "mark", "anchor", "path", "start", "end")
    owned = distinct.filter("repeated").select("anchor", "path", "owner").join(
        covered, ["anchor", "path"], "full"
    )
    rows = rows.join(stage(spark, owned, "path_verdicts"), ["anchor", "path"])
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    whole = F.array(pair(F.col("start"), F.col("end")))
    single = F.transform("offsets", lambda o: pair(F.col("start") + o, F.col("start") + o + 1))
    found = F.when(F.col("doc_id") > F.col("owner"), whole).otherwise(single)
    rows = rows.select("segment", "doc_id", "mark", found.alias("f")).filter("size(f) > 0")
    spans = rows.groupBy("segment", "doc_id", "mark").agg(
        F.flatten(F.collect_list("f")).alias("found")
    )
    none = F.lit(None).cast(spans.schema["found"].dataType).alias("found")
    return side_files(spark, spans.union(copies.select("segment", "doc_id", "mark", none)), "spans")


NOTHING = (np.zeros(0, np.int64), np.zeros(0, np.int64))


def spans_by_document(known: pa.Table | None) -> dict:
    """First windows and their ends by (doc_id, mark), of what ``span_files`` wrote for a
    segment; None for a copy."""
    if known is None:
        return {}
    found = known.column("found").combine_chunks()
    starts, ends = (pc.list_flatten(found).field(i).to_numpy().astype(np.int64) for i in (0, 1))
    lengths = pc.fill_null(pc.list_value_length(found), -1).to_numpy()
    bounds = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])
    keys = zip(known.column("doc_id").to_pylist(), known.column("mark").to_pylist())
    return {
        key: (starts[a:b], ends[a:b]) if n >= 0 else None
        for key, n, a, b in zip(keys, lengths.tolist(), bounds[:-1], bounds[1:])
    }


def render(rows: DataFrame, folder: str, columns: list[str], cut, told: str) -> DataFrame:
    """``columns`` of all rows, and what ``cut(data, bounds, gone)`` makes of each block.

    ``gone(row, count)``: which of a row's ``count`` symbols lie in a window that repeats.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, spans = None, {}
        for segment, block in by_segment(batches):
            if segment != now:
                now = segment
                spans = spans_by_document(side_rows(folder, segment, ["doc_id", "mark", "found"]))
            data, bounds = flat(block.column("text"))
            doc_ids = block.column("doc_id").to_pylist()

            def gone(row: int, count: int) -> np.ndarray:
                found = spans.get((doc_ids[row], mark(data, bounds, row)), NOTHING)
                if found is None:
                    return np.full(count, count >= WINDOW)
                return covered_symbols(*found, count)

            made = cut(data, bounds, gone)
            arrays = [block.column(c) for c in columns] + list(made.values())
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, *made])

    fields = [rows.schema[c] for c in columns]
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    return rows.mapInArrow(run, kept + told)


def covered_symbols(starts: np.ndarray, ends: np.ndarray, count: int) -> np.ndarray:
    """Which of a document's ``count`` symbols lie in a window of ``starts`` to ``ends``."""
    covered = np.zeros(count, bool)
    if len(starts):
        order = np.argsort(starts)
        starts, reach = starts[order], np.maximum.accumulate(ends[order]) + WINDOW - 1
        apart = np.flatnonzero(starts[1:] > reach[:-1])
        for a, b in zip(starts[[0, *(apart + 1)]], reach[[*apart, -1]]):
            covered[a:b] = True
    return covered
