"""Repeated byte passages, found in suffix order with a Burrows-Wheeler transform.

Paths of windows that share an anchor (see ``repeats``) are gathered into groups that fit a
task. A group's suffixes are sorted, and common prefix lengths are found in rising order by
breadth-first backward extension on the transform: the interval of every string of length l
gives those of length l + 1, and an interval goes on only where its end was not known before.
At 50 bytes the search stops. Boundaries still unknown then lie between suffixes that share
50 bytes or more, so what remains between known boundaries are classes of equal windows.

An anchor with more different paths than a group holds is cut into chunks. A chunk settles
what repeats within it; of each class only the earliest window goes on, with a hash, and a
join finds an earlier document among the other chunks.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import repeats
from gaugeflow.llm.common import U64, flat, rolling, row_of, stage, text_or_empty

GROUP = 24
GROUP_PATHS = 2000
NEVER = np.iinfo(np.int64).max


def symbols(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data, bounds


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of suffixes in order of their first 64 symbols; past the end come zeros.

    Ranks by eight symbols give those by 16, 32 and 64.
    """
    part = np.concatenate([text, np.zeros(72, np.uint8)]).astype(U64)
    for width in (1, 2, 4):
        part = part[: len(part) - width] << U64(8 * width) | part[width:]
    keys, far = part[: len(text) + 64], 8
    while True:
        order = np.argsort(keys)
        if far == 64:
            return order[order < len(text)]
        ordered = keys[order]
        ranks = np.zeros(len(keys) + far, U64)
        ranks[order[1:]] = np.cumsum(ordered[1:] != ordered[:-1])
        keys = ranks[: len(keys)] << U64(32) | ranks[far:]
        far *= 2


def window_classes(text: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """For each place in ``order`` the number of its class of suffixes that share ``least``
    symbols."""
    count = len(text)
    transform = text[order - 1]
    column = np.argsort(transform, kind="stable")
    lead = transform[column]
    step = np.empty(count, np.int32)
    step[column] = np.arange(count)
    known = np.zeros(count + 1, bool)
    known[[0, count]] = True
    # Only the rows of intervals that go on are looked at.
    rows, interval = np.arange(count), np.zeros(count, np.int32)
    inside, source = np.zeros(count, bool), np.empty(count, np.int32)
    for _ in range(least):
        if not len(rows):
            break
        moved = step[rows]
        inside[moved], source[moved] = True, interval
        rows = np.flatnonzero(inside)
        inside[rows] = False
        came, first = source[rows], lead[rows]
        cut = np.ones(len(rows) + 1, bool)
        cut[1:-1] = (np.diff(rows) > 1) | (came[1:] != came[:-1]) | (first[1:] != first[:-1])
        ends = rows[cut[1:]] + 1
        fresh = ~known[ends]
        known[ends] = True
        number = np.cumsum(cut[:-1], dtype=np.int32) - 1
        live = fresh[number]
        rows, interval = rows[live], number[live]
    return np.cumsum(known[:count]) - 1


def classified(table: pa.Table):
    """(path number, offset, class) of all windows of a group's paths, in suffix order."""
    data, bounds = flat(table.column("body").combine_chunks())
    lengths = np.diff(bounds)
    starts = bounds[:-1] + np.arange(len(lengths))
    text = np.zeros(len(data) + len(lengths), np.uint8)
    text[np.arange(len(data)) + row_of(bounds, np.arange(len(data)))] = data + np.uint8(1)
    order = suffix_order(text)
    classes = window_classes(text, order, repeats.WINDOW)
    path = np.searchsorted(starts, order, "right") - 1
    offset = order - starts[path]
    window = offset + repeats.WINDOW <= lengths[path]
    return path[window], offset[window], classes[window], text, order[window]


def least_by_class(classes: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """For each window the least owner in its class; classes are in ascending order."""
    begins = np.flatnonzero(np.diff(classes, prepend=-1))
    least = np.minimum.reduceat(owners, begins)
    return least[np.cumsum(np.diff(classes, prepend=-1) > 0) - 1]


def lists_by_path(path: np.ndarray, offset: np.ndarray, count: int):
    """Row lists of ``offset`` for paths 0 to ``count``, and the order the values are in."""
    order = np.lexsort((offset, path))
    bounds = np.searchsorted(path[order], np.arange(count + 1)).astype(np.int32)
    values = pa.array(offset[order].astype(np.int32))
    return pa.ListArray.from_arrays(pa.array(bounds), values), order


def resolve_group(table: pa.Table) -> pa.Table:
    """(anchor, path, offsets): windows of a path that a path of a smaller doc_id has too."""
    path, offset, classes, _, _ = classified(table)
    owners = table.column("owner").to_numpy()[path]
    hit = least_by_class(classes, owners) < owners
    offsets, _ = lists_by_path(path[hit], offset[hit], table.num_rows)
    made = table.select(["anchor", "path"]).append_column("offsets", offsets)
    return made.filter(pc.greater(pc.list_value_length(made.column("offsets")), 0))


def resolve_chunk(table: pa.Table) -> pa.Table:
    """(anchor, path, owner, offsets, open, edges): ``offsets`` as for a group; ``open`` and
    ``edges`` are the windows that are the earliest of their class here, and their hashes."""
    path, offset, classes, text, at = classified(table)
    owners = table.column("owner").to_numpy()[path]
    hit = least_by_class(classes, owners) < owners
    offsets, _ = lists_by_path(path[hit], offset[hit], table.num_rows)
    still, order = lists_by_path(path[~hit], offset[~hit], table.num_rows)
    hashes = rolling(text, repeats.WINDOW)[at[~hit]][order].view(np.int64)
    made = table.select(["anchor", "path", "owner"]).append_column("offsets", offsets)
    made = made.append_column("open", still)
    return made.append_column("edges", pa.ListArray.from_arrays(still.offsets, pa.array(hashes)))


def branch_windows(spark: SparkSession, branches: DataFrame, several: DataFrame) -> DataFrame:
    """(anchor, path, offsets) of windows that an earlier document has in another path."""
    rows = branches.join(several, "anchor")
    total = several.agg(F.coalesce(F.sum("variants"), F.lit(0)).alias("n")).first().n
    groups = 1 + total // GROUP_PATHS
    small = rows.filter(F.col("variants") <= GROUP_PATHS)
    told = "anchor long, path long, offsets array<int>"
    within = small.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(groups)).alias("g")).applyInArrow(
        resolve_group, told
    )
    chunk = F.pmod(F.xxhash64("path"), F.ceil(F.col("variants") / GROUP_PATHS)).alias("chunk")
    parts = stage(spark, rows.filter(F.col("variants") > GROUP_PATHS).groupBy(
        "anchor", chunk
    ).applyInArrow(
        resolve_chunk,
        "anchor long, path long, owner long, offsets array<int>, open array<int>, edges array<long>",
    ), "chunks")
    single = parts.select(
        "anchor", "path", "owner", F.explode(F.arrays_zip("open", "edges")).alias("w")
    ).select("anchor", "path", "owner", F.col("w.open").alias("offset"), F.col("w.edges").alias("edge"))
    least = single.groupBy("anchor", "edge").agg(
        F.min("owner").alias("least"), F.max("owner").alias("most")
    ).filter("least < most").select("anchor", "edge", "least")
    across = single.join(stage(spark, least, "shared_windows"), ["anchor", "edge"])
    across = across.filter("least < owner").groupBy("anchor", "path").agg(
        F.collect_list("offset").alias("found")
    )
    hot = parts.select("anchor", "path", "offsets").join(across, ["anchor", "path"], "left").select(
        "anchor", "path",
        F.concat("offsets", F.coalesce("found", F.array().cast("array<int>"))).alias("offsets"),
    )
    return within.union(hot)


def bodies(data: np.ndarray, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Array:
    """The bytes of each path's windows."""
    parts, offsets = repeats.gather(data, low, high - low + repeats.WINDOW - 1)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(parts)]
    return pa.Array.from_buffers(pa.binary(), len(low), buffers)


def find_spans(spark: SparkSession, rows: DataFrame) -> str:
    """Files of what repeats in the texts of ``rows``, see ``repeats.span_files``."""
    copies = repeats.find_copies(spark, rows)
    paths = repeats.find_paths(spark, rows, copies, symbols, GROUP)
    distinct, several = repeats.own_paths(spark, paths)
    branches = repeats.branch_bodies(
        spark, rows, distinct, several, symbols, GROUP, bodies, "binary"
    )
    covered = stage(spark, branch_windows(spark, branches, several), "covered")
    return repeats.span_files(spark, paths, distinct, covered, copies)


def digests(data: np.ndarray, bounds: np.ndarray, gone) -> dict[str, pa.Array]:
    rows = []
    for i, size in enumerate(np.diff(bounds).tolist()):
        kept, cut = data[bounds[i] : bounds[i + 1]], gone(i, size)
        removed, runs = int(np.count_nonzero(cut)), 0
        if removed:
            kept = kept[~cut]
            runs = int(cut[0]) + int(np.count_nonzero(cut[1:] & ~cut[:-1]))
        rows.append((size, removed, runs, hashlib.sha256(kept.tobytes()).hexdigest()))
    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    return dict(zip(names, map(pa.array, zip(*rows))))


def remove_repeats(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row.

    Removed is each byte in a 50-byte string that also starts in a document with a smaller
    doc_id; strings are judged on the input. Null texts are empty. Rows of equal doc_id do not
    count as earlier than each other. A row without doc_id is returned whole. No rows give no
    rows.
    """
    rows = repeats.texts_of(repeats.with_segments(spark, documents))
    told = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return repeats.render(rows, find_spans(spark, rows), ["doc_id"], digests, told)


def remaining(data: np.ndarray, bounds: np.ndarray, gone) -> dict[str, pa.Array]:
    """Texts without what repeats, and without what is left of characters cut in two."""
    texts = []
    for i, size in enumerate(np.diff(bounds).tolist()):
        kept = data[bounds[i] : bounds[i + 1]][~gone(i, size)]
        texts.append(kept.tobytes().decode("utf-8", "ignore"))
    return {"kept": pa.array(texts, pa.string())}


def cleaned(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """``documents`` with repeats removed from ``text``; all other columns as they are.

    A document of which nothing is left goes; one that was empty stays. Null text stays null.
    """
    placed = repeats.with_segments(spark, documents)
    rows = repeats.texts_of(placed)
    folder = find_spans(spark, rows)
    others = [F.col("doc")[c].alias(c) for c in documents.columns if c != "text"]
    carried = placed.select(
        "segment", F.col("doc.doc_id").cast("long").alias("doc_id"),
        text_or_empty("doc.text").alias("text"), F.col("doc.text").isNull().alias("no_text"),
        F.struct(*others).alias("row"),
    )
    carried = carried.withColumn("was_empty", F.col("text") == "")
    made = repeats.render(
        carried, folder, ["row", "no_text", "was_empty"], remaining, "kept string"
    ).filter("was_empty OR kept != ''")
    text = F.when(~F.col("no_text"), F.col("kept")).alias("text")
    return made.select(
        *[text if c == "text" else F.col("row")[c].alias(c) for c in documents.columns]
    )
