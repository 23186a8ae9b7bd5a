"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

Pieces above a third of the capacity share a sequence with at most one other such piece;
they are matched greedily, each, longest first, with the longest that still fits. Shorter
pieces then go, longest first, to the tightest gap that holds them.

Pieces of one length are interchangeable, so packing needs only how many there are of each
length: at most ``capacity`` numbers, whatever the size of the corpus. The result is a short
list of runs ("the pieces of this length from rank a on go to the sequences from b on"), and
every piece finds its place by joining its rank among pieces of its length with that list.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import shuffle_partitions, stage

END_OF_TEXT = "<|endoftext|>"
# How this vocabulary splits a text before merging bytes.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
# Blanks in a row that the fast encoder's patterns are known to take.
MOST_BLANKS = 100_000
_blanks = re.compile(r"\s{%d}" % MOST_BLANKS)
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"

Run = tuple[int, int, int, int, int, int]


class Vocabulary:
    """A byte-level vocabulary by the paths of its rank file and of its JSON form.

    The files are read where the job is planned and go to the tasks with it; each worker
    loads them once. Both forms give the same ids; the rank form encodes several times faster
    and straight into arrays, but gives up on a million blanks in a row. Texts with a tenth of
    that are encoded by the JSON form.
    """

    loaded: dict[tuple[str, str], object] = {}

    def __init__(self, path: str, json_path: str):
        self.path, self.json_path = path, json_path
        with open(path, "rb") as ranks, open(json_path, "rb") as described:
            self.ranks, self.described = ranks.read(), described.read()

    def _fast(self):
        import tiktoken

        ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, self.ranks.splitlines())}
        return tiktoken.Encoding(
            "by_path", pat_str=SPLIT, mergeable_ranks=ranks,
            special_tokens={END_OF_TEXT: len(ranks)},
        )

    def _exact(self):
        import tokenizers

        return tokenizers.Tokenizer.from_str(self.described.decode())

    def _load(self, form: str):
        key = (form, self.path)
        if key not in self.loaded:
            self.loaded[key] = getattr(self, form)()
        return self.loaded[key]

    def encode(self, text: str) -> np.ndarray:
        if len(text) >= MOST_BLANKS and _blanks.search(text):
            return np.array(self._load("_exact").encode(text, add_special_tokens=False).ids, np.uint32)
        return self._load("_fast").encode_to_numpy(text, allowed_special="all")


def cut(length: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: only the first may be shorter than the capacity."""
    full, rest = divmod(length, capacity)
    return [rest] * (rest > 0) + [capacity] * full


def token_pieces(
    documents: DataFrame, vocabulary: Vocabulary, capacity: int = 2048, with_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens; each document is closed by token 0.

    A null or empty text is a single token 0. With ``with_ids`` a column ``ids`` holds the
    tokens as little-endian 32-bit numbers. A null ``doc_id`` stays null.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for doc_id, text in zip(doc_ids, texts):
                encoded = vocabulary.encode(text.as_py() or "")
                ids = np.append(encoded, 0).astype("<u4").tobytes()
                start = 0
                for piece, length in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, piece, start, length, zlib.crc32(own))
                    rows.append(row + (own,) if with_ids else row)
                    start += length
            columns = zip(*rows) if rows else [[]] * len(schema)
            arrays = [pa.array(c, t) for c, t in zip(columns, schema.types)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    fields = [("doc_id", pa.int64()), ("piece", pa.int32())]
    fields += [(n, pa.int64()) for n in ("start", "length", "ids_crc32")]
    schema = pa.schema(fields + [("ids", pa.binary())] * with_ids)
    told = PIECE_SCHEMA + (", ids binary" if with_ids else "")
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(encode, told)


def plan_sequences(counts: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Runs (length, rank, pieces, pieces per sequence, sequence, offset); sequences used.

    The j-th piece of a run goes to ``sequence + j // per`` at ``offset + j % per * length``.
    A run ends a length or takes a whole interval of equal gaps; an interval's gap at least
    halves each time, so there are fewer than ``6 * capacity * log2(capacity)`` runs.
    """
    left = [0] * (capacity + 1)
    for length, count in counts.items():
        left[length] = count
    used = [0] * (capacity + 1)
    runs: list[Run] = []
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    sequences = 0

    def place(length: int, count: int, per: int, sequence: int, offset: int) -> None:
        runs.append((length, used[length], count, per, sequence, offset))
        used[length] += count
        left[length] -= count

    third = capacity // 3
    partner = capacity
    for length in range(capacity, third, -1):
        while left[length]:
            partner = min(length, capacity - length)
            while partner > third and not left[partner]:
                partner -= 1
            if partner <= third:
                number = left[length]
                place(length, number, 1, sequences, 0)
                gaps[capacity - length].append((sequences, number))
            elif partner == length and left[length] > 1:
                number = left[length] // 2
                place(length, 2 * number, 2, sequences, 0)
                gaps[capacity - 2 * length].append((sequences, number))
            else:
                if partner == length:
                    partner -= 1
                    while partner > third and not left[partner]:
                        partner -= 1
                    if partner <= third:
                        place(length, 1, 1, sequences, 0)
                        gaps[capacity - length].append((sequences, 1))
                        sequences += 1
                        continue
                number = min(left[length], left[partner])
                place(length, number, 1, sequences, 0)
                place(partner, number, 1, sequences, length)
                gaps[capacity - length - partner].append((sequences, number))
            sequences += number
    for length in range(third, 0, -1):
        gap = length
        while left[length]:
            while gap <= capacity and not gaps[gap]:
                gap += 1
            if gap > capacity:
                number = -(-left[length] // (capacity // length))
                gaps[capacity].append((sequences, number))
                sequences += number
                gap = capacity
            first, number = gaps[gap].pop()
            per = min(gap // length, left[length])
            take = min(number, left[length] // per)
            place(length, take * per, per, first, capacity - gap)
            gaps[gap - per * length].append((first, take))
            if take < number:
                gaps[gap].append((first + take, number - take))
            gap = length
    return runs, sequences


def pack(spark: SparkSession, pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, gapless in every sequence.

    Needs ``doc_id``, ``piece``, ``start``, ``length`` (1 to ``capacity``) and ``ids_crc32``;
    other columns stay. Equal rows are packed each for itself; no rows give no rows. A length
    that a third of all pieces have is ranked in as many parts as there are partitions.
    """
    salt = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(shuffle_partitions(spark)))
    salted = pieces.withColumn("_salt", salt)
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_count"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(
        Window.unboundedPreceding, -1
    )
    begins = stage(
        spark, counts.withColumn("_begin", F.coalesce(F.sum("_count").over(before), F.lit(0))),
        "length_counts",
    )
    totals = begins.groupBy("length").agg(F.sum("_count").alias("pieces")).collect()
    runs, _ = plan_sequences({r.length: r.pieces for r in totals}, capacity)
    plan = spark.createDataFrame(
        runs,
        "length long, _rank long, _pieces long, _per long, _sequence long, _offset long",
    )
    order = ["doc_id", "piece", "start", "ids_crc32"]
    within = Window.partitionBy("length", "_salt").orderBy(*order)
    ranked = (
        salted.withColumn("_row", F.row_number().over(within) - 1)
        .join(begins.drop("_count"), ["length", "_salt"])
        .withColumn("_row", F.col("_row") + F.col("_begin"))
    )
    # The plan's size is bounded by the capacity alone, see plan_sequences.
    placed = ranked.join(
        F.broadcast(plan.withColumnRenamed("length", "_length")),
        (F.col("length") == F.col("_length"))
        & (F.col("_row") >= F.col("_rank"))
        & (F.col("_row") < F.col("_rank") + F.col("_pieces")),
    )
    nth = F.col("_row") - F.col("_rank")
    sequence = F.col("_sequence") + F.floor(nth / F.col("_per"))
    return placed.select(
        *pieces.columns,
        sequence.cast("long").alias("sequence_id"),
        (F.col("_offset") + nth % F.col("_per") * F.col("length")).alias("offset"),
    )


def pack_documents(
    spark: SparkSession, documents: DataFrame, vocabulary: Vocabulary, capacity: int = 2048
) -> DataFrame:
    """Every document tokenized once, cut and packed."""
    pieces = stage(spark, token_pieces(documents, vocabulary, capacity), "pieces")
    return pack(spark, pieces, capacity)
