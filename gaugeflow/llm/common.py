"""What the operators share: staged tables, texts as flat bytes, words and their hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.session import shared_dir

U64 = np.uint64
BLOCK_BYTES = 1 << 20
# Separators of words, by contract: space, and the control characters 9 to 13.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, for the life of the application."""
    path = f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}/{name}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop.getParent())
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write are removed when it ends, not when the driver next collects
    garbage: nothing reads them again."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def stage(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder and read back: computed once, lineage cut."""
    path = scratch(spark, name)
    with shuffles_dropped(spark):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def with_rows(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Each row whole, as ``doc``, and ``_row``, a number that no other row has, the same
    whenever the files are read. Columns of ``documents`` can have any name."""
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("doc")
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("index")]
    try:
        placed = documents.select(whole, *place)
    except AnalysisException:  # not read from files: write it first
        placed = stage(spark, documents, "documents").select(whole, *place)
    number = F.row_number().over(Window.orderBy("file")).cast("long").alias("number")
    files = stage(spark, placed.select("file").distinct().select("file", number), "files")
    row = F.shiftleft("number", 36) + F.col("index")
    return placed.join(files, "file").select("doc", row.alias("_row"))


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The store and path of a folder or file given as path or URI."""
    return fs.FileSystem.from_uri(uri if uri.startswith("file:") or "://" in uri else f"file://{uri}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def blocks(batches: Iterator[pa.RecordBatch], name: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of some 1 MB of text; a longer text is a batch of its own."""
    for batch in batches:
        ends = np.cumsum(np.diff(flat(batch.column(name))[1]))
        begin = 0
        while begin < batch.num_rows:
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a column end to end, and the bounds of its rows; null is empty."""
    kind = pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string()
    column = column.cast(kind)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(kind) else "")
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[bounds[0] : bounds[-1]], bounds - bounds[0]


def strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The inverse of ``flat``."""
    buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, buffers)


def row_of(bounds: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return np.searchsorted(bounds, positions, "right") - 1


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the number of its first word."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(bounds), np.int64)
    inside = ~SEPARATOR[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, ~inside[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = True, ~inside[1:]
    before[bounds[bounds < len(data)]] = True
    after[bounds[bounds > 0] - 1] = True
    starts = np.flatnonzero(inside & before)
    ends = np.flatnonzero(inside & after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit over all others (splitmix64's constants)."""
    x = x.astype(U64)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BASE = 0x9E3779B97F4A7C15
def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of ``values[i:i + width]`` for each i, by doubling; fewer values give none."""
    if len(values) < width:
        return np.zeros(0, U64)
    done, taken, count = None, 0, len(values) - width + 1
    part, length, rest, base = values.astype(U64), 1, width, BASE
    while True:
        factor = U64(base)
        if rest & 1:
            piece = part[taken : taken + count]
            done = piece if done is None else done * factor + piece
            taken += length
        rest >>= 1
        if not rest:
            break
        part = part[: len(part) - length] * factor + part[length:]
        length, base = 2 * length, base * base % (1 << 64)
    return mix(done)


# The bytes that count of the last eight, for a span that ends within them.
_KEPT = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)


def span_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0
) -> np.ndarray:
    """A 64-bit hash, by seed, of ``data[start:end]`` for each span; spans are in ascending order.

    Eight bytes at a time are mixed, again with their place in the span, and then summed. (The
    sum of a polynomial modulo 2**64 would not do: over 1,024 bytes there are pairs of texts
    for which all terms cancel, whatever the base.)
    """
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        low = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, low + BLOCK_BYTES, "right")))
        part = np.concatenate([data[low : ends[stop - 1]], np.zeros(8, np.uint8)])
        first, length = starts[at:stop] - low, ends[at:stop] - starts[at:stop]
        counts = np.maximum(1, (length + 7) // 8)
        begins = np.concatenate([[0], np.cumsum(counts)])
        place = np.arange(begins[-1]) - np.repeat(begins[:-1], counts)
        where = np.repeat(first, counts) + 8 * place
        eight = part[where[:, None] + np.arange(8)].view("<u8")[:, 0]
        eight &= _KEPT[np.minimum(np.repeat(length, counts) - 8 * place, 8)]
        terms = mix(mix(eight ^ U64(seed)) + (place.astype(U64) + U64(1)) * U64(BASE))
        out[at:stop] = mix(np.add.reduceat(terms, begins[:-1]) + length.astype(U64))
        at = stop
    return out


# The two largest primes below 2**31, and a base for each.
PRIMES = ((2147483647, 1103515245), (2147483629, 1812433253))
_prime_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_modulo(prime: int, base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """``base`` to the powers 0, 1, 2 ... modulo ``prime``, and their inverses."""
    if prime not in _prime_powers or len(_prime_powers[prime][0]) < count:
        size = 1 << max(16, int(count).bit_length())
        tables = []
        for factor in (base % prime, pow(base, -1, prime)):
            table, done = np.ones(size, U64), 1
            while done < size:
                step = U64(pow(factor, done, prime))
                table[done : 2 * done] = table[: min(done, size - done)] * step % U64(prime)
                done *= 2
            tables.append(table)
        _prime_powers[prime] = tuple(tables)
    up, down = _prime_powers[prime]
    return up[:count], down[:count]


# Symbols that stretches hashed together begin in; the tables of powers need little more.
STRETCH_SYMBOLS = 1 << 16


def stretch_hashes(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A hash of ``values[low:high]`` for each stretch, of 62 bits; stretches may overlap and
    are in order of ``low``.

    Two polynomials, modulo two primes, so that no arrangement of values makes terms cancel.
    """
    out = np.empty(len(low), U64)
    at = 0
    while at < len(low):
        stop = int(np.searchsorted(low, low[at] + STRETCH_SYMBOLS))
        out[at:stop] = _hashed_together(values, low[at:stop], high[at:stop])
        at = stop
    return out


def _hashed_together(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    length = (high - low).astype(U64)
    out = length * U64(BASE)
    first, last = int(low.min()), int(high.max())
    values = values[first:last]
    small = values.dtype == np.uint8 and len(values) < 1 << 24
    for prime, base in PRIMES:
        p = U64(prime)
        up, down = _powers_modulo(prime, base, len(values) + 1)
        terms = (values.astype(U64) + U64(1)) * up[:-1] if small else (
            (values.astype(U64) % p + U64(1)) * up[:-1] % p
        )
        # Below 2**64: of bytes there are fewer than 2**24, of other values each is below 2**31.
        sums = np.zeros(len(values) + 1, U64)
        np.cumsum(terms, out=sums[1:])
        own = (sums[high - first] - sums[low - first]) % p * down[low - first] % p
        out = mix(out) + own
    return mix(out)


def sums_by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values[bounds[i]:bounds[i + 1]]`` for each i, each summed by itself."""
    out = np.zeros(len(bounds) - 1, values.dtype if values.dtype.kind == "f" else np.int64)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, bounds[full], dtype=out.dtype)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
