"""Near-duplicate vectors by binary codes of random rotations.

A unit vector x, rotated at random, is coded by the signs of its coordinates. The code stands
for the corner c of the cube nearest to the rotated x; with the stored factor <c, x> the
product <c, y> / <c, x> is an unbiased estimate of the cosine of x and any y. Its error is
sin(x, y) * sqrt(1 - <c, x>^2) / <c, x> times the cosine between two directions, which over
the rotations is about ``z / sqrt(dimension - 1)``, and never above 1. Only pairs whose
estimate plus that bound reaches the threshold are recomputed, in double precision. The
default bound is the one that always holds, so estimates never cost a link.

Bands of code bits, of several rotations, propose the pairs: vectors of one label that agree
in a band share a bucket. At the threshold a bit differs with probability arccos(0.98) / pi;
with 90 bands of 24 bits a pair at the threshold is missed once in some thousand million, a
closer one yet more rarely, and vectors of no likeness meet in one of 190,000 pairs. A pair is counted in the first band that it shares, so no pair is written
and none counts twice. Equal vectors count once, with their number; buckets with the same
members count once; a large bucket is compared in blocks, each pair of blocks on its own.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm.common import stage
from gaugeflow.llm.components import components

COSINE = 0.98
BANDS, BAND_BYTES = 90, 3
BLOCK_VECTORS = 4096
ROWS_AT_ONCE = 256
SEED = 20

CODED = (
    "row long, vec_id long, label long, digest binary, vector binary, code binary, factor double"
)


@functools.lru_cache(maxsize=8)
def rotations(dimension: int, seed: int = SEED) -> np.ndarray:
    """Random orthogonal matrices, one below the other, for as many bits as the bands need."""
    draw = np.random.default_rng([seed, dimension])
    count = -(-BANDS * BAND_BYTES * 8 // dimension)
    parts = []
    for _ in range(count):
        q, r = np.linalg.qr(draw.standard_normal((dimension, dimension)))
        parts.append((q * np.sign(np.diag(r))).T)
    return np.concatenate(parts)


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    """Scaled first, so that neither tiny nor huge components are lost in a square."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed code bits of unit vectors, and the factor of the first rotation's code."""
    dimension = vectors.shape[1]
    turned = vectors @ rotations(dimension).T
    factor = np.abs(turned[:, :dimension]).sum(axis=1) / math.sqrt(dimension)
    return np.packbits(turned >= 0, axis=1), factor


def band_words(codes: np.ndarray) -> np.ndarray:
    """The bands of packed codes as numbers."""
    parts = codes[:, : BANDS * BAND_BYTES].reshape(len(codes), BANDS, BAND_BYTES)
    return parts.astype(np.int64) @ (256 ** np.arange(BAND_BYTES))


def corners(codes: np.ndarray, dimension: int) -> np.ndarray:
    """The corners that the first rotation's codes stand for, turned back."""
    bits = np.unpackbits(codes, axis=1, count=dimension).astype(np.float64)
    return (2 * bits - 1) @ rotations(dimension)[:dimension] / math.sqrt(dimension)


def margins(factor: np.ndarray, dimension: int, cosine: float, z: float | None) -> np.ndarray:
    """How far below the cosine the estimate of a pair at the threshold can be."""
    spread = np.sqrt(np.maximum(0, 1 - factor**2)) / factor
    share = 1.0 if z is None or dimension < 2 else min(1.0, z / math.sqrt(dimension - 1))
    return math.sqrt(1 - cosine**2) * spread * share + 1e-9


def coded(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    """Every row with its code; those that can link with nothing have no digest.

    The digest tells equal vectors of one label apart from others. ``vector`` holds the
    components as 64-bit floats.
    """
    names = ["row", "vec_id", "label", "digest", "vector", "code", "factor"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, labels = batch.column("embedding"), batch.column("label").to_pylist()
            found: list[tuple] = [(None, None, None, None)] * batch.num_rows
            by_size: dict[int, list[int]] = {}
            arrays: dict[int, np.ndarray] = {}
            for i, label in enumerate(labels):
                if label is None or not lists[i].is_valid:
                    continue
                values = lists[i].values
                if len(values) == 0 or values.null_count:
                    continue
                vector = values.to_numpy(zero_copy_only=False).astype("<f8")
                if np.isfinite(vector).all() and vector.any():
                    arrays[i] = vector
                    by_size.setdefault(len(vector), []).append(i)
            for rows in by_size.values():
                codes, factors = encode(unit_vectors(np.stack([arrays[i] for i in rows])))
                for i, code, factor in zip(rows, codes, factors):
                    data = arrays[i].tobytes()
                    digest = hashlib.sha256(b"%d:" % labels[i] + data).digest()
                    found[i] = (digest, data, code.tobytes(), float(factor))
            columns = [batch.column("row"), batch.column("vec_id"), batch.column("label")]
            columns += [pa.array([f[k] for f in found], kinds[3 + k]) for k in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = embeddings.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.col("label").cast("long").alias("label"),
    )
    return stage(spark, rows.mapInArrow(run, CODED), "codes")


def members(spark: SparkSession, distinct: DataFrame, block: int) -> DataFrame:
    """(band, bucket, part, blocks, block, id) of the buckets with several vectors.

    ``part`` names a pair of blocks of the bucket. Of buckets with the same members that of the
    first band stays, which is where their pairs count.
    """
    cut = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda k: F.substring("code", k * BAND_BYTES + 1, F.lit(BAND_BYTES)),
    )
    words = distinct.select(
        "id", "label", F.octet_length("vector").alias("size"), F.posexplode(cut).alias("band", "word")
    )
    rows = words.select(
        "id", "band", F.xxhash64("label", "size", "band", "word").alias("bucket")
    )
    buckets = rows.groupBy("bucket").agg(
        F.min("band").alias("band"), F.count("*").alias("n"), F.min("id").alias("low"),
        F.max("id").alias("high"), F.bit_xor(F.xxhash64("id")).alias("ids"),
    ).filter("n > 1")
    once = buckets.groupBy("n", "low", "high", "ids").agg(F.min(F.struct("band", "bucket")).alias("b"))
    blocks = F.ceil(F.col("n") / block).cast("int").alias("blocks")
    once = stage(spark, once.select("b.bucket", blocks), "buckets")
    held = rows.join(once, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    # A pair of blocks is low * blocks + high; each block meets itself and every other.
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.least(o, "block") * F.col("blocks") + F.greatest(o, "block"),
    )
    return held.select("band", "bucket", "blocks", "block", "id", F.explode(pairs).alias("part"))


def link_block(table: pa.Table, cosine: float, z: float | None) -> pa.Table:
    """Links of a bucket's two blocks: number by id (``b`` null), and (a, b) that join classes."""
    table = table.sort_by("id")
    ids, copies = (table.column(c).to_numpy() for c in ("id", "copies"))
    block, band = table.column("block").to_numpy(), table.column("band")[0].as_py()
    vectors = np.stack([np.frombuffer(v, "<f8") for v in table.column("vector").to_pylist()])
    codes = np.stack([np.frombuffer(c, np.uint8) for c in table.column("code").to_pylist()])
    factor = table.column("factor").to_numpy()
    units, words, dimension = unit_vectors(vectors), band_words(codes), vectors.shape[1]
    mine = words[:, band]
    decoded = corners(codes, dimension) / factor[:, None]
    least = cosine - margins(factor, dimension, cosine, z)
    # The part, not the blocks present: one of the two can be empty.
    part, blocks = table.column("part")[0].as_py(), table.column("blocks")[0].as_py()
    crossing = part // blocks != part % blocks
    count = np.zeros(len(ids), np.int64)
    first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for low in range(0, len(ids), ROWS_AT_ONCE):
        some = slice(low, low + ROWS_AT_ONCE)
        near = decoded[some] @ units[low:].T >= least[some, None]
        i, j = np.nonzero(near)
        i, j = i + low, j + low
        # Buckets are told by a hash, so the words are compared as well.
        fit = (i < j) & (mine[i] == mine[j])
        if crossing:
            fit &= block[i] != block[j]
        i, j = i[fit], j[fit]
        for at in range(0, len(i), 1 << 18):
            a, b = i[at : at + (1 << 18)], j[at : at + (1 << 18)]
            new = ~(words[a, :band] == words[b, :band]).any(axis=1)
            a, b = a[new], b[new]
            linked = np.einsum("ij,ij->i", units[a], units[b]) >= cosine
            a, b = a[linked], b[linked]
            np.add.at(count, a, copies[b])
            np.add.at(count, b, copies[a])
            first.append(a)
            second.append(b)
    a, b = np.concatenate(first), np.concatenate(second)
    own = np.arange(len(ids))
    while True:  # the least number of a class spreads over it
        before = own.copy()
        np.minimum.at(own, a, own[b])
        np.minimum.at(own, b, own[a])
        own = own[own]
        if (own == before).all():
            break
    joined, counted = np.flatnonzero(own != np.arange(len(ids))), np.flatnonzero(count)
    return pa.table({
        "a": pa.array(np.concatenate([ids[joined], ids[counted]])),
        "b": pa.array([*ids[own[joined]].tolist(), *[None] * len(counted)], pa.int64()),
        "n": pa.array(np.concatenate([np.zeros(len(joined), np.int64), count[counted]])),
    })


def link_vectors(
    spark: SparkSession, embeddings: DataFrame, cosine: float = COSINE, z: float | None = None,
    block: int = BLOCK_VECTORS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors link when their labels are equal and not null, they have as many components, and
    their cosine is at least ``cosine``. ``z`` is the width of the confidence bound in standard
    errors; without it the bound holds always. Vectors that are null, empty, zero, or hold null
    or non-finite components link with nothing. Rows that repeat a vec_id count each for
    itself. A row without vec_id never names a component, and is kept if there is no other name
    for its component and it comes first. An empty table gives no rows. Only vec_id, embedding
    and label are read, so other columns may have any name.
    """
    rows = coded(spark, embeddings)
    valid = rows.filter("digest IS NOT NULL")
    order = F.struct(F.col("vec_id").isNull().alias("nameless"), "vec_id", "row")
    firsts = valid.groupBy("digest").agg(F.min(order).alias("f"), F.count("*").alias("copies"))
    firsts = stage(
        spark,
        firsts.select("digest", F.col("f.row").alias("id"), F.col("f.vec_id").alias("least"), "copies"),
        "distinct",
    )
    codes = valid.select(F.col("row").alias("id"), "label", "vector", "code", "factor")
    distinct = codes.join(firsts.select("id", "copies"), "id")
    places = members(spark, distinct, block)
    payload = distinct.select("id", "copies", "vector", "code", "factor")
    found = places.join(payload, "id").groupBy("bucket", "part").applyInArrow(
        lambda t: link_block(t, cosine, z), "a long, b long, n long"
    )
    found = stage(spark, found, "found")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    classes = components(spark, found.filter("b IS NOT NULL").select("a", "b"))
    named = firsts.join(counts, "id", "left").join(classes, "id", "left").select(
        "digest", "least", F.col("id").alias("first"), F.coalesce("label", "id").alias("class"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    named = stage(spark, named, "named")
    # Of a class the least name, and for nameless classes the first row.
    names = named.groupBy("class").agg(F.min("least").alias("component_id"), F.min("first").alias("head"))
    whole = named.join(stage(spark, names, "names"), "class").select(
        "digest", "n_links", "component_id", "head"
    )
    # Staged, so that a vector which many rows share can be split in the join.
    joined = rows.select("row", "vec_id", "digest").join(
        stage(spark, whole, "classes"), "digest", "left"
    )
    lone = F.col("n_links").isNull()
    component = F.when(lone, F.col("vec_id")).otherwise(F.col("component_id"))
    kept = F.when(component.isNull(), lone | (F.col("row") == F.col("head"))).otherwise(
        F.coalesce(F.col("vec_id") == component, F.lit(False))
    )
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), kept.alias("kept"),
    )


def oracle() -> str:
    """The contract of the query as DuckDB SQL, over all pairs of a label."""
    return """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
        ), l AS (
            SELECT a.vec_id AS a, b.vec_id AS b
            FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.98
        ), r(id, far) AS (
            SELECT vec_id, vec_id FROM embeddings
            UNION
            SELECT r.id, l.b FROM r JOIN l ON l.a = r.far
        ), c AS (SELECT id, min(far) AS component_id FROM r GROUP BY id)
        SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id,
               e.vec_id = c.component_id AS kept
        FROM embeddings e JOIN c ON c.id = e.vec_id
        LEFT JOIN (SELECT a, count(*) AS n_links FROM l GROUP BY a) n ON n.a = e.vec_id
    """
