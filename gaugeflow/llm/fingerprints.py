"""One-permutation MinHash fingerprints, from DataFrame functions only.

Each shingle of five words is hashed once. The high bits of a hash choose one of the bins and
the smallest hash of a bin stays; sorting a text's hashes brings a bin's smallest to the front
of its run. An empty bin takes the hash of another: it asks the bins in an order of its own,
fixed by hashes of its number, until one is not empty (optimal densification). Of every bin
low-order bits are stored, packed as text, and likeness is corrected for bits that agree by
chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.functions.once import evaluated_once
from gaugeflow.llm.common import shuffle_partitions, text_or_empty

BIN_BITS = 7
BINS = 1 << BIN_BITS
STORED_BITS = 4
SHINGLE_WORDS = 5
PROBES = 4
SEPARATORS = r"[\x20\x09-\x0D]+"


def bin_of(value: Column) -> Column:
    return F.shiftrightunsigned(value, 64 - BIN_BITS).cast("int")


def with_bits(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with ``name``: the stored bits of each bin, or no bits for a text without words.

    A text of one to four words is a single shingle. Steps that later steps look into are
    computed once, see ``evaluated_once``.
    """
    trimmed = F.btrim(F.col(text), F.lit(" \t\n\x0b\f\r"))
    words = F.transform(F.split(trimmed, SEPARATORS), lambda w: F.xxhash64(w))
    none = F.array().cast("array<bigint>")
    words = F.when(trimmed != "", words).otherwise(none)
    rows = rows.withColumn("_words", evaluated_once(words))
    words = F.col("_words")
    last = F.greatest(F.size(words) - SHINGLE_WORDS, F.lit(0))
    shingle = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE_WORDS)])
    hashes = F.when(F.size(words) > 0, F.transform(F.sequence(F.lit(0), last), shingle))
    hashes = F.sort_array(F.coalesce(hashes, none))
    rows = rows.withColumn("_sorted", evaluated_once(hashes)).drop("_words")
    ordered = F.col("_sorted")
    leads = F.filter(
        ordered,
        lambda h, i: (i == 0) | (bin_of(h.bitwiseXOR(F.get(ordered, i - 1))) != 0),
    )
    rows = rows.withColumn("_least", evaluated_once(leads)).drop("_sorted")
    least = F.col("_least")
    own = F.map_from_arrays(F.transform(least, bin_of), least)
    rows = rows.withColumn("_map", evaluated_once(own))
    bins = F.sequence(F.lit(0), F.lit(BINS - 1))
    found = F.transform(bins, lambda i: F.try_element_at(F.col("_map"), i))
    rows = rows.withColumn("_bins", evaluated_once(found)).drop("_map")

    def value(i: Column) -> Column:
        own = F.col("_bins")
        mask = F.lit(BINS - 1).cast("bigint")
        ask = lambda j: F.xxhash64(i, F.lit(j)).bitwiseAND(mask).cast("int")
        asked = [F.get(own, ask(j)) for j in range(PROBES)]
        # If all these are empty, the bin of least rank among those that are not.
        ranked = F.transform(
            least, lambda h: F.struct(F.xxhash64(i, bin_of(h)).alias("rank"), h.alias("value"))
        )
        return F.coalesce(F.get(own, i), *asked, F.array_min(ranked)["value"])

    # Mixed with the bin's number, so that bits of one borrowed hash differ between bins.
    low = F.lit((1 << STORED_BITS) - 1).cast("bigint")
    stored = lambda i: F.xxhash64(value(i), i).bitwiseAND(low).cast("tinyint")
    bits = F.when(F.size(least) > 0, F.transform(bins, stored))
    bits = F.coalesce(bits, F.array().cast("array<tinyint>"))
    return rows.withColumn(name, evaluated_once(bits)).drop("_least", "_bins")


def packed(bits: Column) -> Column:
    """Four stored bits to a hexadecimal digit."""
    return F.lower(F.array_join(F.transform(bits, lambda b: F.hex(b.cast("bigint"))), ""))


def likeness(one: Column, other: Column) -> Column:
    """Estimated share of common shingles, 0 to 1.

    Two texts without words are alike, a text with words is not like one without.
    """
    equal = F.aggregate(
        F.zip_with(one, other, lambda a, b: (a == b).cast("int")),
        F.lit(0), lambda total, same: total + F.coalesce(same, F.lit(0)),
    )
    chance = 1 / (1 << STORED_BITS)
    corrected = F.greatest((equal / F.lit(BINS) - chance) / (1 - chance), F.lit(0.0))
    empty = F.when((F.size(one) == 0) & (F.size(other) == 0), 1.0)
    return empty.when((F.size(one) == 0) | (F.size(other) == 0), 0.0).otherwise(corrected)


def fingerprint(documents: DataFrame) -> DataFrame:
    """``documents`` with ``fingerprint`` of the whole text; null text counts as empty.

    Equal texts have equal fingerprints; a text without words has an empty one.
    """
    rows = documents.withColumn("_text", text_or_empty())
    rows = with_bits(rows, "_text", "_bits")
    return rows.withColumn("fingerprint", packed(F.col("_bits"))).drop("_text", "_bits")


def bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are at or below ``key``, found in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*[F.lit(g[0]).cast("bigint") for g in groups])
    inner = F.array(*[F.array(*[F.lit(b).cast("bigint") for b in g]) for g in groups])
    before = F.size(F.filter(heads, lambda b: b <= key))
    found = F.size(F.filter(F.get(inner, before - 1), lambda b: b <= key))
    return F.when(before == 0, 0).otherwise((before - 1) * step + found)


def with_next(
    spark: SparkSession, rows: DataFrame, columns: list[str], ids: DataFrame | None = None
) -> DataFrame:
    """``rows`` with ``next_<column>`` of the row after it by doc_id; after the last, the first.

    Rows are dealt into ranges of ids of even size, several for each partition. The first row
    of a range is also sent to the range before it, as a guest that only serves as the next
    row. Rows without an id come first; rows of equal id follow in the order of ``columns``.
    A single row is its own next. No rows give no rows. ``ids`` has the same ``doc_id`` where
    ``rows`` are costly to make: the ranges are cut from it.
    """
    least = -(1 << 63)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("_key")
    keyed = rows.select("*", key)
    count = 8 * shuffle_partitions(spark)
    shares = [i / count for i in range(1, count)]
    # A sketch of bounded size: the ids that part the table evenly.
    found = (rows if ids is None else ids).select(key).agg(
        F.percentile_approx("_key", shares, 10 * count).alias("bounds"),
        F.min("_key").alias("first"),
    ).first()
    bounds = sorted(set(found.bounds or []) - {found.first})
    inside = F.struct(bucket(F.col("_key"), bounds).alias("range"), F.lit(False).alias("guest"))
    guest = F.when(
        F.array_contains(F.array(*[F.lit(b).cast("bigint") for b in bounds]), F.col("_key")),
        F.struct((bucket(F.col("_key"), bounds) - 1).alias("range"), F.lit(True).alias("guest")),
    ) if bounds else F.lit(None)
    first = F.when(
        F.col("_key") == F.lit(found.first if found.first is not None else least),
        F.struct(F.lit(len(bounds)).alias("range"), F.lit(True).alias("guest")),
    )
    places = F.array_compact(F.array(inside, first, guest) if bounds else F.array(inside, first))
    dealt = keyed.withColumn("_place", F.explode(places)).select(
        *rows.columns, "_key",
        F.col("_place.range").alias("_range"), F.col("_place.guest").alias("_guest"),
    )
    order = Window.partitionBy("_range").orderBy("_guest", "_key", *columns)
    ahead = dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return ahead.filter(~F.col("_guest")).drop("_key", "_range", "_guest")


def edit_check(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Fingerprints of every document and of an edited form of it, and their likeness.

    In the edited form the last quarter of the code points is replaced by as many from the
    beginning of the next document, or all it has. Null text counts as empty.
    """
    rows = documents.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    rows = with_next(spark, with_bits(rows, "text", "bits"), ["text", "bits"], documents)
    n_chars = F.char_length("text")
    quarter = F.floor(n_chars / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n_chars - quarter),
        F.substring("next_text", F.lit(1), quarter),
    )
    rows = rows.select(
        "doc_id", n_chars.cast("long").alias("n_chars"), edited.alias("edited"), "bits", "next_bits"
    )
    rows = with_bits(rows, "edited", "edited_bits")
    return rows.select(
        "doc_id", "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        packed(F.col("bits")).alias("fingerprint"),
        packed(F.col("edited_bits")).alias("edited_fingerprint"),
        likeness(F.col("bits"), F.col("edited_bits")).alias("near_edited"),
        likeness(F.col("bits"), F.col("next_bits")).alias("near_next"),
    )
