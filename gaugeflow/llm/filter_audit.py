"""What each filter of a chain removes, in every order the chain could have.

One table of failing ids is stored for each filter. What a filter removes after others is its
table less theirs (left anti); what it would have removed but an earlier one did first is its
table's share of theirs (left semi). The result depends on the set of earlier filters, not on
their order, so the 16 sets that can precede a filter serve all 120 orders of five.

Ids that fail one filter only are set apart by a single anti join, since no other filter
changes what becomes of them. The rest, tagged with filter and set of earlier filters, goes
through one anti and one semi join for each filter. Ids are unique, so joins have no hot keys;
counts by part are summed before they are shuffled.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import WORD_PATTERN, scratch, shuffles_dropped, stage, text_or_empty

# The filters by contract, and their limits.
NAMES = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT_PERCENT = 65
MOST_CAPITALS_PERCENT = 5
SYMBOLS = r"[#$%&*|]"

COUNTS = ("removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def conditions(text: Column) -> dict[str, Column]:
    """Failure of the filters that look at one text."""
    words = F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))
    count, distinct = (F.size(w).cast("long") for w in (words, F.array_distinct(words)))
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    return {
        "A": count < LEAST_WORDS,
        "B": distinct * 100 < count * LEAST_DISTINCT_PERCENT,
        "C": capitals * 100 > F.char_length(text).cast("long") * MOST_CAPITALS_PERCENT,
        "D": F.rlike(text, F.lit(SYMBOLS)),
    }


def judged(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(id, doc_id, part, fails) of every row; ``id`` is a number of its own.

    Filter E fails a text that a row with a smaller doc_id has too, told by SHA-256.
    """
    text = text_or_empty()
    found = [F.when(failed, F.lit(name)) for name, failed in conditions(F.col("text")).items()]
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
    )
    rows = stage(
        spark,
        rows.select(
            F.monotonically_increasing_id().alias("id"), "doc_id", "part",
            F.unhex(F.sha2("text", 256)).alias("digest"),
            F.array_compact(F.array(*found)).alias("fails"),
        ),
        "judged",
    )
    firsts = rows.groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("copies")
    ).filter("copies > 1").select("digest", "first")
    # Staged, so that a text which many rows share can be split in the join.
    later = rows.join(stage(spark, firsts, "first_texts"), "digest", "left")
    copied = F.when(F.col("doc_id") > F.col("first"), F.array(F.lit("E")))
    fails = F.concat("fails", F.coalesce(copied, F.array().cast("array<string>")))
    return later.select("id", "doc_id", "part", fails.alias("fails"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``good`` and ``toxic``: whether any label row of the doc_id says so."""
    flags = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long")).agg(
        *[
            F.max(F.coalesce(F.col(name) == 1, F.lit(False))).alias(flag)
            for name, flag in (("quality", "good"), ("toxic", "toxic"))
        ]
    )
    named = rows.filter("doc_id IS NOT NULL").join(flags, "doc_id", "left")
    nameless = rows.filter("doc_id IS NULL").withColumns(
        {flag: F.lit(None).cast("boolean") for flag in ("good", "toxic")}
    )
    given = {flag: F.coalesce(flag, F.lit(False)) for flag in ("good", "toxic")}
    return named.unionByName(nameless).withColumns(given)


def store_failing(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(id, part, good, toxic, filter): a folder of failing ids for each filter.

    Reading one filter reads its folder alone.
    """
    path = scratch(spark, "failing")
    failing = rows.select("id", "part", "good", "toxic", F.explode("fails").alias("filter"))
    with shuffles_dropped(spark):
        failing.write.partitionBy("filter").parquet(path)
    return spark.read.schema(failing.schema).parquet(path)


def _counted(rows: DataFrame, *names: str, count: str = "removed") -> DataFrame:
    return rows.groupBy("part", "filter", *names).agg(F.count("*").alias(count))


def _lost(rows: DataFrame, *names: str) -> DataFrame:
    return rows.groupBy("part", "filter", *names).agg(
        F.count("*").alias("removed"),
        F.count_if("good").alias("good_lost"),
        F.count_if("toxic").alias("toxic_lost"),
    )


def prefix_counts(
    spark: SparkSession, failing: DataFrame, names: Sequence[str] = NAMES
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts by part and filter of ids that fail it alone; of shared ids that it removes after
    each set of earlier filters (``before``, a bit for each); and of shared ids that are
    redundant after that set.
    """
    others = failing.select(F.col("id").alias("_id"), F.col("filter").alias("_filter"))
    elsewhere = (F.col("id") == F.col("_id")) & (F.col("filter") != F.col("_filter"))
    alone = _lost(failing.join(others, elsewhere, "left_anti"))
    shared = failing.join(others, elsewhere, "left_semi")
    # Ids still there when their filter's turn comes, after every set of filters so far.
    left = stage(spark, shared.withColumn("before", F.lit(0)), "left")
    taken = []
    for bit, name in enumerate(names):
        table = failing.filter(F.col("filter") == name).select("id")
        rest = left.filter(F.col("filter") != name)
        gone = rest.join(table, "id", "left_semi")
        taken.append(_counted(gone, "before", count="redundant").withColumn("bit", F.lit(bit)))
        still = rest.join(table, "id", "left_anti").withColumn("before", F.col("before") + (1 << bit))
        left = stage(spark, left.unionByName(still), "left")
    removed = _lost(left, "before")
    # An id that the filter of a bit took first is redundant after all sets that agree up to it.
    first = functools.reduce(DataFrame.unionByName, taken)
    sets = F.explode(F.sequence(F.lit(0), F.lit((1 << len(names)) - 1)))
    first = first.withColumnRenamed("before", "_lower").withColumn("before", sets)
    one = F.expr("shiftleft(1, bit)")
    agree = F.col("before").bitwiseAND(one * 2 - 1) == F.col("_lower") + one
    redundant = first.filter(agree).groupBy("part", "filter", "before").agg(
        F.sum("redundant").alias("redundant")
    )
    return alone, removed, redundant


def audit(
    spark: SparkSession, totals: DataFrame, failing: DataFrame, names: Sequence[str] = NAMES
) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    ``totals`` has the rows of each ``part`` (``total``), ``failing`` what ``store_failing``
    returns. ``shapley`` is what a filter removes, summed over all orders.
    """
    alone, removed, redundant = prefix_counts(spark, failing, names)
    count = len(names)
    numbered = F.explode(F.array(*[
        F.struct(F.lit(name).alias("filter"), F.lit(bit).alias("bit"))
        for bit, name in enumerate(names)
    ])).alias("f")
    cells = (
        totals.select("part", "total", numbered)
        .select("part", "total", "f.*", F.explode(F.sequence(F.lit(0), F.lit((1 << count) - 1))).alias("before"))
        .filter("(shiftright(before, bit) & 1) = 0")
    )
    key = ["part", "filter"]
    sums = alone.select(
        *key, F.col("removed").alias("unique_fails"),
        F.col("good_lost").alias("_good"), F.col("toxic_lost").alias("_toxic"),
    )
    cells = cells.join(sums, key, "left").join(removed, [*key, "before"], "left")
    cells = cells.join(redundant, [*key, "before"], "left").fillna(0)
    cells = cells.withColumns({
        "removed": F.col("removed") + F.col("unique_fails"),
        "good_lost": F.col("good_lost") + F.col("_good"),
        "toxic_lost": F.col("toxic_lost") + F.col("_toxic"),
    })
    orders = [math.factorial(k) * math.factorial(count - 1 - k) for k in range(count)]
    weight = F.array(*map(F.lit, orders))[F.bit_count("before")]
    shapley = F.sum(F.col("removed") * weight).over(Window.partitionBy(*key))
    cells = cells.withColumn("shapley", shapley)
    places = {name: bit for bit, name in enumerate(names)}
    steps = [
        ("".join(order), step + 1, name, sum(1 << places[n] for n in order[:step]))
        for order in itertools.permutations(names)
        for step, name in enumerate(order)
    ]
    chain = spark.createDataFrame(steps, "filter_order string, step int, filter string, before int")
    # As many rows as the orders have steps, whatever the data.
    rows = cells.join(F.broadcast(chain), ["filter", "before"])
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")
    kept = F.col("total") - F.sum("removed").over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    return rows.select("part", "filter_order", "step", kept.alias("kept"), *COUNTS, "shapley")


def audit_documents(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over ``documents``, by ``source``.

    A null text is empty, a null source the part ``''``. Every row counts for itself: rows that
    repeat a doc_id fail E only for a smaller doc_id's text, and a row without doc_id never
    fails E and has no labels. An empty table has no parts, so no rows. Only doc_id, text and
    source are read, so other columns may have any name.
    """
    rows = stage(spark, judged(spark, documents), "audited")
    totals = rows.groupBy("part").agg(F.count("*").alias("total"))
    failing = store_failing(spark, labelled(rows.filter(F.size("fails") > 0), labels))
    return audit(spark, totals, failing)


def oracle() -> str:
    """The contract of the query as DuckDB SQL, by one bit mask per document."""
    places = {name: bit for bit, name in enumerate(NAMES)}
    steps = ", ".join(
        f"('{''.join(order)}', {step + 1}, {places[name]}, {sum(1 << places[n] for n in order[:step])})"
        for order in itertools.permutations(NAMES)
        for step, name in enumerate(order)
    )
    return f"""
        WITH t AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
        ), w AS (
            SELECT doc_id, part, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
                   length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS capitals,
                   min(doc_id) OVER (PARTITION BY text) AS first_id
            FROM t
        ), m AS (
            SELECT doc_id, part,
                   CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * capitals > 5 * length(text) THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
                   + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS mask
            FROM w
        ), g AS (
            SELECT part, mask, count(*) AS n,
                   sum(CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 1 ELSE 0 END) AS good,
                   sum(CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 1 ELSE 0 END) AS bad
            FROM m GROUP BY part, mask
        ), s(filter_order, step, bit, before) AS (VALUES {steps}
        ), c AS (
            SELECT g.part, s.filter_order, s.step, s.bit,
                   sum(CASE WHEN (g.mask & (s.before + (1 << s.bit))) = 0 THEN g.n ELSE 0 END) AS kept,
                   sum(CASE WHEN (g.mask & s.before) = 0 AND (g.mask & (1 << s.bit)) > 0 THEN g.n ELSE 0 END) AS removed,
                   sum(CASE WHEN (g.mask & s.before) > 0 AND (g.mask & (1 << s.bit)) > 0 THEN g.n ELSE 0 END) AS redundant,
                   sum(CASE WHEN g.mask = (1 << s.bit) THEN g.n ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN (g.mask & s.before) = 0 AND (g.mask & (1 << s.bit)) > 0 THEN g.good ELSE 0 END) AS good_lost,
                   sum(CASE WHEN (g.mask & s.before) = 0 AND (g.mask & (1 << s.bit)) > 0 THEN g.bad ELSE 0 END) AS toxic_lost
            FROM g CROSS JOIN s GROUP BY g.part, s.filter_order, s.step, s.bit
        )
        SELECT part, filter_order, cast(step AS INTEGER) AS step,
               cast(kept AS BIGINT) AS kept, cast(removed AS BIGINT) AS removed,
               cast(redundant AS BIGINT) AS redundant, cast(unique_fails AS BIGINT) AS unique_fails,
               cast(good_lost AS BIGINT) AS good_lost, cast(toxic_lost AS BIGINT) AS toxic_lost,
               cast(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
        FROM c
    """
