"""Mixing sources to target weights through a tree of domain, language and source.

A budget of tokens is shared out from the root by the weights of the children. A child that
has less than its share gives what it cannot use to its siblings, by their weights; only when
all children of a node are used up does the node's own shortage go to the node's siblings.
A leaf then takes tokens from its documents in a seeded order, epoch after epoch, up to its
share: a prefix of the epochs, in which the last document may count in part.

Sums of a leaf are made per part of the order (by the leading digits of the order's key), so
a leaf that holds a third of all rows is spread over thousands of groups.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import WORD_PATTERN, stage, text_or_empty

LEVELS = ("domain", "lang", "source")
KEY_DIGITS = 3


@dataclass
class Mix:
    """Weights are positive whole numbers; a value that is not named weighs ``other``."""

    domains: dict[str, str] = field(default_factory=lambda: {
        **{f"src{i}": "web" for i in range(10)},
        **{f"src{i}": "reference" for i in range(10, 15)},
        **{f"src{i}": "books" for i in range(15, 20)},
    })
    weights: dict[str, dict[str, int]] = field(default_factory=lambda: {
        "domain": {"web": 5, "reference": 3, "books": 2},
        "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
        "source": {"src0": 2},
    })
    other: int = 1
    share: tuple[int, int] = (1, 1)
    epochs: int = 2
    seed: str = "mix-1"


def choose(value: Column, names: dict, other) -> Column:
    """CASE over a few names; anything else, null too, is ``other``."""
    out = F
    for name, result in names.items():
        out = out.when(value == name, F.lit(result))
    return out.otherwise(F.lit(other)) if names else F.lit(other)


def leaves_of(documents: DataFrame, mix: Mix, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, domain, lang, source, tokens, _text) and ``carried`` columns, for every row:
    words of the whole text count as tokens.

    Null texts have no tokens; null languages and sources are the value ''.
    """
    words = F.size(F.regexp_extract_all(text_or_empty(), F.lit(WORD_PATTERN), F.lit(0)))
    return documents.select(
        F.col("doc_id").cast("long"),
        choose(F.col("source"), mix.domains, "other").alias("domain"),
        text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source"),
        words.cast("long").alias("tokens"), F.md5(text_or_empty()).alias("_text"), *carried,
    )


def share_out(nodes: DataFrame, parents: list[str], child: str, weight: Column) -> DataFrame:
    """``nodes`` (parents, child, cap, budget of the parent) with the child's own ``budget``."""
    group = Window.partitionBy(*parents)
    order = group.orderBy(F.col("cap").cast("double") / F.col("weight"), child)
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    nodes = nodes.withColumn("weight", weight.cast("long")).withColumns({
        "_taken": F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "_open": F.sum("weight").over(after),
    })
    full = F.col("cap") * F.col("_open") <= F.col("weight") * (F.col("budget") - F.col("_taken"))
    nodes = nodes.withColumn("_full", full).withColumns({
        "_used": F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0)).over(group),
        "_share": F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(group),
    })
    part = F.expr("weight * (budget - _used) div _share")
    return nodes.withColumn("budget", F.when(F.col("_full"), F.col("cap")).otherwise(part)).drop(
        "weight", "_taken", "_open", "_full", "_used", "_share"
    )


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, leaf_tokens, budget): one row for each leaf of the tree."""
    sums = leaves.groupBy(*LEVELS).agg(F.sum("tokens").alias("leaf_tokens"))
    sums = sums.withColumn("cap", F.col("leaf_tokens") * mix.epochs)
    up, down = mix.share
    given, parents = None, []
    for level in LEVELS:
        keys = [*parents, level]
        caps = sums.groupBy(*keys).agg(
            F.sum("cap").alias("cap"), F.sum("leaf_tokens").alias("_tokens")
        )
        if parents:
            nodes = caps.join(given, parents)
        else:  # the few domains, whose tokens add up to the whole
            nodes = caps.withColumn("_all", F.sum("_tokens").over(Window.partitionBy()))
            nodes = nodes.withColumn("budget", F.expr(f"_all * {up} div {down}"))
        weight = choose(F.col(level), mix.weights.get(level, {}), mix.other)
        given = share_out(nodes, parents, level, weight).select(*keys, "budget")
        parents = keys
    return sums.drop("cap").join(given, list(LEVELS))


def select_prefix(
    spark: SparkSession, leaves: DataFrame, mix: Mix, carried: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, leaf, epoch, start, tokens, taken) and ``carried`` columns: what each leaf takes
    of its epochs.

    ``start`` counts the leaf's tokens before this copy of the document; ``taken`` is less
    than ``tokens`` only for the copy that reaches the budget. Documents without tokens come
    along where the order puts them inside the prefix. A leaf without tokens takes nothing.
    Rows without a doc_id come last in an epoch, by a key of their text; rows that share a
    doc_id follow each other by text.
    """
    plan = stage(spark, budgets(leaves, mix).filter("budget > 0"), "leaf_budgets")
    rows = leaves.join(plan, list(LEVELS))
    last = F.expr("(budget - 1) div leaf_tokens")
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    epoch = F.concat(F.lit(f"{mix.seed}|"), F.col("epoch").cast("string"), F.lit("|"))
    key = F.md5(F.concat(epoch, F.col("doc_id").cast("string")))
    # A letter after the digits puts the keys of texts behind those of ids.
    key = F.coalesce(key, F.concat(F.lit("g"), F.md5(F.concat(epoch, F.col("_text")))))
    rows = rows.withColumn("_key", key)
    digits = F.when(F.col("doc_id").isNull(), KEY_DIGITS + 1).otherwise(KEY_DIGITS)
    rows = rows.withColumn("_part", F.substring("_key", F.lit(1), digits))
    group = [*LEVELS, "epoch"]
    parts = rows.groupBy(*group, "_part").agg(F.sum("tokens").alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *group, "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy(*group, "_part").orderBy(
        "_key", "doc_id", "_text", *carried
    )
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("tokens").over(within), F.lit(0))
    placed = rows.withColumn("_own", own).join(parts, [*group, "_part"])
    start = F.col("epoch") * F.col("leaf_tokens") + F.col("_before") + F.col("_own")
    return placed.withColumn("start", start).filter("start < budget").select(
        "doc_id", *LEVELS, "epoch", "start", "tokens",
        F.least(F.col("tokens"), F.col("budget") - F.col("start")).alias("taken"), *carried,
    )


def mix_rows(
    spark: SparkSession, documents: DataFrame, mix: Mix | None = None, carried: tuple[str, ...] = ()
) -> DataFrame:
    """The mix of all rows, also of those that repeat a doc_id or have none."""
    mix = mix or Mix()
    leaves = stage(spark, leaves_of(documents, mix, carried), "leaves")
    return select_prefix(spark, leaves, mix, carried)


def mix_documents(spark: SparkSession, documents: DataFrame, mix: Mix | None = None) -> DataFrame:
    """As ``mix_rows``, but rows equal in doc_id, text, lang and source are one document."""
    return mix_rows(spark, documents.select("doc_id", "text", "lang", "source").distinct(), mix)


def oracle(mix: Mix | None = None) -> str:
    """The same mix as DuckDB SQL over the table ``documents``."""
    mix = mix or Mix()

    def case(value: str, names: dict, other) -> str:
        quote = lambda x: f"'{x}'" if isinstance(x, str) else str(x)
        whens = " ".join(f"WHEN {value} = '{k}' THEN {quote(v)}" for k, v in names.items())
        return f"CASE {whens} ELSE {quote(other)} END" if names else quote(other)

    steps, given, parents = [], "SELECT budget FROM total", []
    for level in LEVELS:
        keys = ", ".join([*parents, level])
        group = f"PARTITION BY {', '.join(parents)}" if parents else ""
        join = f"JOIN ({given}) g USING ({', '.join(parents)})" if parents else f"CROSS JOIN ({given}) g"
        weight = case(level, mix.weights.get(level, {}), mix.other)
        steps.append(f"""
            {level}_a AS (
                SELECT c.*, g.budget, {weight} AS weight
                FROM (SELECT {keys}, sum(cap)::BIGINT AS cap FROM sums GROUP BY {keys}) c {join}
            ), {level}_b AS (
                SELECT *, cap * sum(weight) OVER (
                    {group} ORDER BY cap::DOUBLE / weight, {level}
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING
                ) <= weight * (budget - coalesce(sum(cap) OVER (
                    {group} ORDER BY cap::DOUBLE / weight, {level}
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
                ), 0)) AS full_up FROM {level}_a
            ), {level}_c AS (
                SELECT *, sum(CASE WHEN full_up THEN cap ELSE 0 END) OVER ({group}) AS used,
                       sum(CASE WHEN full_up THEN 0 ELSE weight END) OVER ({group}) AS shares
                FROM {level}_b
            ), {level}_d AS (
                SELECT {keys}, (CASE WHEN full_up THEN cap
                    ELSE weight * (budget - used) // shares END)::BIGINT AS budget FROM {level}_c
            )""")
        given, parents = f"SELECT * FROM {level}_d", [*parents, level]
    up, down = mix.share
    return f"""
        WITH leaves AS (
            SELECT doc_id, {case("source", mix.domains, "other")} AS domain,
                   coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   len(regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}')) AS tokens
            FROM documents
        ), raw_sums AS (
            SELECT domain, lang, source, sum(tokens)::BIGINT AS leaf_tokens
            FROM leaves GROUP BY ALL
        ), sums AS (SELECT *, leaf_tokens * {mix.epochs} AS cap FROM raw_sums),
        total AS (SELECT (sum(leaf_tokens) * {up} // {down})::BIGINT AS budget FROM sums),
        {",".join(steps)},
        copies AS (
            SELECT l.*, s.leaf_tokens, b.budget,
                   unnest(range(0, (b.budget - 1) // s.leaf_tokens + 1)) AS epoch
            FROM leaves l JOIN sums s USING (domain, lang, source)
            JOIN source_d b USING (domain, lang, source) WHERE b.budget > 0
        ), placed AS (
            SELECT *, (epoch * leaf_tokens + coalesce(sum(tokens) OVER (
                PARTITION BY domain, lang, source, epoch
                ORDER BY md5('{mix.seed}|' || epoch || '|' || doc_id), doc_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
            ), 0))::BIGINT AS start FROM copies
        )
        SELECT doc_id, domain, lang, source, epoch, start, tokens,
               least(tokens, budget - start) AS taken
        FROM placed WHERE start < budget
    """
