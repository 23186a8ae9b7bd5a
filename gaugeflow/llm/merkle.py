"""A manifest of the corpus as a content-addressed graph, and proofs by descending it.

Every document is a leaf. Sixteen neighbouring nodes become one whose digest is the hash of
theirs, first within a source, then over the sources. The graph is stored as records
(digest, children); nothing else is needed to prove that a leaf belongs to the root.

Requests for leaves start at the root and follow the base-16 digits of a leaf's rank: the
record of the current digest gives the children, the digit selects one, and the others are
collected as a segment of the path. Requests that share digits go down together, as one row
for each node, so no node is asked more than once however many leaves lie below it. Below the
last node each request meets its path, reverses it, and folds its leaf up to the root.

Ranks come from a sort by ranges with a running count of the ranges before, so a source with
a third of all rows is ranked by as many tasks as there are partitions.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import shuffle_partitions, stage

# Children of a node, as a power of two, and the fields of a leaf in their order.
DIGIT_BITS = 4
WIDTH = 1 << DIGIT_BITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_EACH = 5

PATH = "array<struct<left: string, right: string>>"


def leaf_digest(fields: dict[str, Column] | None = None) -> Column:
    """SHA-256 of a row's fields, each with its length; ``fields`` stand in for columns."""
    given = fields or {}
    parts = []
    for name in FIELDS:
        value = given.get(name, F.col(name)).cast("string")
        size = F.octet_length(value).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def ranked(spark: SparkSession, rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` in their ``tree`` by ``order`` (nulls first) and the tree's
    ``height``: how often its nodes are gathered before one is left."""
    by = ["tree", *order]
    sorted_rows = rows.repartitionByRange(shuffle_partitions(spark), *by).sortWithinPartitions(*by)
    # The number holds the partition in its upper bits and counts up within it.
    sorted_rows = stage(
        spark, sorted_rows.withColumn("_n", F.monotonically_increasing_id()), "sorted"
    )
    part = F.shiftright("_n", 33).alias("_part")
    parts = sorted_rows.groupBy("tree", part).agg(F.min("_n").alias("_low"), F.count("*").alias("_size"))
    tree = Window.partitionBy("tree")
    before = F.sum("_size").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    size = F.sum("_size").over(tree)
    height = sum(((size > WIDTH**k).cast("int") for k in range(1, 15)), (size > 1).cast("int"))
    begins = parts.select(
        "tree", "_part", (F.coalesce(before, F.lit(0)) - F.col("_low")).alias("_shift"),
        height.alias("height"),
    )
    begins = stage(spark, begins, "ranges")
    return (
        sorted_rows.withColumn("_part", part)
        .join(begins, ["tree", "_part"])
        .withColumn("rank", F.col("_n") + F.col("_shift"))
        .drop("_n", "_part", "_shift")
    )


@dataclass
class Graph:
    """``records[k]`` are the records (digest, children) of nodes k steps above leaves;
    ``roots`` the trees with their height and digest."""

    records: dict[int, DataFrame]
    roots: DataFrame


def top_height(nodes: DataFrame) -> int:
    return nodes.agg(F.max("height")).first()[0] or 0


def build(spark: SparkSession, nodes: DataFrame) -> Graph:
    """The graph over ``nodes`` (tree, height, rank, digest); a lone leaf is its own root."""
    records: dict[int, DataFrame] = {}
    single = ["tree", "height", "digest"]
    roots = nodes.filter("height = 0").select(*single)
    for level in range(1, top_height(nodes) + 1):
        run = nodes.filter(F.col("height") >= level).groupBy(
            "tree", "height", F.shiftright("rank", DIGIT_BITS).alias("rank")
        )
        digit = F.col("rank").bitwiseAND(WIDTH - 1)
        # At most sixteen to a group.
        gathered = run.agg(F.array_sort(F.collect_list(F.struct(digit.alias("digit"), "digest"))).alias("c"))
        children = F.col("c")["digest"].alias("children")
        nodes = stage(
            spark,
            gathered.select("tree", "height", "rank", children).withColumn(
                "digest", F.sha2(F.concat_ws("", "children"), 256)
            ),
            f"level_{level}",
        )
        records[level] = nodes.groupBy("digest").agg(F.first("children").alias("children"))
        roots = roots.unionByName(nodes.filter(F.col("height") == level).select(*single))
    return Graph(records, stage(spark, roots, "roots"))


def _path(path: Column | str, children: Column, digit: Column) -> Column:
    """``path`` and the children that the digit does not select."""
    left = F.concat_ws("", F.slice(children, F.lit(1), digit))
    right = F.concat_ws("", F.slice(children, digit + 2, F.lit(WIDTH)))
    return F.concat(path, F.array(F.struct(left.alias("left"), right.alias("right"))).cast(PATH))


def descend(spark: SparkSession, graph: Graph, starts: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests`` (tree, height, rank and more) with ``root`` and ``path`` of their leaf.

    ``starts`` (tree, height, digest, path) are the roots with the path that led to them. A
    segment of the path holds what stands left and right of the node that was selected, from
    the first root down.
    """
    starts = starts.withColumn("root", F.col("digest"))
    at = ["tree", "rank", "root", "digest", "path"]
    first = starts.withColumn("rank", F.lit(0).cast("long"))
    here = first.filter("height < 0").select(*at)
    height = top_height(starts)
    for level in range(height, 0, -1):
        here = here.unionByName(first.filter(F.col("height") == level).select(*at))
        opened = here.join(graph.records[level], "digest")
        if level == 1:
            break
        below = opened.select("tree", "rank", "root", "path", "children", F.posexplode("children").alias("digit", "digest"))
        below = below.select(
            "tree", (F.col("rank") * WIDTH + F.col("digit")).alias("rank"), "root", "digest",
            _path("path", F.col("children"), F.col("digit")).alias("path"),
        )
        asked = requests.filter(F.col("height") >= level).select(
            "tree", F.shiftright("rank", DIGIT_BITS * (level - 1)).alias("rank")
        ).distinct()
        here = stage(spark, below.join(asked, ["tree", "rank"], "left_semi"), f"requests_{level}")
    lone = first.filter("height = 0").select(
        "tree", "rank", "root", "path", F.lit(None).cast("array<string>").alias("children")
    )
    last = lone
    if height:
        last = lone.unionByName(opened.select("tree", "rank", "root", "path", "children"))
    last = last.withColumnRenamed("rank", "_node")
    node = F.shiftright("rank", DIGIT_BITS)
    met = requests.withColumn("_node", node).join(last, ["tree", "_node"])
    digit = F.col("rank").bitwiseAND(WIDTH - 1).cast("int")
    whole = F.when(F.col("children").isNull(), F.col("path")).otherwise(
        _path("path", F.col("children"), digit)
    )
    return met.withColumn("path", whole).drop("_node", "children")


def proof_digest(path: Column) -> Column:
    """Hash of all siblings from the leaf to the root."""
    siblings = F.transform(F.reverse(path), lambda s: F.concat(s["left"], s["right"]))
    return F.sha2(F.concat_ws("", siblings), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    step = lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256)
    return F.aggregate(F.reverse(path), leaf, step)


def manifest(spark: SparkSession, leaves: DataFrame) -> DataFrame:
    """``leaves`` (tree, leaf, and columns ``doc_id`` and ``number`` to order them by) with
    ``subroot``, ``root`` and the ``path`` from the root to each."""
    leaves = stage(spark, ranked(spark, leaves, ["doc_id", "leaf", "number"]), "ranked")
    nodes = leaves.select("tree", "height", "rank", F.col("leaf").alias("digest"))
    inner = build(spark, nodes)
    tops = inner.roots.select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("height").alias("below"), "digest"
    )
    tops = stage(spark, ranked(spark, tops, ["name"]), "sources")
    outer = build(spark, tops.select("tree", "height", "rank", "digest"))
    no_path = F.array().cast(PATH)
    sources = descend(spark, outer, outer.roots.withColumn("path", no_path), tops)
    starts = stage(
        spark,
        sources.select(F.col("name").alias("tree"), F.col("below").alias("height"), "digest", "path"),
        "starts",
    )
    proved = descend(spark, inner, starts, leaves).withColumnRenamed("root", "subroot")
    root = outer.roots.first()
    return proved.withColumn("root", F.lit(root.digest if root else None).cast("string"))


def verify_documents(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Proof of every row, folded again after some texts were tampered with.

    Where 5 divides the CRC-32 of a doc_id, the leaf that is folded is that of the text with
    A-Z in lower case; a row without doc_id is left as it is. Leaves of a source ascend by
    doc_id, null first, then by digest. Rows that repeat count each for itself. A null source
    is a tree of its own, before all others. An empty table has no rows and no root. Only the
    five fields are read, so other columns may have any name.
    """
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    tampered = F.when(code % TAMPERED_EACH == 0, leaf_digest({"text": lower_ascii(F.col("text"))}))
    # A mark before the name tells the empty source from the null one and keeps the order.
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    leaves = stage(
        spark,
        documents.select(
            tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
            leaf_digest().alias("leaf"), tampered.alias("tampered"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "leaves",
    )
    proved = manifest(spark, leaves)
    given = F.coalesce("tampered", "leaf")
    return proved.select(
        "doc_id", "leaf", "subroot", "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded(given, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle(levels: int = 5, top_levels: int = 3) -> str:
    """The contract of the query as DuckDB SQL, with as many levels written out.

    Level by level the run of each node is listed; a tree with one node left stays as it is.
    Enough for 16 to the power of ``levels`` documents in a source.
    """
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    fields = [field(c) for c in FIELDS]
    low = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    tree = "coalesce('=' || source, '')"
    parts = [f"""
        b AS (
            SELECT doc_id, {tree} AS tree, sha256({' || '.join(fields)}) AS leaf,
                   sha256({' || '.join([*fields[:4], field(low)])}) AS lowered
            FROM documents
        ), p0 AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r
            FROM b
        ), n0 AS (SELECT tree, r, leaf AS d FROM p0)"""]

    def climb(prefix: str, count: int) -> None:
        for k in range(count):
            parts.append(f"""
        {prefix}r{k} AS (
            SELECT tree, r // 16 AS g, string_agg(d, '' ORDER BY r) AS run, min(d) AS lone,
                   sum(count(*)) OVER (PARTITION BY tree) AS left_over
            FROM {prefix}{k} GROUP BY tree, r // 16
        ), {prefix}{k + 1} AS (
            SELECT tree, g AS r, CASE WHEN left_over = 1 THEN lone ELSE sha256(run) END AS d
            FROM {prefix}r{k}
        )""")

    def walk(source: str, prefix: str, count: int, tree_of: str, rank: str, given: str) -> str:
        """Left and right siblings at each level, folded; returns the last relation."""
        last = source
        for k in range(count):
            own = f"({rank} // {16**k})"
            # Within the run, digests are 64 characters each.
            at = f"(64 * ({own} % 16))"
            # The run of a level's nodes, none where one node is left.
            run = f"CASE WHEN x.left_over = 1 THEN '' ELSE x.run END"
            left, right = f"substr({run}, 1, {at})", f"substr({run}, {at} + 65)"
            name = f"{prefix}w{k}"
            parts.append(f"""
        {name} AS (
            SELECT l.* EXCLUDE (sib, {given}), l.sib || {left} || {right} AS sib,
                   CASE WHEN x.left_over = 1 THEN l.{given}
                        ELSE sha256({left} || l.{given} || {right}) END AS {given}
            FROM {last} l JOIN {prefix}r{k} x ON x.tree = l.{tree_of} AND x.g = l.{rank} // {16 ** (k + 1)}
        )""")
            last = name
        return last

    climb("n", levels)
    parts.append(f"""
        m0 AS (
            SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS r, d, tree AS name
            FROM n{levels}
        )""")
    climb("m", top_levels)
    parts.append(f"""
        q AS (
            SELECT p0.doc_id, p0.leaf, p0.tree, p0.r, '' AS sib, m0.r AS s, m0.d AS subroot, '' AS top,
                   CASE WHEN crc32_of.c % 5 = 0 THEN p0.lowered ELSE p0.leaf END AS f
            FROM p0 JOIN m0 ON m0.name = p0.tree JOIN crc32_of ON crc32_of.doc_id = p0.doc_id
        )""")
    inner = walk("q", "n", levels, "tree", "r", "f")
    outer = walk(inner, "m", top_levels, "top", "s", "f")
    return f"""
        WITH {', '.join([_crc32_sql(), *parts])}
        SELECT doc_id, leaf, subroot, (SELECT d FROM m{top_levels}) AS root,
               sha256(sib) AS proof_sha256, f AS folded_root,
               f = (SELECT d FROM m{top_levels}) AS verified
        FROM {outer}
    """


def _crc32_sql() -> str:
    """crc32_of (doc_id, c): CRC-32 of the decimal doc_id, a byte at a time.

    The polynomial division of a byte is eight shifts; DuckDB has no CRC function.
    """
    def shifted(c: str) -> str:
        return f"CASE WHEN {c} & 1 = 1 THEN xor({c} >> 1, 3988292384) ELSE {c} >> 1 END"

    step = "list_reduce(list_prepend(xor(c, ascii(s[i])), [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: " + shifted("c") + ")"
    chain, last = [], "(SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s, CAST(4294967295 AS BIGINT) AS c FROM documents)"
    for i in range(1, 20):
        chain.append(f"crc_{i} AS (SELECT doc_id, s, CASE WHEN length(s) < {i} THEN c ELSE {step.replace('s[i]', f's[{i}]')} END AS c FROM {last})")
        last = f"crc_{i}"
    chain.append(f"crc32_of AS (SELECT doc_id, xor(c, 4294967295) AS c FROM {last})")
    return ", ".join(chain)
