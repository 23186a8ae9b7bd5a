"""Filter audit, Merkle manifest and embedding links against brute force on odd rows."""

import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import embedding_links, filter_audit, merkle

WORD = re.compile("[^\x20\x09-\x0d]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tricky(spark, odd_rows, tmp_path_factory):
    """Rows that repeat or lack a doc_id, a null and an empty source, one source with many rows."""
    text = " ".join(f"Word{i} &" for i in range(60))
    rows = odd_rows + [
        (None, text, "en", "src0", 5), (None, None, None, None, None), (3, text, "en", "", 5),
        (3, text, "en", "", 5), (3, "other words " * 40, "en", "src0", 5), (7, text, "de", "src2", 5),
        (-5, "ABC", "en", "src7", None), (11, "ABC", "en", "src7", None),
        (12, "\u00c4B \U0001f600 C" * 9, "en", "s\u00fc", 1), (13, "x " * 49 + "x", "en", "src8", 1),
    ]
    rows += [(1000 + i, f"Text {i // 3} with Few words", "en", "hot", i) for i in range(300)]
    path = str(tmp_path_factory.mktemp("tricky") / "documents.parquet")
    frame = spark.createDataFrame(rows, DOCUMENTS).withColumns(
        {c: F.lit(1) for c in ("id", "part", "digest", "filter", "rank", "tree", "path", "_n", "_row")}
    )
    frame.repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def marks(spark):
    rows = [(3, 1, 0), (3, 0, 1), (7, 1, 1), (None, 1, 1), (11, None, 1), (1004, 1, None)]
    rows += [(1000 + i, i % 2, i % 3 == 0) for i in range(0, 300, 5)]
    rows = [(a, b, None if c is None else int(c)) for a, b, c in rows]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def failing(doc_id, text, first):
    words = WORD.findall(text)
    capitals = len(re.findall("[A-Z]", text))
    return {
        name for name, fails in (
            ("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)),
            ("C", 100 * capitals > 5 * len(text)), ("D", re.search("[#$%&*|]", text)),
            ("E", doc_id is not None and first is not None and doc_id > first),
        ) if fails
    }


def test_audit_equals_brute_force(spark, tricky, marks):
    rows = [(r.doc_id, r.text or "", r.source or "") for r in tricky.collect()]
    labels = [tuple(r) for r in marks.collect()]
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    bad = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text] = min(doc_id, least.get(text, doc_id))
    known = [(d, part, failing(d, text, least.get(text))) for d, text, part in rows]
    expected = {}
    for part in {p for _, p, _ in known}:
        own = [(d, f) for d, p, f in known if p == part]
        for order in itertools.permutations("ABCDE"):
            for step, name in enumerate(order):
                before = set(order[:step])
                here = [d for d, f in own if name in f and not f & before]
                expected[part, "".join(order), step + 1] = [
                    sum(not f & (before | {name}) for _, f in own), len(here),
                    sum(name in f and bool(f & before) for _, f in own),
                    sum(f == {name} for _, f in own),
                    sum(d in good for d in here), sum(d in bad for d in here),
                ]
    shapley = {}
    for (part, order, step), values in expected.items():
        key = part, order[step - 1]
        shapley[key] = shapley.get(key, 0) + values[1]
    got = filter_audit.audit_documents(spark, tricky, marks).collect()
    assert {(r.part, r.filter_order, r.step) for r in got} == set(expected)
    assert len(got) == len(expected)
    for r in got:
        values = [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost]
        assert values == expected[r.part, r.filter_order, r.step], r
        assert r.shapley == shapley[r.part, r.filter_order[r.step - 1]]


def test_audit_of_other_filters_and_of_nothing(spark, tricky, marks):
    totals = spark.createDataFrame([("p", 10)], "part string, total long")
    rows = spark.createDataFrame(
        [(1, "p", True, False, ["x", "y"]), (2, "p", False, True, ["y"]), (3, "p", False, False, ["x"])],
        "id long, part string, good boolean, toxic boolean, fails array<string>",
    )
    failed = filter_audit.store_failing(spark, rows)
    got = filter_audit.audit(spark, totals, failed, ["x", "y"]).filter("filter_order = 'yx'")
    assert [tuple(r) for r in got.orderBy("step").collect()] == [
        ("p", "yx", 1, 8, 2, 0, 1, 1, 1, 3), ("p", "yx", 2, 7, 1, 1, 1, 0, 0, 3),
    ]
    clean = filter_audit.audit(spark, totals, failed.filter("id < 0"), ["x", "y"]).collect()
    assert len(clean) == 4 and {r.kept for r in clean} == {10}
    assert filter_audit.audit_documents(spark, tricky.limit(0), marks).count() == 0
    assert filter_audit.audit_documents(spark, tricky, marks.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


# ---- Merkle manifest ---------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i : i + 16]) for i in range(0, len(last), 16)])
    return levels


def siblings(levels, rank):
    for level in levels[:-1]:
        low = rank // 16 * 16
        yield "".join(level[low:rank]), "".join(level[rank + 1 : low + 16])
        rank //= 16


def manifest_of(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row.source, []).append(row)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        groups[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        trees[s] = tree_of([leaf_of(r, r.text) for r in groups[s]])
    top = tree_of([trees[s][-1][0] for s in sources])
    for place, s in enumerate(sources):
        for rank, row in enumerate(groups[s]):
            path = [*siblings(trees[s], rank), *siblings(top, place)]
            text = row.text
            if row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0 and text:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf_of(row, text)
            for left, right in path:
                node = digest(left, node, right)
            yield (
                row.doc_id, leaf_of(row, row.text), trees[s][-1][0], top[-1][0],
                digest(*[left + right for left, right in path]), node, node == top[-1][0],
            )


def test_manifest_equals_brute_force(spark, tricky):
    got = merkle.verify_documents(spark, tricky)
    assert got.columns == [
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    ]
    rows = tricky.select("doc_id", "source", "lang", "n_chars", "text").collect()
    expected = list(manifest_of(rows))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert 0 < sum(not r[-1] for r in expected) < len(expected) / 2


def test_manifest_of_one_and_of_no_document(spark, tricky):
    one = tricky.filter("doc_id = 7")
    rows = one.select("doc_id", "source", "lang", "n_chars", "text").collect()
    got = merkle.verify_documents(spark, one).collect()
    assert list(map(tuple, got)) == list(manifest_of(rows))
    assert got[0].leaf == got[0].root and got[0].proof_sha256 == digest()
    assert merkle.verify_documents(spark, tricky.limit(0)).count() == 0


def test_some_requests_reach_their_leaves_alone(spark):
    """Only the nodes above the requested leaves are opened; foreign ranks meet nothing."""
    leaves = spark.range(700).select(
        F.lit("t").alias("tree"), F.lit(3).alias("height"), F.col("id").alias("rank"),
        F.sha2(F.col("id").cast("string"), 256).alias("digest"),
    )
    graph = merkle.build(spark, leaves)
    levels = tree_of([digest(str(i)) for i in range(700)])
    starts = graph.roots.withColumn("path", F.array().cast(merkle.PATH))
    asked = leaves.filter("rank IN (0, 255, 699)").select("tree", "height", "rank")
    got = {r["rank"]: r for r in merkle.descend(spark, graph, starts, asked).collect()}
    assert sorted(got) == [0, 255, 699]
    for rank, row in got.items():
        assert row.root == levels[-1][0]
        assert [tuple(s) for s in reversed(row.path)] == list(siblings(levels, rank))


# ---- embedding links ---------------------------------------------------------------


def linked(rows, cosine=0.98):
    """(vec_id, links, component) by all pairs; rows without a usable vector stand alone."""
    def usable(v, label):
        if label is None or v is None or not len(v) or any(x is None for x in v):
            return None
        v = np.array(v, float)
        return v if np.isfinite(v).all() and v.any() else None

    vectors = [usable(v, label) for _, v, label in rows]
    parent, count = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = vectors[i], vectors[j]
        if a is None or b is None or rows[i][2] != rows[j][2] or len(a) != len(b):
            continue
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        if a @ b / math.sqrt((a @ a) * (b @ b)) >= cosine:
            count[i] += 1
            count[j] += 1
            parent[find(i)] = find(j)
    names = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            names[find(i)] = min(vec_id, names.get(find(i), vec_id))
    return sorted(((r[0], count[i], names.get(find(i))) for i, r in enumerate(rows)), key=repr)


def cluster(draw, size, dimension, spread):
    base = draw.standard_normal(dimension)
    base /= np.linalg.norm(base)
    return [(base + spread * draw.standard_normal(dimension)).tolist() for _ in range(size)]


EMBEDDINGS = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("block", [4096, 16])
def test_links_equal_all_pairs(spark, block):
    draw = np.random.default_rng(4)
    rows = []
    for dimension, size in ((64, 60), (7, 30), (200, 20)):
        for label in range(2):
            some = cluster(draw, size, dimension, 0.13 / math.sqrt(dimension))
            some += cluster(draw, size, dimension, 0.2 / math.sqrt(dimension))
            some += draw.standard_normal((60, dimension)).tolist()
            rows += [(v, label) for v in some + some[:5] + [some[0]] * 20]
    rows = [(1000 + i, v, label) for i, (v, label) in enumerate(rows)]
    vector = rows[0][1]
    rows += [
        (1, None, 0), (2, [], 0), (3, [0.0] * 64, 0), (4, [float("nan")] * 64, 0),
        (5, [None, *vector[1:]], 0), (6, vector, None), (7, [float("inf"), *vector[1:]], 0),
        (8, [x * 1e-300 for x in vector], 0), (9, [x * 1e300 for x in vector], 0),
        (None, vector, 0), (None, [1.0, 2.0], 5), (None, [2.0, 4.0], 5), (10, [-x for x in vector], 0),
        (11, [3.0], 6), (12, [-3.0], 6), (13, [0.5], 6), (1000, [1.0, -1.0], 8), (1000, [1.0, 1.0], 8),
    ]
    frame = spark.createDataFrame(rows, EMBEDDINGS).repartition(7)
    got = embedding_links.link_vectors(spark, frame, block=block).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == linked(rows)
    for r in got:
        if r.component_id is not None:
            assert r.kept == (r.vec_id == r.component_id)
    assert sum(r.kept for r in got if r.component_id is None) == 1


def test_estimates_are_unbiased_and_bounds_hold():
    draw = np.random.default_rng(8)
    x = embedding_links.unit_vectors(draw.standard_normal((400, 64)))
    y = embedding_links.unit_vectors(x + 0.02 * draw.standard_normal((400, 64)))
    cosines = np.einsum("ij,ij->i", x, y)
    codes, factor = embedding_links.encode(x)
    corner = embedding_links.corners(codes, 64) / factor[:, None]
    estimates = np.einsum("ij,ij->i", corner, y)
    assert abs((estimates - cosines).mean()) < 0.01
    for z in (None, 4.0):
        bound = np.sqrt(1 - cosines**2) * embedding_links.margins(factor, 64, 0.0, z)
        assert (np.abs(estimates - cosines) <= bound + 1e-6).all()
    # Most pairs of unrelated vectors need no exact product.
    least = 0.98 - embedding_links.margins(factor, 64, 0.98, None)
    assert (corner @ x[::-1].T >= least[:, None]).mean() < 0.01


def test_links_of_no_rows(spark):
    nothing = spark.createDataFrame([], EMBEDDINGS + ", row long, digest string")
    assert embedding_links.link_vectors(spark, nothing).count() == 0
