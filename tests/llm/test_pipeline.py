"""Each stage of the pipeline on its own input, over rows with odd values."""

import collections
import itertools
import math
import re

import corpus_pipeline
import duckdb
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gaugeflow.llm import mixing, quality_classifier, queries

WORD = re.compile("[^\x20\x09-\x0d]+")

DATA = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_what_they_should(spark, documents, tmp_path):
    docs = documents
    columns = docs.columns
    kept = {}
    for name, apply in corpus_pipeline.STAGES:
        rows = apply(spark, docs, DATA)
        rows.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
            assert docs.filter("_row != -7 OR _file != -7 OR _segment != -7 OR doc != -7").count() == 0
        kept[name] = [r.doc_id for r in docs.select("doc_id").collect()]
    assert len(kept["near_duplicates"]) == len(set(kept["near_duplicates"]))
    assert not {10_004, 10_007} & set(kept["near_duplicates"])
    assert set(kept["suffix_array"]) <= set(kept["near_duplicates"]) <= set(kept["quality_classifier"])
    assert set(kept["packing"]) == set(kept["mixing"]) <= set(kept["suffix_array"])


def test_stages_on_no_rows(spark, nothing, tmp_path):
    docs = nothing
    for name, apply in corpus_pipeline.STAGES:
        apply(spark, docs, DATA).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0


def test_run_equals_the_stages(spark):
    packed = corpus_pipeline.run(spark, DATA)
    sizes = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max("offset").alias("o"))
    assert sizes.filter("n > 2048 OR o >= n").count() == 0 and packed.count() > 0


def test_duplicates_and_mix_go_by_row(spark, tmp_path):
    """Rows that repeat a doc_id with another text, and rows without one, all come through."""
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(12)]
    rows = [(i // 2, texts[i]) for i in range(6)] + [(None, text) for text in texts[6:]]
    copies = [(0, texts[0]), (50, texts[1]), (None, texts[2]), (None, texts[7]), (None, texts[7] + " z")]
    frame = spark.createDataFrame(
        [(i, t, "en", "src0", len(t)) for i, t in rows + copies],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    key = lambda r: (r.doc_id is None, r.doc_id, r.text)
    for given in (frame.repartition(4), frame.repartition(1)):
        kept = corpus_pipeline.drop_near_duplicates(spark, given, DATA)
        texts_kept = sorted((r.doc_id is None, r.doc_id or 0, r.text[:200]) for r in kept.collect())
        assert len(texts_kept) == len(rows)
        assert [r for r in texts_kept if not r[0]] == sorted((False, i, t[:200]) for i, t in rows[:6])
    whole = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], frame.schema)
    whole.repartition(3).write.parquet(str(tmp_path / "rows"))
    docs = spark.read.parquet(str(tmp_path / "rows"))
    mixed = corpus_pipeline.mix_sources(spark, docs, DATA)
    assert sorted(map(key, mixed.collect()), key=repr) == sorted(map(key, docs.collect()), key=repr)


def shingle_weights(texts):
    """Weighted shingles of five words: count times the mean inverse document frequency."""
    words = [WORD.findall(t) for t in texts]
    count = collections.Counter(w for ws in words for w in set(ws))
    idf = {w: 1 + math.log(len(texts) / n) for w, n in count.items()}
    for ws in words:
        size = min(5, len(ws))
        grams = [tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)] if ws else []
        yield {g: n * sum(map(idf.get, g)) / len(g) for g, n in collections.Counter(grams).items()}


def components(texts):
    """Classes of weighted Jaccard similarity 0.8 or more, by all pairs."""
    grams, own = list(shingle_weights(texts)), list(range(len(texts)))

    def find(i):
        while own[i] != i:
            i = own[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        a, b = grams[i], grams[j]
        common = sum(min(v, b[k]) for k, v in a.items() if k in b)
        every = sum(a.values()) + sum(b.values()) - common
        if texts[i] == texts[j] or (a and b and common >= 0.8 * every - 1e-9):
            own[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


def without_repeats(texts):
    """Bytes not in a 50-byte string that also starts in an earlier text, whole characters."""
    seen = {}
    for number, text in enumerate(texts):
        for i in range(len(text) - 49):
            seen.setdefault(text[i : i + 50], number)
    for number, text in enumerate(texts):
        gone = bytearray(len(text))
        for i in range(len(text) - 49):
            if seen[text[i : i + 50]] < number:
                gone[i : i + 50] = b"\1" * 50
        yield bytes(b for b, g in zip(text, gone) if not g).decode("utf-8", "ignore")


def test_stages_equal_brute_force(spark, documents, labels, tmp_path):
    """Each stage on what the one before has kept, and run() on the table as it is."""
    base = documents.select("doc_id", "text", "lang", "source", "n_chars").limit(150)
    base.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    where = str(tmp_path)
    docs = spark.read.parquet(f"{where}/documents.parquet")
    kept = {}
    for name, apply in corpus_pipeline.STAGES:
        rows = apply(spark, docs, where)
        kept[name] = docs.collect(), rows.collect()
        docs = spark.createDataFrame(kept[name][1], rows.schema)
        if name != "packing":
            docs.write.parquet(f"{where}/{name}")
            docs = spark.read.parquet(f"{where}/{name}")
    key = lambda r: (r.doc_id, r.text or "", r.source)

    given, got = kept["quality_classifier"]
    model = quality_classifier.train(base, labels.filter(~queries.held_out()))
    verdicts = quality_classifier.score(base, model, ["doc_id"]).collect()
    good = {r.doc_id for r in verdicts if r.predicted == 1}
    assert sorted(map(key, got)) == sorted(key(r) for r in given if r.doc_id in good)

    given, got = kept["near_duplicates"]
    named = components([r.text or "" for r in given])
    first = {}
    for r, name in zip(given, named):
        first[name] = min(first.get(name, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in got) == sorted(first.values())

    given, got = kept["suffix_array"]
    given = sorted(given, key=lambda r: r.doc_id)
    texts = [(r.text or "").encode() for r in given]
    expected = [
        (r.doc_id, left) for r, text, left in zip(given, texts, without_repeats(texts))
        if left or not text
    ]
    assert sorted((r.doc_id, r.text or "") for r in got) == expected

    given, got = kept["mixing"]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [list(r) for r in given])
    ids = con.execute(f"SELECT doc_id FROM ({mixing.oracle()})").fetchall()
    assert sorted(r.doc_id for r in got) == sorted(i for i, in ids)

    given, got = kept["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = collections.Counter()
    for r in given:
        sizes[r.doc_id] += len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1
    placed = collections.Counter()
    for r in got:
        placed[r.doc_id] += r.length
    assert placed == sizes
    run = corpus_pipeline.run(spark, where).collect()
    shown = lambda rows: sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows)
    assert shown(run) == shown(got)
