"""Every operator against brute force, an exact round trip or held-out labels."""

import collections
import hashlib
import itertools
import math
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gaugeflow.llm import (
    byte_repeats,
    features,
    fingerprints,
    mixing,
    near_duplicates,
    packing,
    quality_classifier,
    quality_rules,
    queries,
    repeats,
    toxicity,
    warc,
    word_repeats,
)
from gaugeflow.llm.common import rolling, scratch, span_hashes, word_spans

WORD = re.compile("[^\x20\x09-\x0d]+")


def rows_of(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)


# ---- packing -----------------------------------------------------------------------


def test_pieces_equal_the_tokenizer_and_pack_without_gaps(spark, documents, texts):
    packed = packing.pack_documents(spark, documents, queries.vocabulary()).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for doc_id, text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        start = 0
        for piece, length in enumerate(packing.cut(len(ids), 2048)):
            own = np.array(ids[start : start + length], "<u4").tobytes()
            expected.append((doc_id, piece, start, length, zlib.crc32(own)))
            start += length
    assert sorted(tuple(r)[:5] for r in packed) == sorted(expected)
    sequences = collections.defaultdict(list)
    for row in packed:
        sequences[row.sequence_id].append((row.offset, row.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= math.ceil(sum(r.length for r in packed) / 2048) + 1


@pytest.mark.parametrize("seed", range(6))
def test_plans_place_every_piece_once(seed):
    draw = np.random.default_rng(seed)
    capacity = int(draw.integers(3, 120))
    lengths = draw.integers(1, capacity + 1, int(draw.integers(1, 400)))
    counts = collections.Counter(lengths.tolist())
    runs, used = packing.plan_sequences(counts, capacity)
    placed, fill = collections.Counter(), collections.defaultdict(list)
    for length, rank, number, per, sequence, offset in runs:
        assert rank == placed[length]
        placed[length] += number
        for j in range(number):
            fill[sequence + j // per].append((offset + j % per * length, length))
    assert placed == counts and len(fill) == used
    for places in fill.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
        assert sum(length > capacity // 3 for _, length in places) <= 3
    assert used <= 1.25 * sum(lengths) / capacity + 2


def test_only_the_first_piece_may_be_shorter():
    assert packing.cut(5000, 2048) == [904, 2048, 2048]
    assert packing.cut(2048, 2048) == [2048] and packing.cut(1, 2048) == [1]


# ---- WARC --------------------------------------------------------------------------


def test_archives_round_trip(spark):
    shared = "ü" * 60
    pages = [
        (5, "http://a/ b\r\nc", shared), (3, "http://b/%41", shared), (9, None, shared),
        (1, "http://c", "small"), (2, "http://d", "small"), (4, "http://e", None),
        (6, "http://f", ""), (None, "http://g", shared), (7, "http://h", "\r\n\r\n" * 200_000),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    manifest = warc.archive_pages(spark, frame, scratch(spark, "test"))
    read = warc.read_archives(warc.spread(spark, manifest)).collect()
    assert manifest.agg(F.sum("records")).first()[0] == len(read) == len(pages)
    got = {r.page_id: r for r in read}
    for page_id, url, html in pages:
        row, payload = got[page_id], (html or "").encode()
        assert row.verified and row.url == url
        assert row.payload_bytes == len(payload)
        assert row.payload_digest == hashlib.sha256(payload).hexdigest()
        revisit = html == shared and page_id != 3
        assert row.record_type == ("revisit" if revisit else "response")
        assert row.refers_to == (3 if revisit else None)
        assert row.payload == (None if revisit else payload)


def test_broken_archives_are_noticed(tmp_path):
    row = {
        "page_id": 1, "url": "u", "payload": b"x" * 500, "refers_to": None,
        "digest": hashlib.sha256(b"x" * 500).hexdigest(), "record_type": "response",
    }
    record = warc.record_bytes(row, "2024-01-01T00:00:00Z")

    def parsed(data):
        path = tmp_path / "a.warc.gz"
        path.write_bytes(data)
        with path.open("rb") as stream:
            return list(warc.parse_archive(stream, True))

    whole = zlib.compress(record, 6, 31)
    assert [r["verified"] for r in parsed(whole + whole)] == [True, True]
    assert not parsed(zlib.compress(record.replace(b"xxx", b"xyx"), 6, 31))[0]["verified"]
    with pytest.raises(EOFError):
        parsed(whole + whole[:-20])
    with pytest.raises(ValueError):
        parsed(zlib.compress(record[:-6], 6, 31))


def test_no_pages(spark):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    manifest = warc.archive_pages(spark, frame, scratch(spark, "test"))
    assert warc.read_archives(manifest).count() == 0


# ---- repeats -----------------------------------------------------------------------


def repeated(documents, split, joined):
    """By sets of all windows, document after document."""
    seen, out = set(), {}
    for _, group in itertools.groupby(documents, key=lambda d: d[0]):
        new = set()
        for doc_id, text in group:
            symbols = split(text)
            cut = bytearray(len(symbols))
            for i in range(len(symbols) - 49):
                window = tuple(symbols[i : i + 50])
                if window in seen:
                    cut[i : i + 50] = b"\1" * 50
                new.add(window)
            kept = joined([s for s, c in zip(symbols, cut) if not c])
            spans = len(re.findall(b"\1+", bytes(cut)))
            out.setdefault(doc_id, []).append(
                (doc_id, len(symbols), sum(cut), spans, hashlib.sha256(kept).hexdigest())
            )
        seen |= new
    return sorted(itertools.chain.from_iterable(out.values()))


@pytest.mark.parametrize("paths", [3, byte_repeats.GROUP_PATHS])
def test_byte_repeats_equal_brute_force(spark, documents, texts, paths, monkeypatch):
    monkeypatch.setattr(byte_repeats, "GROUP_PATHS", paths)
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = sorted(map(tuple, byte_repeats.remove_repeats(spark, documents).select(*names).collect()))
    assert got == repeated(texts, str.encode, bytes)


def test_word_repeats_equal_brute_force(spark, documents, texts):
    names = ("doc_id", "n_words", "n_removed", "kept_sha256")
    got = sorted(map(tuple, word_repeats.remove_repeats(spark, documents).select(*names).collect()))
    expected = repeated(texts, WORD.findall, lambda words: " ".join(words).encode())
    assert got == [(d, n, r, sha) for d, n, r, _, sha in expected]


def test_repeated_words_are_compared_at_their_source(spark):
    """A hash that takes all words for one, under the first seed, removes nothing wrong."""

    def blind(data, bounds, seed):
        values, first = word_repeats.words(data, bounds, seed)
        return (values * 0 if seed == 0 else values), first

    passage = [f"p{i}" for i in range(700)]
    rows = [
        (1, " ".join(f"a{i}" for i in range(90))), (2, " ".join(f"b{i}" for i in range(90))),
        (3, "x " + " ".join(passage)), (4, "\n" + " \t ".join(passage[100:600]) + "\x0b end"),
        (5, "\r\n".join(passage[:80] + ["gap"] + passage[300:420])), (6, " ".join(passage[90:150])),
        (6, " ".join(passage[90:149]) + " other"), (7, "ab " * 400), (8, "ab  " * 300 + "z"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    expected = repeated(rows, WORD.findall, lambda words: " ".join(words).encode())
    names = ("doc_id", "n_words", "n_removed", "kept_sha256")
    for symbols in (blind, word_repeats.words):
        found = word_repeats.remove_repeats(spark, frame, symbols).select(*names)
        assert sorted(map(tuple, found.collect())) == [(d, n, r, sha) for d, n, r, _, sha in expected]

    def always_blind(data, bounds, seed):
        values, first = word_repeats.words(data, bounds, seed)
        return values * 0, first

    with pytest.raises(RuntimeError, match="differ from their sources"):
        word_repeats.remove_repeats(spark, frame, always_blind)


def test_cleaned_keeps_columns_and_drops_emptied_documents(spark, documents):
    rows = byte_repeats.cleaned(spark, documents)
    assert rows.columns == documents.columns
    kept = {r.doc_id: r.text for r in rows.select("doc_id", "text").collect()}
    assert 10_007 not in kept and kept[10_000] is None and kept[10_001] == ""


def test_window_classes_are_those_of_a_sort():
    draw = np.random.default_rng(3)
    part = draw.integers(1, 4, 300)
    text = np.concatenate([part, [0], part[40:200], [0], draw.integers(1, 4, 200), [0]]).astype(np.uint8)
    order = byte_repeats.suffix_order(text)
    classes = byte_repeats.window_classes(text, order, 50)
    keys = [text[i : i + 50].tobytes() for i in order]
    for a, b, x, y in zip(keys, keys[1:], classes, classes[1:]):
        if len(a) == len(b) == 50:
            assert (a == b) == (x == y)


def test_repeats_of_nothing(spark, nothing):
    assert byte_repeats.remove_repeats(spark, nothing).count() == 0
    assert word_repeats.remove_repeats(spark, nothing).count() == 0


# ---- near duplicates ---------------------------------------------------------------


def brute_classes(texts, similarity=near_duplicates.SIMILARITY):
    words = {d: WORD.findall(t) for d, t in texts}
    df = collections.Counter()
    for _, text in texts:
        df.update(set(WORD.findall(text)))
    count, cap = len(texts), near_duplicates.LEAST_SHARE
    idf = lambda w: 1 + math.log(1 / max(df[w] / count, 1 / cap))

    def shingles(own):
        size = min(5, len(own))
        found = collections.Counter(tuple(own[i : i + size]) for i in range(len(own) - size + 1)) if size else {}
        return {s: n * sum(map(idf, s)) / len(s) for s, n in found.items()}

    sets = {d: shingles(w) for d, w in words.items()}
    parent = {d: d for d in words}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_text = dict(texts)
    for a, b in itertools.combinations(sorted(sets), 2):
        total = sum(sets[a].values()) + sum(sets[b].values())
        common = sum(min(w, sets[b][s]) for s, w in sets[a].items() if s in sets[b])
        if by_text[a] == by_text[b] or (common and common >= similarity * (total - common) - 1e-9):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return sorted((d, find(d)) for d, _ in texts)


def near_copies(spark, size=60):
    draw = np.random.default_rng(5)
    base = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(size):
        own = list(base)
        for place in draw.choice(300, int(draw.integers(0, 8)), replace=False):
            own[place] = f"new{i}x{place}"
        rows.append((i, " ".join(own)))
    rows += [(size + i, " ".join(f"other{i}y{j}" for j in range(80))) for i in range(20)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_classes_equal_brute_force(spark, documents, texts):
    got = near_duplicates.classes(spark, documents).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == brute_classes(texts)


@pytest.mark.parametrize("chunk", [1000, 7])
def test_large_buckets_lose_no_link(spark, chunk, monkeypatch):
    monkeypatch.setattr(near_duplicates, "CHUNK_TEXTS", chunk)
    rows, frame = near_copies(spark)
    got = near_duplicates.classes(spark, frame).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == brute_classes(rows)


def test_near_duplicates_of_nothing(spark, nothing):
    assert near_duplicates.classes(spark, nothing).count() == 0


# ---- fingerprints ------------------------------------------------------------------


def test_fingerprints_estimate_shingle_similarity(spark, documents, texts):
    got = collections.defaultdict(list)
    for row in fingerprints.edit_check(spark, documents).collect():
        got[row.doc_id].append(row)
    errors = []

    def shingles(text):
        words = WORD.findall(text)
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    def similarity(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    by_print = {}
    for i, (doc_id, text) in enumerate(texts):
        after = texts[(i + 1) % len(texts)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        row = next(
            r for r in got[doc_id]
            if r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        )
        assert row.n_chars == len(text)
        assert by_print.setdefault(text, row.fingerprint) == row.fingerprint
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        if text == edited:
            assert row.near_edited == 1
        errors.append(row.near_edited - similarity(shingles(text), shingles(edited)))
        errors.append(row.near_next - similarity(shingles(text), shingles(after)))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_fingerprints_use_no_python(spark, documents):
    plan = fingerprints.edit_check(spark, documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_fingerprints_of_nothing(spark, nothing):
    assert fingerprints.edit_check(spark, nothing).count() == 0


# ---- mixing ------------------------------------------------------------------------


@pytest.mark.parametrize("share", [(1, 1), (1, 3), (5, 2)])
def test_mix_equals_sql(spark, documents, share):
    mix = mixing.Mix(share=share)
    got = mixing.mix_documents(spark, documents, mix)
    table = documents.select("doc_id", "text", "lang", "source").distinct().toArrow()
    con = duckdb.connect()
    con.register("documents", table)
    query = mixing.oracle(mix)
    names = ("doc_id", "domain", "lang", "source", "epoch", "tokens", "taken")
    expected = con.sql(f"SELECT {', '.join(names)} FROM ({query})").fetchall()
    assert rows_of(got, *names) == sorted(expected, key=repr)


@pytest.fixture(scope="module")
def repeating(spark, documents, tmp_path_factory):
    """With rows that repeat a doc_id, in other leaves and in the same, and rows without one."""
    names = ("doc_id", "text", "lang", "source")
    rows = [
        (10_003, "another text under this id", "xx", "src98"), (10_005, "two others", "en", "src1"),
        (10_008, "third leaf " * 40, "de", "src2"), (10_005, "two words", "en", "src1"),
        *[(None, f"no id {i}", "en", "src1") for i in range(9)], (None, "no id 3", "en", "src1"),
        (None, None, "en", "src2"), (None, "leaf of its own", None, "src7"),
    ]
    path = str(tmp_path_factory.mktemp("repeating") / "documents.parquet")
    more = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    documents.select(*names).union(more).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("share", [(1, 1), (1, 3), (5, 2)])
def test_mix_of_the_table_as_it_is_equals_sql(spark, repeating, share):
    mix = mixing.Mix(share=share)
    con = duckdb.connect()
    con.register("documents", repeating.toArrow())
    names = ("doc_id", "domain", "lang", "source", "epoch", "start", "tokens", "taken")
    expected = con.sql(f"SELECT {', '.join(names)} FROM ({mixing.oracle(mix)})").fetchall()
    assert rows_of(mixing.mix_rows(spark, repeating, mix), *names) == sorted(expected, key=repr)


def test_registered_mix_equals_its_sql(spark, repeating, tmp_path):
    repeating.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.register("documents", repeating.toArrow())
    names = ("doc_id", "domain", "lang", "source", "epoch", "start", "tokens", "taken")
    sql = queries.oracle_sql()["op6_mixing"]
    expected = con.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall()
    got = queries.op6_mixing(spark, str(tmp_path))
    assert rows_of(got, *names) == sorted(expected, key=repr)


def test_siblings_take_a_shortage_before_ancestors(spark):
    rows = [(i, "w " * 10, lang, source) for i, (lang, source) in enumerate(
        [("en", "src0")] * 40 + [("de", "src1")] * 2 + [("en", "src12")] * 40 + [("en", "src17")] * 40
    )]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    mix = mixing.Mix(share=(1, 2), epochs=1)
    taken = {
        r.domain: r.n for r in mixing.mix_documents(spark, frame, mix)
        .groupBy("domain").agg(F.sum("taken").alias("n")).collect()
    }
    # German runs short, and English of the same domain makes up for it.
    assert taken == {"web": 305, "reference": 183, "books": 122}


def test_mix_of_nothing(spark, nothing):
    assert mixing.mix_documents(spark, nothing).count() == 0


# ---- quality and toxicity ----------------------------------------------------------


def test_base_counts_equal_brute_force(spark, documents, labels, texts):
    model = quality_rules.train(documents, labels, sample_rows=60)
    names = (
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed",
    )
    rows = quality_rules.judge(documents, model, ["doc_id"])
    expected = []
    for doc_id, text in texts:
        words, seen, lines = WORD.findall(text), set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                lines += line in seen
                seen.add(line)
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        counts, again = collections.Counter(windows), set()
        for i, window in enumerate(windows):
            if counts[window] > 1:
                again.update(range(i, i + 5))
        expected.append((
            doc_id, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), lines,
            len(again), len(words) < 10 or 100 * len(again) > 20 * len(words),
        ))
    assert rows_of(rows, *names) == sorted(expected, key=repr)
    assert rows.filter("kept AND base_failed").count() == 0


def accuracy(scored, labels, label, verdict):
    rows = scored.join(labels, "doc_id").select(
        F.avg((F.col(label) == F.col(verdict).cast("int")).cast("int"))
    )
    return rows.first()[0]


@pytest.fixture(scope="module")
def larger(spark):
    data = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")


@pytest.mark.parametrize(("symbols", "group"), [
    (byte_repeats.symbols, byte_repeats.GROUP), (word_repeats.words, word_repeats.GROUP),
])
def test_anchors_spread_evenly_over_ranges(spark, larger, symbols, group, monkeypatch):
    rows = repeats.texts_of(repeats.with_segments(spark, larger[0]))
    sent = repeats.send_anchors(rows, symbols, group, 32)
    sizes = collections.Counter()
    for r in sent.collect():
        sizes[r.bucket] += len(r.anchors) // 8
    total = sum(sizes.values())
    assert len(sizes) == 32 and max(sizes.values()) < 1.5 * total / 32
    # As many ranges as the anchors need, whatever the number of partitions.
    monkeypatch.setattr(repeats, "RANGE_ANCHORS", 100)
    assert repeats.anchor_ranges(spark, rows, group) >= total / 100


def test_held_out_quality(larger):
    documents, labels = larger
    apart = queries.held_out()
    model = quality_classifier.train(documents, labels.filter(~apart))
    scored = quality_classifier.score(documents, model, ["doc_id"])
    assert accuracy(scored.filter(apart), labels, "quality", "predicted") > 0.95
    rules = quality_rules.train(documents, labels.filter(~apart))
    judged = quality_rules.judge(documents, rules, ["doc_id"]).filter("NOT base_failed")
    assert accuracy(judged.filter(apart), labels, "quality", "kept") > 0.95


def test_held_out_toxicity(larger):
    documents, labels = larger
    apart = queries.held_out()
    model = toxicity.train(documents, labels.filter(~apart))
    scored = toxicity.score(documents, model, ["doc_id"]).withColumn("says", F.col("p_toxic") >= 0.5)
    assert accuracy(scored.filter(apart), labels, "toxic", "says") > 0.93
    assert np.tril(model.links, -1).any() and not np.triu(model.links).any()


def test_equal_texts_score_alike_and_odd_rows_have_scores(documents, labels):
    model = quality_classifier.train(documents, labels)
    chain = toxicity.train(documents, labels)
    for scored, column in (
        (quality_classifier.score(documents, model, ["doc_id"]), "score"),
        (toxicity.score(documents, chain, ["doc_id"]), "p_severe"),
    ):
        got = {r.doc_id: r[column] for r in scored.collect()}
        assert len(got) == documents.select("doc_id").distinct().count()
        assert all(0 <= v <= 1 for v in got.values())
        assert got[10_003] == got[10_004] and got[10_006] == got[10_007]
        assert got[10_000] == got[10_001]


def test_models_without_labels(spark, documents, labels, nothing):
    none = labels.filter("doc_id < 0")
    model = quality_classifier.train(documents, none)
    assert quality_classifier.score(documents, model, ["doc_id"]).filter("score != 0.5").count() == 0
    assert quality_classifier.score(nothing, model, ["doc_id"]).count() == 0
    rules = quality_rules.train(documents, none)
    assert quality_rules.judge(nothing, rules, ["doc_id"]).count() == 0
    chain = toxicity.train(documents, none)
    assert toxicity.score(documents, chain, ["doc_id"]).filter("p_toxic != 0.5").count() == 0


def test_features_are_counted_in_little_memory():
    """Training holds what a block of texts takes, and the counts: not what all texts take."""
    odd = ["", None, "one", "one one", "a" * 3_000_000, "b c " * 400_000, "\u00e9t\u00e9 " * 10, None]
    texts = pa.array(odd + [f"row {i} of plain words " * 1_000 for i in range(400)], pa.string())
    tracemalloc.start()
    got = features.counted(texts, 17)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 * sum(len(t or "") for t in texts.to_pylist())
    assert len(got) == len(texts)
    for i in [*range(len(odd)), 100, 407]:
        (ids, shares), = features.counted(texts.slice(i, 1), 17)
        assert got[i][0].tolist() == ids.tolist() and got[i][1].tolist() == shares.tolist()


# ---- rows and texts out of the ordinary ----------------------------------------------


def balanced(first, second, count=1024):
    """``count`` parts in the order in which polynomials modulo 2**64 cancel, and swapped."""
    turns = [bin(i).count("1") % 2 for i in range(count)]
    return [(first, second)[t] for t in turns], [(second, first)[t] for t in turns]


def test_no_order_of_equal_parts_deceives_the_hashes(spark):
    """Lines, words and passages of two symbols each, and the same with the symbols swapped."""
    one, other = ("".join(x) for x in balanced("a", "b"))
    data = np.frombuffer(f"{one}\n{other}\n{one} {other} tail".encode(), np.uint8)
    counts = quality_rules.base_counts(data, np.array([0, len(data)]))
    assert counts["n_dup_lines"].tolist() == [0]
    words = f"{one} b c d e {other} b c d e"
    data = np.frombuffer(words.encode(), np.uint8)
    assert quality_rules.base_counts(data, np.array([0, len(data)]))["n_repeat_words"].tolist() == [0]
    filler = " ".join(f"w{i}" for i in range(49))
    long_one, long_other = (" ".join(x) for x in balanced("aa", "bb"))
    rows = [(1, f"{filler} {one} x"), (2, f"{filler} {other} y"), (3, f"q {filler} {one} z"),
            (4, long_one), (5, long_other), (6, long_one + " end")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in word_repeats.remove_repeats(spark, frame).collect()}
    byte = {r.doc_id: r for r in byte_repeats.remove_repeats(spark, frame).collect()}
    for unit, found, size in ((str.split, got, 50), (str.encode, byte, 50)):
        seen = {}
        for number, text in rows:
            parts = unit(text)
            gone = [False] * len(parts)
            for i in range(len(parts) - size + 1):
                window = tuple(parts[i : i + size])
                if seen.setdefault(window, number) < number:
                    gone[i : i + size] = [True] * size
            assert found[number].n_removed == sum(gone), number


def test_rows_without_an_id_come_back(spark, labels):
    """Null and repeated ids, null and empty texts: every row is in every result."""
    text = " ".join(f"plain{i} words" for i in range(40))
    rows = [(None, text), (None, text), (None, None), (1, None), (1, ""), (1, text), (2, text + " x"),
            (None, "\n" * 300_000 + "end"), (3, " " * 1_100_000 + "b")]
    frame = spark.createDataFrame(
        [(i, t, "en", "src0", 1) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    ids = sorted((i for i, _ in rows), key=repr)
    same = lambda frame: sorted((r.doc_id for r in frame.collect()), key=repr)
    pieces = packing.pack_documents(spark, frame, queries.vocabulary())
    assert same(pieces.filter("piece = 0")) == ids
    assert same(byte_repeats.remove_repeats(spark, frame)) == ids
    assert same(word_repeats.remove_repeats(spark, frame)) == ids
    assert same(near_duplicates.classes(spark, frame)) == ids
    assert same(fingerprints.edit_check(spark, frame)) == ids
    model = quality_classifier.train(frame, labels)
    assert same(quality_classifier.score(frame, model, ["doc_id"])) == ids
    assert same(quality_rules.judge(frame, quality_rules.train(frame, labels), ["doc_id"])) == ids
    assert same(toxicity.score(frame, toxicity.train(frame, labels), ["doc_id"])) == ids


def test_blanks_in_a_row_are_encoded(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    words = queries.vocabulary()
    for text in ("a" + " " * 2_000_000 + "b", "\n \t" * 500_000, "x" * 150_000 + " " * 99_999 + "y"):
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert words.encode(text).tolist() == expected


def test_toxicity_is_the_last_link(larger):
    """The verdict sees the probabilities of higher degrees, and targets know no held-out row."""
    documents, labels = larger
    model = toxicity.train(documents, labels)
    assert model.names[-1] == "toxic" and model.links[-1, :-1].any()
    texts = ["vile awful text", "vile awful again", "kind words"] * 20
    data = np.frombuffer(" ".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    bounds[-1] = len(data)
    rows, keys, whole = toxicity.word_keys(data, bounds)
    toxic = np.array([1.0, 1.0, 0.0] * 20)
    told = toxicity.degrees(rows, keys, whole, toxic, np.ones(60, bool))
    assert told.sum(axis=1).tolist() == [0, 40, 40]
    assert toxicity.degrees(rows, keys, whole, toxic, np.arange(60) < 3).sum(axis=1).tolist() == [0, 0, 40]


# ---- helpers -----------------------------------------------------------------------


def test_hashes_do_not_depend_on_place():
    data = np.frombuffer(b"alpha beta alpha  beta\talpha beta", np.uint8)
    bounds = np.array([0, 16, 16, len(data)])
    starts, ends, first = word_spans(data, bounds)
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == [b"alpha", b"beta"] * 3
    assert first.tolist() == [0, 3, 3, 6]
    hashes = span_hashes(data, starts, ends)
    assert len(set(hashes[::2].tolist())) == 1 and len(set(hashes.tolist())) == 2
    assert rolling(hashes, 2)[0] == rolling(hashes, 2)[2] != rolling(hashes, 2)[1]


def test_sliding_least():
    values = np.random.default_rng(1).integers(0, 99, 60)
    for width in (1, 2, 7, 32):
        expected = [values[i : i + width].min() for i in range(60 - width + 1)]
        assert repeats.sliding_least(values, width).tolist() == expected
