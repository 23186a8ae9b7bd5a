"""Documents of the smallest table, with the cases that are easily forgotten."""

import pytest
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_rows():
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    passage = " ".join(f"passage{i}" for i in range(70))
    return [
        (10_000, None, "en", "src0", None), (10_001, "", None, None, 0),
        (10_002, " \n\t ", "en", "src0", 4), (10_003, "one", "xx", "src99", 3),
        (10_004, "one", "xx", "src99", 3), (10_005, "two words", "en", "src1", 9),
        (10_006, long, "en", "src0", len(long)), (10_007, long, "en", "src0", len(long)),
        (10_008, f"a b {passage} c d", "en", "src2", 0), (10_009, f"x {passage} y", "en", "src2", 0),
        (10_010, "same line\nsame line\nother\n", "de", "src3", 0),
        (10_011, "é" * 120 + " <|endoftext|> #$% ünï", "fr", "src4", 0),
        (10_012, "ab " * 200, "en", "src0", 0), (10_013, "ab " * 200 + "z", "en", "src0", 0),
        (10_014, "repeated row of the table", "en", "src5", 0),
        (10_014, "repeated row of the table", "en", "src5", 0),
    ]


@pytest.fixture(scope="session")
def documents(spark, odd_rows, tmp_path_factory):
    """Read from files, several of them, with columns whose names operators use inside."""
    path = str(tmp_path_factory.mktemp("llm") / "documents.parquet")
    base = spark.read.parquet(f"{DATA}/documents.parquet").select(*SCHEMA_COLUMNS)
    rows = base.union(spark.createDataFrame(odd_rows, SCHEMA)).withColumns(
        {"label": F.lit("x"), "segment": F.lit(1), "_key": F.lit(2.5), "kept": F.lit(True)}
        # Names that operators have used for what they add.
        | {c: F.lit(-7) for c in ("_row", "_file", "_index", "_number", "_segment", "row", "doc")}
    )
    rows.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def texts(documents):
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    return sorted((r.doc_id, r.text) for r in rows)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.filter("doc_id < -1")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


SCHEMA_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
