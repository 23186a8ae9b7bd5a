"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. Between stages the rows are written to the shared folder and read
back. Duplicates and the mix go by row, so rows that repeat a doc_id or have none count as any
other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import (
    byte_repeats,
    mixing,
    near_duplicates,
    packing,
    quality_classifier,
)
from gaugeflow.llm.common import stage, with_rows
from gaugeflow.llm.queries import held_out, table, vocabulary


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    model = quality_classifier.train(table(spark, sf_dir, "documents"), labels)
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "text")
    # The text itself goes along as a column of the row.
    rows = rows.withColumn("kept", F.col("text"))
    scored = quality_classifier.score(rows, model, ["row", "kept"]).filter("predicted = 1")
    place = lambda c: F.col("kept").alias("text") if c == "text" else F.col("row")[c].alias(c)
    return scored.select(*[place(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one row: that with the least doc_id, if any has one.

    Rows with the same doc_id and different texts are told apart like any others.
    """
    rows = with_rows(spark, docs)
    texts = rows.select(F.col("_row").alias("doc_id"), F.col("doc.text").alias("text"))
    named = near_duplicates.classes(spark, texts).withColumnRenamed("doc_id", "_row")
    columns = [F.col("doc")[c] for c in docs.columns]
    first = F.struct(
        F.col("doc.doc_id").isNull(), "doc.doc_id", F.xxhash64(*columns), "_row"
    )
    ranks = rows.select("_row", first.alias("_first"))
    best = named.join(ranks, "_row").groupBy("class_id").agg(F.min("_first").alias("_first"))
    return rows.join(best.select("_first._row"), "_row").select("doc.*")


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier documents have too."""
    rows = byte_repeats.cleaned(spark, docs)
    return rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy of a document that the mix takes; a copy taken in part is whole."""
    rows = with_rows(spark, docs)
    read = rows.select(*[F.col("doc")[c].alias(c) for c in ("doc_id", "text", "lang", "source")], "_row")
    chosen = mixing.mix_rows(spark, read, carried=("_row",)).select("_row")
    return rows.join(chosen, "_row").select("doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and the places they have in sequences of 2048 tokens."""
    return packing.pack_documents(spark, docs, vocabulary())


STAGES = [
    ("quality_classifier", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_array", remove_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Learned scores and sampled signatures have no SQL form; tests hold each stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(spark, apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
