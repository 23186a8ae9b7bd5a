"""One query for each operator of this package, over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import (
    byte_repeats,
    embedding_links,
    filter_audit,
    fingerprints,
    merkle,
    mixing,
    near_duplicates,
    packing,
    quality_classifier,
    quality_rules,
    toxicity,
    warc,
    word_repeats,
)
from gaugeflow.llm.common import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> packing.Vocabulary:
    """Both forms of the vocabulary; GAUGEFLOW_VOCABULARY names the path of another, less the
    endings .tiktoken and .json."""
    stem = os.environ.get("GAUGEFLOW_VOCABULARY")
    if stem:
        return packing.Vocabulary(f"{stem}.tiktoken", f"{stem}.json")
    import public_tokenizers

    names = ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json")
    return packing.Vocabulary(*map(public_tokenizers.path, names))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, table(spark, sf_dir, "documents"), vocabulary())


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    manifest = warc.archive_pages(spark, pages, scratch(spark, "archives"))
    records = warc.read_archives(warc.spread(spark, manifest), keep_payload=False)
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified"
    )


def op3_byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_repeats.remove_repeats(spark, table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents, model, ["doc_id"])
    return scored.withColumn("toxic", (F.col("p_toxic") >= 0.5).cast("int"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(spark, table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_rows(spark, table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality_rules.train(documents, table(spark, sf_dir, "labels"))
    return quality_rules.judge(documents, model, ["doc_id"])


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_check(spark, table(spark, sf_dir, "documents"))


def op9_word_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_repeats.remove_repeats(spark, table(spark, sf_dir, "documents"))


def held_out() -> Column:
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    model = quality_classifier.train(documents, labels)
    scored = quality_classifier.score(documents, model, ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return filter_audit.audit_documents(spark, documents, labels)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(spark, table(spark, sf_dir, "documents"))


def op13_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links.link_vectors(spark, table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_best_fit_packing": op1_best_fit_packing,
        "op2_warc": op2_warc,
        "op3_byte_repeats": op3_byte_repeats,
        "op4_toxicity": op4_toxicity,
        "op5_near_duplicates": op5_near_duplicates,
        "op6_mixing": op6_mixing,
        "op7_quality_rules": op7_quality_rules,
        "op8_fingerprints": op8_fingerprints,
        "op9_word_repeats": op9_word_repeats,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_filter_audit": op11_filter_audit,
        "op12_merkle": op12_merkle,
        "op13_embedding_links": op13_embedding_links,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express; tests hold the others to brute force."""
    return {
        "op2_warc": """
            WITH p AS (
                SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS size
                FROM pages
            ), f AS (
                SELECT *, CASE WHEN size >= 100
                    THEN min(page_id) OVER (PARTITION BY payload) ELSE page_id END AS first_id
                FROM p
            )
            SELECT page_id, size AS payload_bytes, sha256(payload) AS payload_digest,
                   CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
                   CASE WHEN first_id = page_id THEN NULL ELSE first_id END AS refers_to,
                   true AS verified
            FROM f
        """,
        "op6_mixing": mixing.oracle(),
        "op11_filter_audit": filter_audit.oracle(),
        "op12_merkle": merkle.oracle(),
        "op13_embedding_links": embedding_links.oracle(),
    }
