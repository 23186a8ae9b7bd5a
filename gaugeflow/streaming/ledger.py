"""Which batches streams have landed whole, and what was in them.

The sink writes a batch's rows first and its entry last, so an entry says that the batch is
whole. Entries lie beside the dataset, one small file per batch until they are folded into one
table, which ``clean`` does.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gaugeflow import snapshots
from gaugeflow.operators.gates import GATES

COUNTS = ", ".join(f"{gate.lower()} bigint" for gate in GATES)
SCHEMA = f"stream string, batch bigint, row_count bigint, {COUNTS}, first_ms bigint, last_ms bigint"


def folder(landing: str) -> str:
    return f"{landing.rstrip('/')}.batches"


def folded(landing: str) -> str:
    return f"{landing.rstrip('/')}.report"


@dataclass(frozen=True)
class Batch:
    stream: str
    number: int

    @property
    def name(self) -> str:
        return f"{self.stream}-{self.number}"

    @staticmethod
    def of(name: str) -> Batch:
        stream, _, number = name.rpartition("-")
        return Batch(stream, int(number))


def observed(rows: DataFrame, observation: Observation) -> DataFrame:
    """``rows``, counted by gate as they are written; no second pass."""
    return rows.observe(
        observation,
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col("gate") == gate).alias(gate.lower()) for gate in GATES],
        F.min("timestamp").alias("first_ms"),
        F.max("timestamp").alias("last_ms"),
    )


def record(spark: SparkSession, landing: str, batch: Batch, counts: dict) -> None:
    entry = {"stream": batch.stream, "batch": batch.number, **counts}
    snapshots.write_text(spark, f"{folder(landing)}/{batch.name}.json", json.dumps(entry))


def landed(spark: SparkSession, landing: str) -> list[Batch]:
    """Batches with an entry of their own."""
    names = snapshots.names_in(spark, folder(landing))
    return [Batch.of(n.removesuffix(".json")) for n in names if n.endswith(".json")]


def beyond(spark: SparkSession, landing: str, known: dict[str, int]) -> dict[str, int]:
    """Of streams with batches that are not ``known`` yet, the last one."""
    marks: dict[str, int] = {}
    for batch in landed(spark, landing):
        if batch.number > known.get(batch.stream, -1):
            marks[batch.stream] = max(batch.number, marks.get(batch.stream, -1))
    return marks


def report(spark: SparkSession, landing: str) -> DataFrame:
    """One row per batch: rows, rows by gate, least and greatest event time."""
    parts = []
    if snapshots.names_in(spark, folded(landing)):
        parts.append(spark.read.schema(SCHEMA).parquet(folded(landing)))
    if snapshots.names_in(spark, folder(landing)):
        parts.append(spark.read.schema(SCHEMA).json(folder(landing)))
    if not parts:
        return spark.createDataFrame([], SCHEMA)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # A fold that died before it removed the entries has left them twice.
    return rows.dropDuplicates(["stream", "batch"])


def fold(spark: SparkSession, landing: str, batches: list[Batch]) -> None:
    """Move entries into the table that ``report`` reads besides."""
    files = [f"{folder(landing)}/{batch.name}.json" for batch in batches]
    if not files:
        return
    spark.read.schema(SCHEMA).json(files).coalesce(1).write.mode("append").parquet(folded(landing))
    for file in files:
        snapshots.delete(spark, file)
