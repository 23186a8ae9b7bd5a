"""Rejected messages, with what is needed to look into or replay them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeflow.operators.gates import reason, rejected_rows
from gaugeflow.schemas import DEAD_LETTER_COLUMNS


def dead_letters(gated: DataFrame, *extra: str) -> DataFrame:
    """Rows of gates SCHEMA and INDETERMINATE: raw text, envelope, gate and reason."""
    rejected = rejected_rows(gated)
    if "reason" not in gated.columns:
        rejected = rejected.withColumn("reason", reason())
    return rejected.select(*DEAD_LETTER_COLUMNS, *extra)
