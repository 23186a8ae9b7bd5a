"""Shorthand for telemetry fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reading(metric: str) -> Column:
    """One metric as a double; NULL when the device did not send it."""
    return F.col("readings")[metric]


def place(*parts: str) -> list[Column]:
    """Location fields as columns of their own name."""
    return [F.col(f"metadata.location.{part}").alias(part) for part in parts]


def magnitude(*metrics: str) -> Column:
    """Length of the vector of these metrics; NULL when one is missing."""
    squares = [F.pow(reading(m), F.lit(2.0)) for m in metrics]
    total = squares[0]
    for square in squares[1:]:
        total = total + square
    return F.sqrt(total)


def distinct_values(column: Column | str) -> Column:
    """Sorted array of distinct values in which NULL counts as a value.

    ``collect_set`` skips NULL; wrapping each value in a struct keeps it. The array is as
    large as the set of distinct values, so use it on columns with few.
    """
    column = F.col(column) if isinstance(column, str) else column
    wrapped = F.collect_set(F.struct(column.alias("v")))
    return F.sort_array(F.transform(wrapped, lambda e: e["v"]))
