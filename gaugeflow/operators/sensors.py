"""Per-metric operators over the open set of metrics in ``readings``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.clock import DAY_MS, hour_start_ms, resolve, utc_seconds
from gaugeflow.operators.rules import DECLARED, RangeRule, breached_rules
from gaugeflow.sources.stores import TelemetryStore


def by_metric(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per metric with a value; ``keep`` names the columns carried along."""
    return rows.select(*keep, F.explode("readings").alias("metric", "value")).filter(
        F.col("value").isNotNull()
    )


def stuck_sensors(
    store: TelemetryStore,
    as_of_ms: int | None = None,
    window_ms: int = DAY_MS,
    min_readings: int = 5,
) -> DataFrame:
    """Metrics of a device that never changed over the window.

    A single value repeated at least ``min_readings`` times is in range, so no range rule
    can see it. Four plain accumulators per device and metric; nothing is collected.
    """
    since = resolve(as_of_ms) - window_ms
    values = by_metric(store.validated(since), "device_id", "device_type", "timestamp")
    return (
        values.groupBy("device_id", "device_type", "metric")
        .agg(
            F.count("*").alias("reading_count"),
            F.min("value").alias("stuck_value"),
            F.max("value").alias("_max"),
            F.min("timestamp").alias("_first"),
            F.max("timestamp").alias("_last"),
        )
        .filter((F.col("stuck_value") == F.col("_max")) & (F.col("reading_count") >= min_readings))
        .select(
            "device_id",
            "device_type",
            "metric",
            "stuck_value",
            "reading_count",
            utc_seconds("_first").alias("first_seen"),
            utc_seconds("_last").alias("last_seen"),
        )
    )


def hourly_sensor_aggregates(
    store: TelemetryStore, as_of_ms: int | None = None, window_ms: int | None = DAY_MS
) -> DataFrame:
    """Count, mean, minimum and maximum per device, metric and hour.

    ``window_ms=None`` covers all history.
    """
    since = None if window_ms is None else resolve(as_of_ms) - window_ms
    values = by_metric(store.validated(since), "device_id", "device_type", "timestamp")
    return (
        values.groupBy("device_id", "device_type", "metric", hour_start_ms("timestamp").alias("_h"))
        .agg(
            F.count("*").alias("reading_count"),
            F.avg("value").alias("avg_value"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
        )
        .select(
            "device_id",
            "device_type",
            "metric",
            utc_seconds("_h").alias("hour"),
            "reading_count",
            "avg_value",
            "min_value",
            "max_value",
        )
    )


def rule_breaches(
    store: TelemetryStore,
    as_of_ms: int | None = None,
    window_ms: int | None = DAY_MS,
    rules: tuple[RangeRule, ...] = DECLARED,
) -> DataFrame:
    """Readings outside their range, counted per device type and metric.

    Reads the raw audit rows with an id, so it can judge a rule profile that the live
    gates do not apply.
    """
    since = None if window_ms is None else resolve(as_of_ms) - window_ms
    rows = store.raw(since).filter(F.col("event_id").isNotNull())
    return (
        rows.select("device_type", F.explode(breached_rules(rules)).alias("metric"))
        .groupBy("device_type", "metric")
        .agg(F.count("*").alias("breach_count"))
    )
