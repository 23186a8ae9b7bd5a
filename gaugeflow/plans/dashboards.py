"""Dashboard queries on gated telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.clock import DAY_MS, HOUR_MS, hour_start_ms, resolve, utc_seconds
from gaugeflow.functions.fields import distinct_values, magnitude, place, reading
from gaugeflow.operators.latest import latest_per_device
from gaugeflow.sources.stores import GatedStore, TelemetryStore

# Fixed value: device types that report a temperature.
THERMAL_TYPES = ("temperature_sensor", "pressure_sensor", "vibration_sensor")


def status_overview(
    store: TelemetryStore,
    as_of_ms: int | None = None,
    window_ms: int = HOUR_MS,
    limit: int = 20,
) -> DataFrame:
    """The newest validated readings."""
    newest = (
        store.validated(resolve(as_of_ms) - window_ms)
        .orderBy(F.desc("timestamp"), F.desc("event_id"))
        .limit(limit)
    )
    return newest.select(
        "device_id",
        "device_type",
        *place("building", "floor", "zone"),
        "quality_status",
        utc_seconds("timestamp").alias("last_reading_time"),
        "readings",
    )


def anomaly_top_devices(
    store: TelemetryStore,
    as_of_ms: int | None = None,
    window_ms: int = DAY_MS,
    limit: int = 10,
) -> DataFrame:
    """Devices with the most anomalies and the anomaly types they reported.

    A row without a reported type contributes NULL to the array. Rows are first counted per
    device and type, so that only the few types of a device are collected.
    """
    typed = (
        store.anomalies(resolve(as_of_ms) - window_ms)
        .groupBy("device_id", "device_type", F.col("metadata.anomaly_type").alias("_type"))
        .agg(
            F.count("*").alias("_rows"),
            F.sum("anomaly_score").alias("_score"),
            F.count("anomaly_score").alias("_scored"),
            F.max("anomaly_score").alias("_max"),
        )
    )
    return (
        typed.groupBy("device_id", "device_type")
        .agg(
            F.sum("_rows").alias("anomaly_count"),
            F.try_divide(F.sum("_score"), F.sum("_scored")).alias("avg_anomaly_score"),
            F.max("_max").alias("max_anomaly_score"),
            distinct_values("_type").alias("anomaly_types"),
        )
        .orderBy(F.desc("anomaly_count"), F.asc("device_id"), F.asc("device_type"))
        .limit(limit)
    )


def temperature_heatmap(
    store: TelemetryStore, as_of_ms: int | None = None, window_ms: int = HOUR_MS
) -> DataFrame:
    """Mean, lowest and highest temperature and number of sensors per building and floor."""
    temperature = reading("temperature")
    return (
        store.validated(resolve(as_of_ms) - window_ms)
        .filter(F.col("device_type").isin(*THERMAL_TYPES) & temperature.isNotNull())
        .groupBy(*place("building", "floor"))
        .agg(
            F.avg(temperature).alias("avg_temperature"),
            F.min(temperature).alias("min_temperature"),
            F.max(temperature).alias("max_temperature"),
            F.countDistinct("device_id").alias("sensor_count"),
        )
        .orderBy(F.asc_nulls_last("building"), F.asc_nulls_last("floor"))
    )


def silent_devices(
    store: TelemetryStore,
    as_of_ms: int | None = None,
    silence_ms: int = HOUR_MS,
    latest_only: bool = False,
) -> DataFrame:
    """Devices whose last message of any kind is older than ``silence_ms``.

    By default a device appears once for every distinct metadata it ever passed the gates
    with. ``latest_only`` keeps the newest of these, one row per device.
    """
    as_of = resolve(as_of_ms)
    silent = (
        store.raw()
        .groupBy("device_id")
        .agg(F.max("timestamp").alias("_last"))
        .filter(F.col("_last") < F.lit(as_of - silence_ms).cast("bigint"))
    )
    if latest_only:
        known = latest_per_device(store.validated(), "device_type", "metadata")
    else:
        # Only the silent devices' rows need telling apart.
        rows = store.validated().select("device_id", "device_type", "metadata")
        known = rows.join(silent, "device_id", "left_semi").distinct()
    return (
        silent.join(known, "device_id")
        .select(
            "device_id",
            "device_type",
            *place("building", "floor"),
            utc_seconds("_last").alias("last_seen"),
            (F.lit(as_of).cast("bigint") - F.col("_last")).alias("silence_duration_ms"),
        )
        .orderBy(F.desc("silence_duration_ms"))
    )


# Thresholds of the vibration report.
TREND_STEP = 0.5
REPORTED_INCREASE = 0.3


def vibration_trend(
    store: TelemetryStore,
    as_of_ms: int | None = None,
    window_ms: int = DAY_MS,
    signed: bool = False,
) -> DataFrame:
    """Devices whose hourly mean vibration spread over the window.

    The increase is highest minus lowest hour, which is never negative. ``signed`` takes
    last minus first hour instead and also reports falling devices.
    """
    hourly = (
        store.validated(resolve(as_of_ms) - window_ms)
        .filter(F.col("device_type") == "vibration_sensor")
        .groupBy("device_id", hour_start_ms("timestamp").alias("_h"))
        .agg(F.avg(magnitude("vibration_x", "vibration_y", "vibration_z")).alias("_mean"))
    )
    lowest, highest = F.min("_mean"), F.max("_mean")
    change = F.max_by("_mean", "_h") - F.min_by("_mean", "_h") if signed else highest - lowest
    increase = F.col("vibration_increase")
    reported = F.abs(increase) if signed else increase
    return (
        hourly.groupBy("device_id")
        .agg(
            lowest.alias("min_vibration"),
            highest.alias("max_vibration"),
            change.alias("vibration_increase"),
        )
        .filter(reported > REPORTED_INCREASE)
        .withColumn(
            "trend",
            F.when(increase > TREND_STEP, "INCREASING")
            .when(increase < -TREND_STEP, "DECREASING")
            .otherwise("STABLE"),
        )
        .orderBy(F.desc("vibration_increase"))
    )


def _quality_counts(rows: DataFrame, key: str) -> DataFrame:
    return (
        rows.groupBy(key)
        .agg(
            F.count("*").alias("record_count"),
            F.countDistinct("device_id").alias("device_count"),
            F.avg("anomaly_score").alias("avg_anomaly_score"),
            F.min("timestamp").alias("_first"),
            F.max("timestamp").alias("_last"),
        )
        .orderBy(F.desc("record_count"))
        .select(
            key,
            "record_count",
            "device_count",
            "avg_anomaly_score",
            utc_seconds("_first").alias("first_occurrence"),
            utc_seconds("_last").alias("last_occurrence"),
        )
    )


def data_quality(
    store: TelemetryStore, as_of_ms: int | None = None, window_ms: int = DAY_MS
) -> DataFrame:
    """Rows, devices, mean score and time span per quality status of the validated table."""
    return _quality_counts(store.validated(resolve(as_of_ms) - window_ms), "quality_status")


def data_quality_all(
    store: GatedStore, as_of_ms: int | None = None, window_ms: int = DAY_MS
) -> DataFrame:
    """The same counts for all four gates. Rows without event time lie in no window."""
    return _quality_counts(store.rows(resolve(as_of_ms) - window_ms), "gate")


def battery_alert(
    store: TelemetryStore,
    as_of_ms: int | None = None,
    window_ms: int = HOUR_MS,
    below: int = 30,
    limit: int = 20,
) -> DataFrame:
    """The lowest battery readings below ``below`` percent."""
    battery = F.col("metadata.battery_level")
    lowest = (
        store.validated(resolve(as_of_ms) - window_ms)
        .filter(battery.isNotNull() & (battery < below))
        .orderBy(battery.asc(), F.desc("timestamp"), F.desc("event_id"))
        .limit(limit)
    )
    return lowest.select(
        "device_id",
        "device_type",
        *place("building", "floor", "zone"),
        battery.alias("current_battery_level"),
        utc_seconds("timestamp").alias("reading_time"),
    )
