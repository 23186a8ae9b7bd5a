"""Device models: summary, latest metrics, health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.clock import DAY_MS, day_start_ms, resolve, utc_seconds
from gaugeflow.functions.fields import reading
from gaugeflow.operators import gates
from gaugeflow.operators.latest import latest_per_device, recency
from gaugeflow.sources.stores import TelemetryStore


def device_summary(store: TelemetryStore) -> DataFrame:
    """Readings, first and last time and active UTC days of each device, over all history.

    A day in which a device was active is a row of the first aggregate, so the exact
    distinct count needs no expanded rows: the second aggregate merely counts them.
    """
    daily = (
        store.validated()
        .groupBy("device_id", "device_type", day_start_ms("timestamp").alias("_day"))
        .agg(
            F.count("*").alias("_n"),
            F.min("timestamp").alias("_first"),
            F.max("timestamp").alias("_last"),
        )
    )
    return daily.groupBy("device_id", "device_type").agg(
        F.sum("_n").alias("total_readings"),
        F.min("_first").alias("first_seen"),
        F.max("_last").alias("last_seen"),
        F.count("_day").alias("active_days"),
    )


def _text(column: Column) -> Column:
    return column.cast("string")


def readings_text() -> Column:
    """The main readings of a device type in one line; NULL if one of them is missing."""
    kind = F.col("device_type")
    # Wording and units of the line.
    return (
        F.when(
            kind == "temperature_sensor",
            F.concat(
                F.lit("Temp: "), _text(reading("temperature")),
                F.lit("°C, Humidity: "), _text(reading("humidity")), F.lit("%"),
            ),
        )
        .when(
            kind == "pressure_sensor",
            F.concat(F.lit("Pressure: "), _text(reading("pressure")), F.lit(" hPa")),
        )
        .when(
            kind == "energy_meter",
            F.concat(
                F.lit("Power: "), _text(reading("power")),
                F.lit(" W, Voltage: "), _text(reading("voltage")), F.lit(" V"),
            ),
        )
        .when(
            kind == "vibration_sensor",
            F.concat(F.lit("Vibration X: "), _text(reading("vibration_x"))),
        )
        .otherwise("N/A")
    )


def device_metrics_latest(store: TelemetryStore) -> DataFrame:
    """The newest validated reading of each device, over all history."""
    newest = latest_per_device(
        store.validated(),
        "device_type",
        "timestamp",
        "readings",
        F.col("metadata.location").alias("location"),
        "metadata.battery_level",
        "metadata.signal_strength",
    )
    return newest.select(
        "device_id",
        "device_type",
        "location.building",
        "location.floor",
        "location.zone",
        F.col("timestamp").alias("last_reading_timestamp"),
        utc_seconds("timestamp").alias("last_reading_time"),
        readings_text().alias("latest_readings"),
        "battery_level",
        "signal_strength",
    )


# The health ladder, first match wins. (score, advice) per step.
HEALTH_STEPS = {
    "battery_flat": (0, "URGENT: Replace battery"),
    "many_anomalies": (20, "URGENT: Device malfunction"),
    "weak_signal": (40, "Check connectivity"),
    "some_anomalies": (60, "Schedule inspection"),
    "battery_half": (80, "Plan battery replacement"),
}
HEALTHY = (100, "Healthy")


def _health() -> tuple[Column, Column]:
    """Score and advice. A NULL measure fails its test and falls through to the next."""
    battery, signal, anomalies = (
        F.col("min_battery_level"), F.col("avg_signal_strength"), F.col("_anomalies"),
    )
    tests = {
        "battery_flat": battery < 20,
        "many_anomalies": anomalies > 10,
        "weak_signal": signal < 60,
        "some_anomalies": anomalies > 5,
        "battery_half": battery < 50,
    }
    ladder = [(tests[step], *outcome) for step, outcome in HEALTH_STEPS.items()]

    def column(pick: int) -> Column:
        chain = F.when(ladder[0][0], F.lit(ladder[0][pick]))
        for rung in ladder[1:]:
            chain = chain.when(rung[0], F.lit(rung[pick]))
        return chain.otherwise(F.lit(HEALTHY[pick - 1]))

    return column(1), column(2)


def device_health(
    store: TelemetryStore, as_of_ms: int | None = None, window_ms: int = DAY_MS
) -> DataFrame:
    """Health score and maintenance advice for every device with a validated reading.

    Metrics are kept per device and type, anomalies per device, while place and firmware
    come from the device's newest row; a device seen under two types has two rows.

    One scan and no join: the aggregate counts passed and anomalous rows apart and carries
    the newest passed row of each type, and a window over the few rows that remain per
    device adds up anomalies and picks the newest of the newest.
    """
    as_of = resolve(as_of_ms)
    passed, anomalous = F.col("gate") == gates.PASSED, F.col("gate") == gates.ANOMALY
    signal = F.when(passed, F.col("metadata.signal_strength"))
    battery = F.when(passed, F.col("metadata.battery_level"))
    newest = F.struct(
        "device_type",
        F.col("metadata.location").alias("location"),
        F.col("metadata.firmware_version").alias("firmware_version"),
    )
    when = F.when(passed, recency())
    per_type = (
        store.tagged(as_of - window_ms)
        .filter(F.col("gate").isin(gates.PASSED, gates.ANOMALY) & F.col("device_id").isNotNull())
        .groupBy("device_id", "device_type")
        .agg(
            F.count_if(passed).alias("total_readings_24h"),
            F.avg(signal.cast("double")).alias("avg_signal_strength"),
            F.avg(battery.cast("double")).alias("avg_battery_level"),
            F.min(battery).alias("min_battery_level"),
            F.max(F.when(passed, F.col("timestamp"))).alias("_last_seen"),
            F.max_by(newest, when).alias("_newest"),
            F.max(when).alias("_recency"),
            F.count_if(anomalous).alias("_anomalies"),
            F.max(F.when(anomalous, F.col("anomaly_score"))).alias("_max_score"),
        )
        .drop("device_type")
    )
    device = Window.partitionBy("device_id")
    per_device = per_type.withColumns(
        {
            "_newest": F.max_by("_newest", "_recency").over(device),
            "_anomalies": F.sum("_anomalies").over(device),
            "_max_score": F.max("_max_score").over(device),
        }
    ).filter(F.col("total_readings_24h") > 0)
    score, advice = _health()
    return per_device.select(
        "device_id",
        "_newest.device_type",
        "_newest.location.building",
        "_newest.location.floor",
        "_newest.location.zone",
        "_newest.firmware_version",
        "total_readings_24h",
        "avg_signal_strength",
        "avg_battery_level",
        "min_battery_level",
        F.col("_anomalies").alias("anomaly_count_24h"),
        F.coalesce("_max_score", F.lit(0.0)).alias("max_anomaly_score"),
        score.alias("health_score"),
        advice.alias("maintenance_recommendation"),
        utc_seconds("_last_seen").alias("last_seen"),
        utc_seconds(F.lit(as_of).cast("bigint")).alias("updated_at"),
    )
