"""Energy models: building dashboard, floor breakdown, hourly trend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.clock import DAY_MS, HOUR_MS, hour_start_ms, midnight, resolve, utc_seconds
from gaugeflow.functions.fields import place, reading
from gaugeflow.operators import gates
from gaugeflow.sources.stores import TelemetryStore

METER = "energy_meter"

# Price and thresholds of the dashboard, and its advice texts.
USD_PER_KWH = 0.12
# (least power factor, most anomalies, score), best first.
EFFICIENCY_STEPS = ((0.95, 0, 100), (0.90, 2, 80), (0.85, 5, 60))
EFFICIENCY_FLOOR = 40
LOW_POWER_FACTOR = 0.85
MANY_ANOMALIES = 5
HIGH_LOAD_KW = 500
ADVICE_POWER_FACTOR = "Install power factor correction equipment"
ADVICE_ANOMALIES = "Investigate voltage irregularities"
ADVICE_LOAD = "Consider load balancing"
ADVICE_NONE = "Operating normally"


# Reading and the column of its mean per meter.
_MEANS = {"power": "power_w", "voltage": "voltage", "current": "amperage", "power_factor": "power_factor"}


def meter_readings(
    store: TelemetryStore, as_of_ms: int | None = None, window_ms: int = HOUR_MS
) -> DataFrame:
    """Mean power, voltage, current and power factor per meter and place."""
    meters = store.validated(resolve(as_of_ms) - window_ms).filter(F.col("device_type") == METER)
    means = [F.avg(reading(metric)).alias(name) for metric, name in _MEANS.items()]
    return meters.groupBy(*place("building", "floor", "zone"), "device_id").agg(*means)


def floor_breakdown(
    store: TelemetryStore, as_of_ms: int | None = None, window_ms: int = HOUR_MS
) -> DataFrame:
    """Meters and power per building and floor."""
    power = F.sum("power_w")
    return (
        meter_readings(store, as_of_ms, window_ms)
        .groupBy("building", "floor")
        .agg(
            F.countDistinct("device_id").alias("meter_count"),
            power.alias("floor_power_w"),
            (power / 1000).alias("floor_power_kw"),
        )
    )


def _efficiency(power_factor: Column, anomalies: Column) -> Column:
    chain = None
    for least, most, score in EFFICIENCY_STEPS:
        test = (power_factor >= least) & (anomalies <= most)
        chain = F.when(test, score) if chain is None else chain.when(test, score)
    return chain.otherwise(EFFICIENCY_FLOOR)


def building_energy(
    store: TelemetryStore,
    as_of_ms: int | None = None,
    window_ms: int = HOUR_MS,
    count_missing_as_zero: bool = False,
) -> DataFrame:
    """Power, estimated consumption and cost, efficiency and advice per building.

    By default a building without anomalies today has no count in the score's tests, so
    all of them fail and it scores the lowest value, although its reported count is 0.
    ``count_missing_as_zero`` scores such a building by its real count of zero.

    Readings of the window and today's anomalies come from one scan: both are reduced per
    meter and place first, then per building, so there is nothing to join.
    """
    as_of = resolve(as_of_ms)
    since, today = as_of - window_ms, midnight(as_of)
    at, gate = F.col("timestamp"), F.col("gate")
    passed = (gate == gates.PASSED) & (at >= since)
    anomalous = (gate == gates.ANOMALY) & (at >= today)
    means = [
        F.avg(F.when(passed, reading(metric))).alias(name) for metric, name in _MEANS.items()
    ]
    meters = (
        store.tagged(min(since, today))
        .filter((F.col("device_type") == METER) & (passed | anomalous))
        .groupBy(*place("building", "floor", "zone"), "device_id")
        .agg(
            *means,
            F.count_if(passed).alias("_passed"),
            F.count_if(anomalous).alias("_anomalous"),
        )
    )
    power = F.sum("power_w")
    found = F.sum("_anomalous")
    # Anomalies without a building belong to no building, not to the unnamed one.
    counted = F.when(F.col("building").isNotNull() & (F.col("_found") > 0), F.col("_found"))
    buildings = (
        meters.groupBy("building")
        .agg(
            F.countDistinct(F.when(F.col("_passed") > 0, F.col("device_id"))).alias("meter_count"),
            F.sum("_passed").alias("_readings"),
            (power / 1000).alias("total_current_power_kw"),
            F.avg("voltage").alias("avg_voltage"),
            F.avg("power_factor").alias("avg_power_factor"),
            ((power * 24) / 1000).alias("estimated_daily_kwh"),
            ((power * 24 * 30) / 1000 * USD_PER_KWH).alias("estimated_monthly_cost_usd"),
            found.alias("_found"),
        )
        .filter(F.col("_readings") > 0)
        .withColumn("_anomalies", counted)
    )
    reported = F.coalesce("_anomalies", F.lit(0).cast("bigint"))
    tested = reported if count_missing_as_zero else F.col("_anomalies")
    advice = (
        F.when(F.col("avg_power_factor") < LOW_POWER_FACTOR, ADVICE_POWER_FACTOR)
        .when(tested > MANY_ANOMALIES, ADVICE_ANOMALIES)
        .when(F.col("total_current_power_kw") > HIGH_LOAD_KW, ADVICE_LOAD)
        .otherwise(ADVICE_NONE)
    )
    return (
        buildings.select(
            "building",
            "meter_count",
            "total_current_power_kw",
            "avg_voltage",
            "avg_power_factor",
            "estimated_daily_kwh",
            "estimated_monthly_cost_usd",
            reported.alias("energy_anomalies_today"),
            _efficiency(F.col("avg_power_factor"), tested).alias("efficiency_score"),
            advice.alias("recommendation"),
            utc_seconds(F.lit(as_of).cast("bigint")).alias("dashboard_updated_at"),
        )
        .orderBy(F.desc_nulls_last("total_current_power_kw"))
    )


def energy_trend(
    store: TelemetryStore, as_of_ms: int | None = None, window_ms: int = DAY_MS
) -> DataFrame:
    """Power per hour and building, with its running sum within the building.

    The running sum works on one row per hour, so even a building with most of all
    readings is a short window.
    """
    meters = store.validated(resolve(as_of_ms) - window_ms).filter(F.col("device_type") == METER)
    hourly = meters.groupBy(hour_start_ms("timestamp").alias("_h"), *place("building")).agg(
        (F.sum(reading("power")) / 1000).alias("total_power_kw")
    )
    so_far = Window.partitionBy("building").orderBy("_h").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        hourly.withColumn("cumulative_kwh", F.sum("total_power_kw").over(so_far))
        .orderBy(F.asc_nulls_last("building"), "_h")
        .select(utc_seconds("_h").alias("hour"), "building", "total_power_kw", "cumulative_kwh")
    )
