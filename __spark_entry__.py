"""

Queries run over the whole ``events`` table, turned into telemetry row by row. Names
ending in ``_24h``, ``_1h`` or ``_all`` state their window; others use 720 hours, which
covers the 30 days of the data.
"""

from __future__ import annotations

import dataclasses
import functools
import importlib
import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gaugeflow import tables
from gaugeflow.branches import Branch, publish
from gaugeflow.functions.clock import DAY_MS, HOUR_MS
from gaugeflow.operators import contract, dead_letter, gates, sensors
from gaugeflow.operators.rules import LIVE, TimeLimits, out_of_range, out_of_time
from gaugeflow.plans import dashboards, device_models, energy_models, incremental
from gaugeflow.plans.registry import run_models
from gaugeflow.session import shared_dir
from gaugeflow.sources import events, messages
from gaugeflow.sources.stores import DatasetStore, EventsStore, FrameStore, TableStore
from gaugeflow.streaming import ingest, ledger, rollup

AS_OF = events.AS_OF_MS
WIDE = 720 * HOUR_MS
LIMITS = TimeLimits(max_age_ms=events.MAX_AGE_MS)
# Batches in which the rollup gets its messages.
DELIVERIES = 4
# For the time limits of the gates: an instant with events beyond both of them.
MID_MONTH = 1_705_708_800_000

METRICS = [
    "temperature", "humidity", "pressure", "vibration_x", "vibration_y", "vibration_z",
    "voltage", "current", "power", "power_factor",
]

Query = Callable[[SparkSession, str], DataFrame]


def _round(column: Column | str) -> Column:
    return F.round(column, 6)


def _rounded(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({name: _round(name) for name in names})


def _flat(rows: DataFrame, *extra: Column | str) -> DataFrame:
    """Telemetry with every nested value as a column of its own, since maps do not hash."""
    meta = [
        F.col(f"metadata.{name}")
        for name in (
            "firmware_version", "signal_strength", "battery_level", "anomaly_detected",
            "anomaly_type", "status", "error",
        )
    ]
    place = [F.col(f"metadata.location.{name}") for name in ("building", "floor", "zone")]
    metrics = [_round(F.col("readings")[m]).alias(m) for m in METRICS]
    base = ["event_id", "device_id", "device_type", F.col("timestamp").alias("ts_ms")]
    size = F.size("readings").alias("reading_count")
    return rows.select(*base, *place, *meta, size, *metrics, *extra)


def _store(spark: SparkSession, sf_dir: str, limits: TimeLimits = LIMITS) -> EventsStore:
    return EventsStore(spark, sf_dir, AS_OF, LIVE, limits)


def _messages(spark: SparkSession, sf_dir: str, faulty: bool = False) -> DataFrame:
    return events.to_messages(events.read_events(spark, sf_dir), faulty)


def _gated_messages(spark: SparkSession, sf_dir: str, faulty: bool = False) -> DataFrame:
    parsed = messages.parse_envelope(_messages(spark, sf_dir, faulty))
    return gates.classify(parsed, AS_OF, LIVE, LIMITS)


# ---- messages and gates ------------------------------------------------------------


def q_envelope_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = messages.parse_envelope(_messages(spark, sf_dir))
    kafka_ms = F.unix_millis("kafka_timestamp").alias("kafka_ms")
    return _flat(parsed, "kafka_key", "topic", "partition", "offset", kafka_ms)


def q_encode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    telemetry = events.to_telemetry(events.read_events(spark, sf_dir))
    sent = messages.encode(telemetry).select(
        "key", "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"), F.current_timestamp().alias("timestamp"),
    )
    received = messages.parse_envelope(sent)
    return received.groupBy("device_type").agg(
        F.count("*").alias("message_count"),
        F.sum((messages.message_text() == F.col("value")).cast("bigint")).alias("equal_count"),
        F.sum((F.col("kafka_key") == F.col("device_id")).cast("bigint")).alias("keyed_count"),
        F.sum(F.size("readings").cast("bigint")).alias("reading_count"),
    )


def q_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _gated_messages(spark, sf_dir).groupBy("gate")
    return counted.agg(F.count("*").alias("row_count"))


def q_route_counts_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _store(spark, sf_dir, TimeLimits()).rows()
    return rows.groupBy("gate").agg(F.count("*").alias("row_count"))


def q_gate_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = messages.parse_envelope(_messages(spark, sf_dir))
    return parsed.groupBy("device_type").agg(
        F.count_if(F.col("event_id").isNotNull()).alias("valid_count"),
        F.count_if(F.col("event_id").isNull()).alias("invalid_count"),
    )


def q_gate_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events.to_telemetry(events.read_events(spark, sf_dir))
    verdict = out_of_range(LIVE) | out_of_time(gates.fixed_clock(AS_OF), LIMITS)
    judged = rows.filter(F.col("event_id").isNotNull()).select(
        "device_type", F.coalesce(verdict.cast("string"), F.lit("unknown")).alias("anomalous")
    )
    return judged.groupBy("device_type", "anomalous").agg(F.count("*").alias("row_count"))


def q_gate_time_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events.to_telemetry(events.read_events(spark, sf_dir))
    at, limits = F.col("timestamp"), TimeLimits()
    outside = out_of_time(gates.fixed_clock(MID_MONTH), limits)
    return rows.groupBy("device_type").agg(
        F.count_if(outside & (at > MID_MONTH)).alias("future_count"),
        F.count_if(outside & (at < MID_MONTH)).alias("stale_count"),
        F.count_if(~outside).alias("timely_count"),
    )


def q_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _store(spark, sf_dir).validated()
    return _flat(rows, "quality_status", "anomaly_score", "validation_method")


def q_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _store(spark, sf_dir).anomalies()
    return _flat(rows, "quality_status", "anomaly_score", "validation_method")


def q_anomaly_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _store(spark, sf_dir).rows()
    return rows.groupBy("gate", "anomaly_score").agg(F.count("*").alias("row_count"))


def q_raw_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_store(spark, sf_dir).raw())


def q_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = dead_letter.dead_letters(_gated_messages(spark, sf_dir, faulty=True))
    return letters.select(
        "kafka_key", "topic", "partition", "offset",
        F.unix_millis("kafka_timestamp").alias("kafka_ms"), "gate", "reason",
        F.col("value").isNotNull().alias("has_value"),
    )


def q_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.contract_violations(_messages(spark, sf_dir, faulty=True))


def _next_contract() -> tuple[contract.Field, ...]:
    """The contract as a later version could have it."""
    kept = {
        f: f for f in contract.CONTRACT
        if f.path not in ("metadata.error", "readings.power_factor")
    }
    for field in kept:
        if field.path == "metadata.firmware_version":
            kept[field] = dataclasses.replace(field, optional=False)
        elif field.path == "metadata.battery_level":
            kept[field] = dataclasses.replace(field, kinds=("BIGINT", "DECIMAL", "DOUBLE"))
        elif field.path == "device_type":
            kept[field] = dataclasses.replace(field, values=(*field.values, "co2_sensor"))
    humid = contract.Field("readings.humidity", ("BIGINT", "DECIMAL", "DOUBLE"), "pressure_sensor")
    return (*kept.values(), humid)


def q_contract_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a later contract changes, and how many of the messages at hand each change meets."""
    sent = _messages(spark, sf_dir, faulty=True)
    return contract.version_impact(sent, contract.CONTRACT, _next_contract())


# ---- projections and filters -------------------------------------------------------


def q_map_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [F.count(F.col("readings")[m]).alias(f"n_{m}") for m in METRICS]
    sums = [_round(F.sum(F.col("readings")[m])).alias(f"sum_{m}") for m in METRICS]
    return _store(spark, sf_dir).raw().groupBy("device_type").agg(*counts, *sums)


def q_trailing_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = (1, 24, 168, 720)
    at = F.col("timestamp")
    rows = _store(spark, sf_dir).validated(AS_OF - max(hours) * HOUR_MS)
    return rows.groupBy("device_type").agg(
        *[F.count_if(at >= AS_OF - h * HOUR_MS).alias(f"last_{h}h") for h in hours]
    )


def q_distinct_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _store(spark, sf_dir).validated().select("device_id", "device_type", "metadata")
    return known.distinct().groupBy("device_id").agg(F.count("*").alias("variant_count"))


def q_sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three tables queried as SQL text, with nested fields and map subscripts."""
    _store(spark, sf_dir).register_views()
    return spark.sql(
        """
        SELECT v.metadata.location.building AS building,
               count(*) AS reading_count,
               round(avg(v.readings['voltage']), 6) AS avg_voltage,
               max(a.anomaly_count) AS anomaly_count
        FROM validated_telemetry v
        LEFT JOIN (
            SELECT metadata.location.building AS building, count(*) AS anomaly_count
            FROM anomaly_alerts GROUP BY metadata.location.building
        ) a ON v.metadata.location.building = a.building
        WHERE v.device_type = 'energy_meter'
        GROUP BY v.metadata.location.building
        """
    )


# ---- models ------------------------------------------------------------------------


def q_device_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return device_models.device_summary(_store(spark, sf_dir))


def q_device_metrics_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return device_models.device_metrics_latest(_store(spark, sf_dir))


def _health(window_ms: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = device_models.device_health(_store(spark, sf_dir), AS_OF, window_ms)
        return _rounded(rows, "avg_signal_strength", "avg_battery_level")

    return run


def _building(window_ms: int, **options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = energy_models.building_energy(_store(spark, sf_dir), AS_OF, window_ms, **options)
        return _rounded(
            rows, "total_current_power_kw", "avg_voltage", "avg_power_factor",
            "estimated_daily_kwh", "estimated_monthly_cost_usd",
        )

    return run


def q_floor_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = energy_models.floor_breakdown(_store(spark, sf_dir), AS_OF, WIDE)
    return _rounded(rows, "floor_power_w", "floor_power_kw")


# ---- dashboards --------------------------------------------------------------------


def q_status_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dashboards.status_overview(_store(spark, sf_dir), AS_OF, WIDE)
    metrics = [_round(F.col("readings")[m]).alias(m) for m in METRICS]
    return rows.select(*[c for c in rows.columns if c != "readings"], *metrics)


def _top_devices(window_ms: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = dashboards.anomaly_top_devices(_store(spark, sf_dir), AS_OF, window_ms)
        named = F.transform("anomaly_types", lambda t: F.coalesce(t, F.lit("NULL")))
        text = F.array_join(F.sort_array(named), ",")
        return _rounded(rows.withColumn("anomaly_types", text), "avg_anomaly_score")

    return run


def _heatmap(window_ms: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = dashboards.temperature_heatmap(_store(spark, sf_dir), AS_OF, window_ms)
        return _rounded(rows, "avg_temperature", "min_temperature", "max_temperature")

    return run


def _energy_trend(window_ms: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = energy_models.energy_trend(_store(spark, sf_dir), AS_OF, window_ms)
        return _rounded(rows, "total_power_kw", "cumulative_kwh")

    return run


def _silent(silence_ms: int, **options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dashboards.silent_devices(_store(spark, sf_dir), AS_OF, silence_ms, **options)

    return run


def _vibration(window_ms: int, **options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = dashboards.vibration_trend(_store(spark, sf_dir), AS_OF, window_ms, **options)
        return _rounded(rows, "min_vibration", "max_vibration", "vibration_increase")

    return run


def _quality(window_ms: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = dashboards.data_quality(_store(spark, sf_dir), AS_OF, window_ms)
        return _rounded(rows, "avg_anomaly_score")

    return run


def q_data_quality_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dashboards.data_quality_all(_store(spark, sf_dir), AS_OF, WIDE)
    return _rounded(rows, "avg_anomaly_score")


def q_battery_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.battery_alert(_store(spark, sf_dir), AS_OF, WIDE)


# ---- sensors -----------------------------------------------------------------------


def q_range_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensors.rule_breaches(_store(spark, sf_dir), AS_OF, None)


def q_stuck_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sensors.stuck_sensors(_store(spark, sf_dir), AS_OF, WIDE), "stuck_value")


def q_hourly_sensor_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sensors.hourly_sensor_aggregates(_store(spark, sf_dir), AS_OF, None)
    return _rounded(rows, "avg_value", "min_value", "max_value")


# ---- streams and branches ----------------------------------------------------------


def _scratch(spark: SparkSession) -> Branch:
    """A branch of its own in the folder the cluster shares, until the application ends."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/gaugeflow/{uuid.uuid4().hex}")
    root.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(root)
    return Branch(root.toString())


def _streamed(spark: SparkSession, sf_dir: str, faulty: bool = False) -> DataFrame:
    sent = events.to_messages(events.stream_events(spark, sf_dir), faulty)
    return ingest.gate_messages(sent, AS_OF, LIVE, LIMITS)


def _landed(spark: SparkSession, sf_dir: str, faulty: bool = True) -> Branch:
    branch = _scratch(spark)
    rows = _streamed(spark, sf_dir, faulty)
    ingest.start_dataset_sink(
        rows, branch.landing, branch.checkpoint(), trigger=None
    ).awaitTermination()
    return branch


def q_stream_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages through the streaming sink, then counted from what it wrote."""
    rows = DatasetStore(spark, _landed(spark, sf_dir).landing).rows()
    return rows.groupBy("gate", "reason").agg(F.count("*").alias("row_count"))


def q_published_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed by the stream, audited, compacted and published, then counted."""
    rows = publish(spark, _landed(spark, sf_dir)).rows()
    date = F.col("event_date").cast("string").alias("event_date")
    return rows.groupBy(date, "gate").agg(F.count("*").alias("row_count"))


def q_stream_hourly_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hour as the stream has folded it, batch by batch, while it landed the messages."""
    branch = _scratch(spark)
    sent = f"{branch.root}/messages"
    _messages(spark, sf_dir).repartition(4 * DELIVERIES).write.parquet(sent)
    arriving = messages.file_messages(spark, sent, max_files_per_trigger=4)
    ingest.start_dataset_sink(
        ingest.gate_messages(arriving, AS_OF, LIVE, LIMITS), branch.landing, branch.checkpoint(),
        trigger=None, write_tasks=4, hours=branch.rollup,
    ).awaitTermination()
    return _rounded(rollup.hours(spark, branch.rollup), "avg_value", "min_value", "max_value")


# ---- catalog tables ----------------------------------------------------------------


def _namespace(spark: SparkSession, branch: Branch) -> str:
    """A namespace of its own, with its tables among the branch's folders."""
    name = f"gaugeflow_{uuid.uuid4().hex}"
    tables.create_namespace(spark, name, f"{branch.root}/tables")
    return name


def q_table_sink_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages through the streaming sink of separate tables, then counted from those."""
    branch = _scratch(spark)
    namespace = _namespace(spark, branch)
    tables.create_tables(spark, namespace)
    ingest.start_table_sink(
        _streamed(spark, sf_dir, faulty=True), namespace, branch.checkpoint("tables"), trigger=None
    ).awaitTermination()
    store = TableStore(spark, namespace)
    parts = [
        ("raw_telemetry", store.raw(), "device_type"),
        ("validated_telemetry", store.validated(), "device_type"),
        ("anomaly_alerts", store.anomalies(), "device_type"),
        ("dead_letter_queue", store.dead_letters(), "gate"),
    ]
    counted = [
        rows.groupBy(F.lit(name).alias("table_name"), F.col(kind).alias("kind")).agg(
            F.count("*").alias("row_count")
        )
        for name, rows, kind in parts
    ]
    return functools.reduce(DataFrame.unionByName, counted)


# One count of each model.
MODEL_COUNTS = {
    "device_summary_simple": "total_readings",
    "device_metrics_latest": "battery_level",
    "device_health_summary": "health_score",
    "building_energy_dashboard": "meter_count",
    "hourly_sensor_aggregates": "reading_count",
}


def q_materialised_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All models refreshed as tables, twice over, then rows and a sum of each table."""
    namespace = _namespace(spark, _scratch(spark))
    for _ in range(2):
        run_models(spark, _store(spark, sf_dir), namespace, AS_OF)
    found = [
        spark.read.table(f"{namespace}.{model}").agg(
            F.lit(model).alias("model"),
            F.count("*").alias("row_count"),
            F.sum(count).cast("bigint").alias("total"),
        )
        for model, count in MODEL_COUNTS.items()
    ]
    return functools.reduce(DataFrame.unionByName, found)


def _incremental(name: str) -> Query:
    """A model refreshed after each of several deliveries, never from scratch."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        branch = _scratch(spark)
        sent = f"{branch.root}/messages"
        delivery = F.pmod(F.col("offset"), F.lit(3)).cast("int").alias("delivery")
        messages_ = _messages(spark, sf_dir).select("*", delivery)
        for number in range(3):
            arrived = messages_.filter(F.col("delivery") == number).drop("delivery")
            arrived.write.mode("append").parquet(sent)
            ingest.start_dataset_sink(
                ingest.gate_messages(messages.file_messages(spark, sent), AS_OF, LIVE, LIMITS),
                branch.landing, branch.checkpoint(), trigger=None, write_tasks=4,
            ).awaitTermination()
            incremental.refresh(spark, branch, name, buckets=8)
        return incremental.result(spark, branch, name)

    return run


def q_batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger says was landed, summed over the batches."""
    report = ledger.report(spark, _landed(spark, sf_dir).landing)
    counts = [c for c in report.columns if c not in ("stream", "batch", "first_ms", "last_ms")]
    return report.agg(
        *[F.sum(c).alias(c) for c in counts],
        F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"),
    )


# ---- contract ----------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Messages to gates to device health on the smallest data."""
    gated = _gated_messages(spark, "/root/testdata/sf0.001")
    return device_models.device_health(FrameStore(gated), AS_OF, WIDE)


def _training_data(name: str) -> dict:
    """What the training-data queries add to ``queries`` or ``oracle_sql``, where installed."""
    try:
        operators = importlib.import_module("gaugeflow.llm.queries")
        pipeline = importlib.import_module("corpus_pipeline")
    except ModuleNotFoundError as missing:
        # Anything else that is missing is an error.
        if missing.name not in ("gaugeflow.llm", "gaugeflow.llm.queries", "corpus_pipeline"):
            raise
        return {}
    return getattr(operators, name)() | getattr(pipeline, name)()


def queries() -> dict[str, Query]:
    """Every query by name."""
    own: dict[str, Query] = {
        "q_envelope_parse": q_envelope_parse,
        "q_encode_roundtrip": q_encode_roundtrip,
        "q_route_counts": q_route_counts,
        "q_route_counts_7d": q_route_counts_7d,
        "q_gate_schema": q_gate_schema,
        "q_gate_anomaly": q_gate_anomaly,
        "q_gate_time_bounds": q_gate_time_bounds,
        "q_validated": q_validated,
        "q_anomalies": q_anomalies,
        "q_anomaly_score": q_anomaly_score,
        "q_raw_audit": q_raw_audit,
        "q_dead_letter": q_dead_letter,
        "q_contract_violations": q_contract_violations,
        "q_contract_versions": q_contract_versions,
        "q_map_extract": q_map_extract,
        "q_trailing_window": q_trailing_window,
        "q_distinct_struct": q_distinct_struct,
        "q_sql_views": q_sql_views,
        "q_device_summary": q_device_summary,
        "q_device_metrics_latest": q_device_metrics_latest,
        "q_device_health": _health(WIDE),
        "q_device_health_24h": _health(DAY_MS),
        "q_building_energy": _building(WIDE),
        "q_building_energy_1h": _building(HOUR_MS),
        "q_building_energy_zero": _building(WIDE, count_missing_as_zero=True),
        "q_floor_breakdown": q_floor_breakdown,
        "q_status_overview": q_status_overview,
        "q_anomaly_top_devices": _top_devices(WIDE),
        "q_anomaly_top_devices_24h": _top_devices(DAY_MS),
        "q_temperature_heatmap": _heatmap(WIDE),
        "q_temperature_heatmap_1h": _heatmap(HOUR_MS),
        "q_energy_trend": _energy_trend(WIDE),
        "q_energy_trend_24h": _energy_trend(DAY_MS),
        "q_silent_devices": _silent(DAY_MS),
        "q_silent_devices_1h": _silent(HOUR_MS),
        "q_silent_devices_latest": _silent(DAY_MS, latest_only=True),
        "q_vibration_trend": _vibration(WIDE),
        "q_vibration_trend_24h": _vibration(DAY_MS),
        "q_vibration_trend_signed": _vibration(WIDE, signed=True),
        "q_data_quality": _quality(WIDE),
        "q_data_quality_24h": _quality(DAY_MS),
        "q_data_quality_all": q_data_quality_all,
        "q_battery_alert": q_battery_alert,
        "q_range_rules": q_range_rules,
        "q_stuck_sensors": q_stuck_sensors,
        "q_hourly_sensor_aggregates": q_hourly_sensor_aggregates,
        "q_stream_route_counts": q_stream_route_counts,
        "q_published_dates": q_published_dates,
        "q_stream_hourly_aggregates": q_stream_hourly_aggregates,
        "q_table_sink_routes": q_table_sink_routes,
        "q_materialised_models": q_materialised_models,
        "q_incremental_summary": _incremental("device_summary_simple"),
        "q_incremental_latest": _incremental("device_metrics_latest"),
        "q_batch_report": q_batch_report,
    }
    return own | _training_data("queries")


def oracle_sql() -> dict[str, str]:
    """The same results as DuckDB SQL over the same tables."""
    from oracle_queries import oracle_sql as sql

    return sql() | _training_data("oracle_sql")
