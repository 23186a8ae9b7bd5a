"""The materialised models, and running them as one job."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from gaugeflow.functions.clock import resolve
from gaugeflow.operators.sensors import hourly_sensor_aggregates
from gaugeflow.plans import dashboards, device_models, energy_models
from gaugeflow.sources.stores import TelemetryStore
from gaugeflow.tables import create_namespace, materialise

MODELS_NAMESPACE = "dbt_models"

Plan = Callable[[TelemetryStore, int], DataFrame]

MODELS: dict[str, Plan] = {
    "device_summary_simple": lambda store, as_of: device_models.device_summary(store),
    "device_metrics_latest": lambda store, as_of: device_models.device_metrics_latest(store),
    "device_health_summary": device_models.device_health,
    "building_energy_dashboard": energy_models.building_energy,
    # All history: a refresh replaces the table, so a window would drop older hours.
    "hourly_sensor_aggregates": lambda store, as_of: hourly_sensor_aggregates(store, as_of, None),
}

DASHBOARDS: dict[str, Plan] = {
    "status_overview": dashboards.status_overview,
    "anomaly_top_devices": dashboards.anomaly_top_devices,
    "temperature_heatmap": dashboards.temperature_heatmap,
    "energy_trend": energy_models.energy_trend,
    "silent_devices": dashboards.silent_devices,
    "vibration_trend": dashboards.vibration_trend,
    "data_quality": dashboards.data_quality,
    "battery_alert": dashboards.battery_alert,
}


def run_models(
    spark: SparkSession,
    store: TelemetryStore,
    namespace: str = MODELS_NAMESPACE,
    as_of_ms: int | None = None,
    names: Iterable[str] | None = None,
    file_format: str = "parquet",
) -> list[str]:
    """Rebuild the tables of all or some models, all for the same instant."""
    chosen = list(MODELS) if names is None else list(names)
    unknown = sorted(set(chosen) - set(MODELS))
    if unknown:
        raise KeyError(f"no such model: {', '.join(unknown)}")
    as_of = resolve(as_of_ms)
    create_namespace(spark, namespace)
    for name in chosen:
        materialise(MODELS[name](store, as_of), f"{namespace}.{name}", file_format)
    return chosen
