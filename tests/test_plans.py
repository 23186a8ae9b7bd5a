"""Physical plans: what must be pushed down, pruned, reduced early or absent."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from gaugeflow.functions.clock import DAY_MS
from gaugeflow.operators import gates
from gaugeflow.operators import sensors
from gaugeflow.plans import dashboards, device_models, energy_models
from gaugeflow.plans.registry import DASHBOARDS, MODELS
from gaugeflow.sources import events
from gaugeflow.sources.messages import parse_envelope
from gaugeflow.sources.stores import DatasetStore
from gaugeflow.streaming import ingest

NOW = events.AS_OF_MS


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def dataset(spark, tiny, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("data") / "gated")
    messages = events.to_messages(events.read_events(spark, tiny))
    limits = contract.LIMITS
    rows = ingest.gate_messages(messages, NOW, limits=limits)
    rows.write.partitionBy("event_date", "gate").parquet(path)
    return DatasetStore(spark, path)


# Training-data queries have tests of their own.
@pytest.mark.parametrize("name", sorted(n for n in contract.queries() if n.startswith("q_")))
def test_no_python_and_no_cross_join(spark, tiny, name):
    text = plan(contract.queries()[name](spark, tiny))
    for banned in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in text


@pytest.mark.parametrize("name", ["device_health_summary", "building_energy_dashboard",
                                  "hourly_sensor_aggregates"])
def test_windowed_models_prune_partitions(dataset, name):
    # As a model it covers all history; its operator has a window, as the other models have.
    windowed = MODELS | {"hourly_sensor_aggregates": sensors.hourly_sensor_aggregates}
    scans = [s for s in plan(windowed[name](dataset, NOW)).splitlines() if "FileScan" in s]
    assert scans
    for scan in scans:
        assert "event_date" in scan.split("PartitionFilters: [")[1].split("]")[0]
        assert "GreaterThanOrEqual(timestamp" in scan


def test_dashboards_read_only_their_columns(dataset):
    def schema(name):
        rows = DASHBOARDS[name](dataset, NOW)
        mode = rows.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(
            "formatted"
        )
        text = rows._jdf.queryExecution().explainString(mode)
        return re.findall(r"ReadSchema: (struct<.*>)", text)

    (quality,) = schema("data_quality")
    assert "readings" not in quality and "metadata" not in quality
    (battery,) = schema("battery_alert")
    assert "firmware_version" not in battery and "readings" not in battery
    for scan in schema("silent_devices"):
        assert "readings" not in scan


def test_health_is_one_scan_without_a_join(dataset):
    text = plan(device_models.device_health(dataset, NOW))
    assert text.count("FileScan") == 1 and "Join" not in text


def test_latest_reduces_before_the_shuffle(dataset):
    text = plan(device_models.device_metrics_latest(dataset))
    shuffle = text.index("Exchange hashpartitioning(device_id")
    assert "WindowGroupLimit" in text[shuffle:]
    health = plan(device_models.device_health(dataset, NOW))
    assert "partial_max_by" in health[health.rindex("Exchange hashpartitioning(device_id") :]


def test_top_k_does_not_sort_everything(dataset):
    for name in ("status_overview", "battery_alert", "anomaly_top_devices"):
        assert "TakeOrderedAndProject" in plan(DASHBOARDS[name](dataset, NOW))


def test_filters_never_repeat_the_parse_or_the_gate(spark, tiny):
    messages = events.to_messages(events.read_events(spark, tiny))
    gated = gates.classify(parse_envelope(messages), NOW)
    text = plan(gated.filter("gate = 'PASSED' AND device_type = 'energy_meter'"))
    assert text.count("from_json") == 1
    assert text.count("[vibration_z]") == 2  # one test per bound, in one place


def test_time_bound_reaches_the_events_scan(spark, tiny):
    text = plan(contract.queries()["q_energy_trend_24h"](spark, tiny))
    assert "GreaterThanOrEqual(ts," in text


def test_running_sum_works_on_hours(dataset):
    text = plan(energy_models.energy_trend(dataset, NOW, 30 * DAY_MS))
    window = text.index("Window [")
    assert text.index("HashAggregate") > window


def test_anomaly_types_are_counted_before_they_are_collected(dataset):
    text = plan(dashboards.anomaly_top_devices(dataset, NOW))
    collected = text.rindex("partial_collect_set")
    assert "Exchange hashpartitioning(device_id" in text[collected:]
    assert "HashAggregate" in text[collected:]


def test_distinct_metadata_is_reduced_before_the_shuffle(dataset):
    text = plan(dashboards.silent_devices(dataset, NOW))
    assert text.count("Exchange hashpartitioning(device_id#") >= 2
