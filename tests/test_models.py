"""Rules of the models on small hand-made tables."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from gaugeflow import schemas
from gaugeflow.functions.clock import DAY_MS, HOUR_MS, midnight, utc_seconds
from gaugeflow.operators import sensors
from gaugeflow.plans import dashboards, device_models, energy_models
from gaugeflow.sources.stores import FrameStore

NOW = 1_700_000_000_000


def row(device="d1", kind="temperature_sensor", at=NOW, gate="PASSED", eid=None, readings=None,
        building="B1", floor=1, zone="A", firmware="1", signal=90, battery=90, score=None,
        anomaly_type=None):
    place = None if building is None else (building, floor, zone)
    metadata = (place, firmware, signal, battery, None, anomaly_type, None, None)
    status = {"PASSED": "PASSED", "ANOMALY": "ANOMALY_DETECTED"}.get(gate)
    default = {"PASSED": 0.0, "ANOMALY": 0.8}.get(gate)
    return (
        eid or f"{device}-{at}-{kind}", device, kind, at,
        readings if readings is not None else {"temperature": 20.0, "humidity": 40.0},
        metadata, status, default if score is None else score, "SPARK_RULES", gate,
    )


def store(spark, *rows):
    schema = schemas.quality().add("gate", T.StringType())
    return FrameStore(spark.createDataFrame(list(rows), schema))


def collect(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def health(spark, *rows, **options):
    return {r["device_id"]: r for r in collect(device_models.device_health(store(spark, *rows), NOW, **options))}


def test_health_ladder(spark):
    def anomalies(device, n):
        return [row(device, gate="ANOMALY", at=NOW - i, score=1.0) for i in range(n)]

    got = health(
        spark,
        row("flat", battery=19), *anomalies("flat", 11),
        row("broken"), *anomalies("broken", 11),
        row("weak", signal=59), *anomalies("weak", 6),
        row("flaky"), *anomalies("flaky", 6),
        row("half", battery=49), *anomalies("half", 5),
        row("fine", battery=50, signal=60), *anomalies("fine", 5),
        row("mains", battery=None),
        *anomalies("only-anomalies", 3),
    )
    assert {d: r["health_score"] for d, r in got.items()} == {
        "flat": 0, "broken": 20, "weak": 40, "flaky": 60, "half": 80, "fine": 100, "mains": 100,
    }
    assert got["flat"]["maintenance_recommendation"] == "URGENT: Replace battery"
    assert got["broken"]["maintenance_recommendation"] == "URGENT: Device malfunction"
    assert got["weak"]["maintenance_recommendation"] == "Check connectivity"
    assert got["flaky"]["maintenance_recommendation"] == "Schedule inspection"
    assert got["half"]["maintenance_recommendation"] == "Plan battery replacement"
    assert got["mains"]["maintenance_recommendation"] == "Healthy"
    assert (got["mains"]["anomaly_count_24h"], got["mains"]["max_anomaly_score"]) == (0, 0.0)
    assert got["flaky"]["max_anomaly_score"] == 1.0


def test_health_of_a_device_with_two_types(spark):
    """Both rows show the newest row's type and place, each with its own metrics."""
    rows = collect(device_models.device_health(store(
        spark,
        row("d", "temperature_sensor", at=NOW - 5, building="old"),
        row("d", "temperature_sensor", at=NOW - 4, building="old"),
        row("d", "energy_meter", at=NOW - 3, building="new", battery=None),
    ), NOW))
    assert sorted(r["total_readings_24h"] for r in rows) == [1, 2]
    assert {(r["device_type"], r["building"]) for r in rows} == {("energy_meter", "new")}


def test_health_leaves_out_rows_without_a_device(spark):
    assert set(health(spark, row("d"), row(None, eid="e"))) == {"d"}


def test_anomalies_count_for_the_device_not_the_type(spark):
    rows = [row("d", "energy_meter", at=NOW - i, gate="ANOMALY") for i in range(11)]
    assert health(spark, row("d"), *rows)["d"]["health_score"] == 20


def test_health_window_has_a_closed_start_and_no_end(spark):
    got = health(spark, row("edge", at=NOW - DAY_MS), row("out", at=NOW - DAY_MS - 1),
                 row("ahead", at=NOW + HOUR_MS))
    assert set(got) == {"edge", "ahead"}


def test_latest_breaks_ties_by_event_id(spark):
    rows = collect(device_models.device_metrics_latest(store(
        spark,
        row(eid="e1", battery=1), row(eid="e9", battery=9), row(eid="e5", battery=5),
        row("v", "vibration_sensor", readings={"vibration_x": 0.5}),
        row("p", "pressure_sensor", readings={"pressure": 1001.0, "temperature": 2.0}),
        row("m", "energy_meter", readings={"power": 10.0, "voltage": 230.5}),
        row("x", "door", readings={}),
        row("h", readings={"temperature": 20.0}),
    )))
    by = {r["device_id"]: r for r in rows}
    assert by["d1"]["battery_level"] == 9
    assert {d: r["latest_readings"] for d, r in by.items()} == {
        "d1": "Temp: 20.0°C, Humidity: 40.0%",
        "v": "Vibration X: 0.5",
        "p": "Pressure: 1001.0 hPa",
        "m": "Power: 10.0 W, Voltage: 230.5 V",
        "x": "N/A",
        "h": None,
    }
    assert str(by["d1"]["last_reading_time"]) == "2023-11-14 22:13:20"


def test_device_summary_counts_utc_days(spark):
    start = midnight(NOW)
    rows = collect(device_models.device_summary(store(
        spark, row(at=start - 1), row(at=start), row(at=start + 5), row(at=start + DAY_MS - 1),
        row(at=start, gate="ANOMALY"),
    )))
    assert rows == [{
        "device_id": "d1", "device_type": "temperature_sensor", "total_readings": 4,
        "first_seen": start - 1, "last_seen": start + DAY_MS - 1, "active_days": 2,
    }]


def meter(device, building, power=1000.0, factor=0.97, at=NOW, floor=1, gate="PASSED"):
    readings = {"power": power, "voltage": 230.0, "current": 4.0, "power_factor": factor}
    return row(device, "energy_meter", at, gate, readings=readings, building=building, floor=floor,
               battery=None)


def buildings(spark, *rows, **options):
    return {r["building"]: r for r in collect(energy_models.building_energy(store(spark, *rows), NOW, **options))}


@pytest.mark.parametrize("zero, best", [(False, 40), (True, 100)])
def test_building_score_without_anomalies(spark, zero, best):
    got = buildings(spark, meter("a", "B1"), count_missing_as_zero=zero)
    assert got["B1"]["efficiency_score"] == best
    assert got["B1"]["energy_anomalies_today"] == 0
    assert got["B1"]["recommendation"] == "Operating normally"


def test_building_steps(spark):
    def bad(building, n):
        return [meter("a", building, at=NOW - i, gate="ANOMALY") for i in range(n)]

    got = buildings(
        spark,
        meter("a", "two"), *bad("two", 2),
        meter("a", "five", factor=0.86), *bad("five", 5),
        meter("a", "six", factor=0.86), *bad("six", 6),
        meter("a", "low", factor=0.80), *bad("low", 9),
        meter("a", "big", power=600_000.0), *bad("big", 1),
        meter("a", None), *bad(None, 7),
        meter("a", "yesterday"), meter("a", "yesterday", at=midnight(NOW) - 1, gate="ANOMALY"),
        row("t", building="two", gate="ANOMALY"),
    )
    assert {b: (r["efficiency_score"], r["energy_anomalies_today"]) for b, r in got.items()} == {
        "two": (80, 2), "five": (60, 5), "six": (40, 6), "low": (40, 9), "big": (80, 1),
        None: (40, 0), "yesterday": (40, 0),
    }
    assert got["six"]["recommendation"] == "Investigate voltage irregularities"
    assert got["low"]["recommendation"] == "Install power factor correction equipment"
    assert got["big"]["recommendation"] == "Consider load balancing"


def test_building_figures(spark):
    got = buildings(
        spark, meter("a", "B1", power=1000.0), meter("a", "B1", power=3000.0, at=NOW - 1),
        meter("b", "B1", power=4000.0, floor=2), meter("old", "B1", at=NOW - HOUR_MS - 1),
    )["B1"]
    assert got["meter_count"] == 2
    assert got["total_current_power_kw"] == pytest.approx(6.0)
    assert got["estimated_daily_kwh"] == pytest.approx(144.0)
    assert got["estimated_monthly_cost_usd"] == pytest.approx(6 * 24 * 30 * 0.12)
    floors = collect(energy_models.floor_breakdown(
        store(spark, meter("a", "B1"), meter("b", "B1", power=500.0), meter("c", "B1", floor=2)), NOW
    ))
    assert {(f["floor"], f["meter_count"], f["floor_power_w"]) for f in floors} == {
        (1, 2, 1500.0), (2, 1, 1000.0),
    }


def test_anomaly_types_keep_null_and_ties_are_ordered(spark):
    rows = [row(d, gate="ANOMALY", at=NOW - i, anomaly_type=t)
            for d in ("b", "a") for i, t in enumerate(["spike", None, "drop", "spike"])]
    rows += [row("c", gate="ANOMALY", at=NOW - i, score=1.0) for i in range(5)]
    got = collect(dashboards.anomaly_top_devices(store(spark, *rows), NOW, limit=2))
    assert [r["device_id"] for r in got] == ["c", "a"]
    assert got[1]["anomaly_types"] == [None, "drop", "spike"]
    assert got[0]["anomaly_types"] == [None]
    assert got[0]["avg_anomaly_score"] == 1.0


def test_heatmap_sorts_nulls_last(spark):
    got = collect(dashboards.temperature_heatmap(store(
        spark, row(building=None), row(building="B2"), row(building="B1", floor=2),
        row(building="B1", floor=None), row(building="B1", floor=1),
        row(building="B0", readings={"humidity": 40.0}),
    ), NOW))
    assert [(r["building"], r["floor"]) for r in got] == [
        ("B1", 1), ("B1", 2), ("B1", None), ("B2", 1), (None, None),
    ]


def test_silent_devices_fan_out(spark):
    long_ago = NOW - 2 * HOUR_MS
    data = store(
        spark, row("quiet", at=long_ago, signal=1), row("quiet", at=long_ago - 1, signal=2),
        row("quiet", at=long_ago - 2, signal=2), row("edge", at=NOW - HOUR_MS),
        row("heard", at=long_ago), row("heard", at=NOW, gate="SCHEMA"),
        row("never-passed", at=long_ago, gate="ANOMALY"),
    )
    got = collect(dashboards.silent_devices(data, NOW))
    assert [(r["device_id"], r["silence_duration_ms"]) for r in got] == [("quiet", 2 * HOUR_MS)] * 2
    assert len(collect(dashboards.silent_devices(data, NOW, latest_only=True))) == 1


def shake(device, hours_ago, x):
    return row(device, "vibration_sensor", at=NOW - hours_ago * HOUR_MS,
               readings={"vibration_x": x, "vibration_y": 0.0, "vibration_z": 0.0})


def test_vibration_trend(spark):
    data = store(spark, shake("up", 3, 0.1), shake("up", 1, 1.0), shake("down", 3, 1.0),
                 shake("down", 1, 0.1), shake("slight", 3, 0.1), shake("slight", 1, 0.5),
                 shake("still", 3, 0.1), shake("still", 1, 0.3))
    plain = {r["device_id"]: r["trend"] for r in collect(dashboards.vibration_trend(data, NOW))}
    assert plain == {"up": "INCREASING", "down": "INCREASING", "slight": "STABLE"}
    signed = {r["device_id"]: r["trend"]
              for r in collect(dashboards.vibration_trend(data, NOW, signed=True))}
    assert signed == {"up": "INCREASING", "down": "DECREASING", "slight": "STABLE"}


def test_energy_trend_runs_up_per_building(spark):
    got = collect(energy_models.energy_trend(store(
        spark, meter("a", "B1", at=NOW - HOUR_MS), meter("b", "B1", at=NOW),
        meter("c", "B1", at=NOW), meter("d", None, at=NOW),
    ), NOW))
    assert [(r["building"], r["total_power_kw"], r["cumulative_kwh"]) for r in got] == [
        ("B1", 1.0, 1.0), ("B1", 2.0, 3.0), (None, 1.0, 1.0),
    ]


def test_quality_battery_and_overview(spark):
    data = store(spark, row("a", battery=29, at=NOW - 2), row("b", battery=30, at=NOW - 1),
                 row("c", battery=5), row("d", battery=None), row("e", gate="ANOMALY"),
                 row("f", gate="INDETERMINATE"))
    low = collect(dashboards.battery_alert(data, NOW))
    assert [r["device_id"] for r in low] == ["c", "a"]
    assert len(collect(dashboards.battery_alert(data, NOW, limit=1))) == 1
    quality = collect(dashboards.data_quality(data, NOW))
    assert [(r["quality_status"], r["record_count"], r["device_count"]) for r in quality] == [
        ("PASSED", 4, 4),
    ]
    everything = collect(dashboards.data_quality_all(data, NOW))
    assert {r["gate"]: r["record_count"] for r in everything} == {
        "PASSED": 4, "ANOMALY": 1, "INDETERMINATE": 1,
    }
    newest = collect(dashboards.status_overview(data, NOW, limit=2))
    assert [r["device_id"] for r in newest] == ["d", "c"]
    assert newest[0]["readings"] == {"temperature": 20.0, "humidity": 40.0}


def test_a_broken_clock_does_not_break_reports(spark):
    data = store(spark, row(at=2**63 - 1, gate="ANOMALY"), row(at=NOW, gate="ANOMALY"))
    (anomaly,) = collect(dashboards.data_quality_all(data, NOW))
    assert anomaly["record_count"] == 2 and anomaly["last_occurrence"] is None


def test_stuck_and_hourly(spark):
    data = store(spark, *[row(at=NOW - i, readings={"temperature": 20.0, "humidity": float(i)})
                          for i in range(5)], row("other", at=NOW))
    stuck = collect(sensors.stuck_sensors(data, NOW))
    assert [(r["device_id"], r["metric"], r["stuck_value"], r["reading_count"]) for r in stuck] == [
        ("d1", "temperature", 20.0, 5),
    ]
    assert not collect(sensors.stuck_sensors(data, NOW, min_readings=6))
    hours = {(r["device_id"], r["metric"]): r for r in collect(sensors.hourly_sensor_aggregates(data, NOW))}
    assert hours["d1", "humidity"]["avg_value"] == 2.0
    assert (hours["d1", "humidity"]["min_value"], hours["d1", "humidity"]["max_value"]) == (0.0, 4.0)
    assert str(hours["d1", "humidity"]["hour"]) == "2023-11-14 22:00:00"


def test_declared_rules_catch_what_live_rules_do_not(spark):
    data = store(spark, meter("a", "B1", power=-1.0, factor=0.5),
                 row("p", "pressure_sensor", readings={"pressure": 1001.0, "temperature": 99.0}))
    got = {(r["device_type"], r["metric"]): r["breach_count"]
           for r in collect(sensors.rule_breaches(data, NOW))}
    assert got == {("energy_meter", "power"): 1, ("energy_meter", "power_factor"): 1,
                   ("pressure_sensor", "temperature"): 1}


def test_utc_seconds_truncates_in_any_session_zone(spark):
    ms = spark.createDataFrame([(NOW + 999,), (2**63 - 1,), (None,)], "ms bigint")
    got = [r[0] for r in ms.select(utc_seconds("ms").cast("string")).collect()]
    assert got == ["2023-11-14 22:13:20", None, None]


def test_views_answer_sql(spark):
    store(spark, row(), row(gate="ANOMALY"), row(gate="SCHEMA")).register_views()
    for view, n in (("raw_telemetry", 3), ("validated_telemetry", 1), ("anomaly_alerts", 1)):
        assert spark.sql(f"SELECT count(*) FROM {view}").first()[0] == n
    assert spark.sql(
        "SELECT metadata.location.building, readings['temperature'] FROM validated_telemetry"
    ).first() == ("B1", 20.0)
