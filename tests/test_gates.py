"""Truth table of the gates, on message text as devices send it."""

from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeflow import schemas
from gaugeflow.functions.clock import DAY_MS, HOUR_MS
from gaugeflow.operators import dead_letter, gates
from gaugeflow.sources.messages import parse_envelope
from gaugeflow.streaming.ingest import gate_messages

NOW = 1_700_000_000_000
GOOD = {
    "event_id": "e",
    "device_id": "d",
    "device_type": "temperature_sensor",
    "timestamp": NOW,
    "readings": {"temperature": 20.0, "humidity": 40.0},
    "metadata": {"location": {"building": "B", "floor": 1, "zone": "A"}},
}


def but(**changes) -> str:
    return json.dumps({k: v for k, v in (GOOD | changes).items() if v != "absent"})


def readings(kind: str, **values) -> str:
    return but(device_type=kind, readings=values)


def meter(voltage=230.0, power=1.0) -> str:
    return readings("energy_meter", voltage=voltage, power=power)


CASES = [
    # name, message text, gate, score
    ("in range", but(), "PASSED", 0.0),
    (
        "out of range and flagged",
        but(readings={"temperature": 99.0, "humidity": 40.0}, metadata={"anomaly_detected": True}),
        "ANOMALY",
        1.0,
    ),
    ("out of range", but(readings={"temperature": 99.0, "humidity": 40.0}), "ANOMALY", 0.8),
    ("ids missing", but(event_id="absent", device_type="absent"), "SCHEMA", None),
    ("event id null", but(event_id=None), "SCHEMA", None),
    ("mistyped", but(timestamp="not-a-timestamp", readings="not-a-dict"), "INDETERMINATE", None),
    ("metric outside readings", but(readings="absent", temperature=25.0), "INDETERMINATE", None),
    ("readings empty", but(readings={}), "INDETERMINATE", None),
    ("metric null", but(readings={"temperature": None}), "INDETERMINATE", None),
    ("null beside a bad metric", but(readings={"temperature": None, "humidity": 99}), "ANOMALY", 0.8),
    ("one hour ahead", but(timestamp=NOW + HOUR_MS), "PASSED", 0.0),
    ("more than one hour ahead", but(timestamp=NOW + HOUR_MS + 1), "ANOMALY", 0.8),
    ("seven days old", but(timestamp=NOW - 7 * DAY_MS), "PASSED", 0.0),
    ("more than seven days old", but(timestamp=NOW - 7 * DAY_MS - 1), "ANOMALY", 0.8),
    ("old with empty readings", but(readings={}, timestamp=0), "ANOMALY", 0.8),
    ("broken clock", but(timestamp=9_223_372_036_854_775_807), "ANOMALY", 0.8),
    ("broken clock, past", but(timestamp=-9_223_372_036_854_775_808), "ANOMALY", 0.8),
    ("time missing", but(timestamp="absent"), "INDETERMINATE", None),
    ("time missing, bad metric", but(timestamp=None, readings={"temperature": 99}), "ANOMALY", 0.8),
    ("unknown type", but(device_type="door", readings={}), "PASSED", 0.0),
    ("type missing", but(device_type="absent"), "INDETERMINATE", None),
    ("undeclared key", but(extra=[1, 2]), "PASSED", 0.0),
    ("low end", but(readings={"temperature": 18.0, "humidity": 30}), "PASSED", 0.0),
    ("high end", but(readings={"temperature": 25.0, "humidity": 60}), "PASSED", 0.0),
    ("below", but(readings={"temperature": 17.99, "humidity": 30}), "ANOMALY", 0.8),
    ("pressure, hot", readings("pressure_sensor", pressure=1000, temperature=99), "PASSED", 0.0),
    ("pressure high", readings("pressure_sensor", pressure=1020.1), "ANOMALY", 0.8),
    (
        "vibration ends",
        readings("vibration_sensor", vibration_x=-2, vibration_y=2, vibration_z=0),
        "PASSED",
        0.0,
    ),
    (
        "vibration out",
        readings("vibration_sensor", vibration_x=0, vibration_y=0, vibration_z=-2.1),
        "ANOMALY",
        0.8,
    ),
    ("meter", meter(), "PASSED", 0.0),
    ("meter, negative power", meter(power=-5.0), "PASSED", 0.0),
    ("meter overload", meter(power=7000.5), "ANOMALY", 0.8),
    ("meter voltage", meter(voltage=219.9), "ANOMALY", 0.8),
    ("not json", "hello", "SCHEMA", None),
    ("cut off", but()[:-4], "SCHEMA", None),
    ("empty", "", "SCHEMA", None),
    ("no value", None, "SCHEMA", None),
]


def to_messages(spark, texts):
    rows = [
        (b"d", None if t is None else t.encode(), "t", 0, i) for i, t in enumerate(texts)
    ]
    plain = spark.createDataFrame(
        rows, "key binary, value binary, topic string, partition int, offset bigint"
    )
    return plain.withColumn("timestamp", F.timestamp_seconds(F.lit(NOW / 1000)))


@pytest.fixture(scope="module")
def judged(spark):
    rows = gate_messages(to_messages(spark, [c[1] for c in CASES]), NOW).collect()
    return {row.offset: row for row in rows}


@pytest.mark.parametrize("i", range(len(CASES)), ids=[c[0] for c in CASES])
def test_truth_table(judged, i):
    _, _, gate, score = CASES[i]
    row = judged[i]
    assert (row.gate, row.anomaly_score) == (gate, score)
    status = {"PASSED": "PASSED", "ANOMALY": "ANOMALY_DETECTED"}.get(gate)
    assert row.quality_status == status
    assert row.validation_method == ("SPARK_RULES" if status else None)
    rejected = gate in ("SCHEMA", "INDETERMINATE")
    assert (row.reason is not None) == rejected
    assert row.value == (CASES[i][1] if rejected else None)


def test_gates_are_disjoint_and_exhaustive(spark, judged):
    gated = gate_messages(to_messages(spark, [c[1] for c in CASES]), NOW)
    parts = [gates.passed_rows(gated), gates.anomaly_rows(gated), dead_letter.dead_letters(gated)]
    assert sum(p.count() for p in parts) == gates.raw_rows(gated).count() == len(CASES)


def test_gates_equal_the_two_plain_filters(spark):
    """PASSED and ANOMALY hold exactly the rows that filter(~c) and filter(c) keep."""
    rows = parse_envelope(to_messages(spark, [c[1] for c in CASES]))
    valid = rows.filter(F.col("event_id").isNotNull())
    c = gates.is_anomalous(gates.fixed_clock(NOW))
    gated = gates.classify(rows, NOW)
    for gate, plain in (("PASSED", valid.filter(~c)), ("ANOMALY", valid.filter(c))):
        kept = gated.filter(F.col("gate") == gate)
        assert {r.offset for r in kept.collect()} == {r.offset for r in plain.collect()}


def test_event_dates_are_bounded(judged):
    by_name = {c[0]: judged[i].event_date.isoformat() for i, c in enumerate(CASES)}
    assert by_name["in range"] == "2023-11-14"
    assert by_name["time missing"] == "2023-11-14"
    assert by_name["broken clock"] == gates.DATE_FUTURE
    # By the day of arrival, counted from DATE_PAST as that day is from 1970.
    assert by_name["more than seven days old"] == "0054-11-14" and gates.is_far_off("0054-11-14")
    assert by_name["seven days old"] == "2023-11-07"


def test_batch_and_declared_schema_agree(spark):
    rows = gate_messages(to_messages(spark, [but()]), NOW)
    assert rows.columns == schemas.gated().names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in schemas.gated()]


value = st.one_of(st.none(), st.floats(-1e4, 1e4), st.sampled_from([18.0, 25.0, 220.0, 7000.0]))
metric = st.sampled_from(
    ["temperature", "humidity", "pressure", "vibration_x", "voltage", "power", "other"]
)
message = st.fixed_dictionaries(
    {
        "event_id": st.sampled_from(["e", None]),
        "device_type": st.sampled_from(
            ["temperature_sensor", "pressure_sensor", "vibration_sensor", "energy_meter", "x", None]
        ),
        "timestamp": st.one_of(st.none(), st.integers(NOW - 8 * DAY_MS, NOW + 2 * HOUR_MS)),
        "readings": st.one_of(st.none(), st.dictionaries(metric, value)),
    }
)


def three_or(*parts):
    if True in parts:
        return True
    return None if None in parts else False


def three_and(a, b):
    if False in (a, b):
        return False
    return None if None in (a, b) else True


def less(a, b):
    return None if a is None or b is None else a < b


def expected_gate(m) -> str:
    """The same rules, one message at a time, in three-valued logic."""
    r = m["readings"]
    get = (lambda k: None) if r is None else r.get
    kind = m["device_type"]

    def is_type(name):
        return None if kind is None else kind == name

    def outside(k, low, high):
        v = get(k)
        return three_or(less(v, low), less(high, v))

    verdict = three_or(
        three_and(
            is_type("temperature_sensor"),
            three_or(outside("temperature", 18, 25), outside("humidity", 30, 60)),
        ),
        three_and(is_type("pressure_sensor"), outside("pressure", 1000, 1020)),
        three_and(
            is_type("vibration_sensor"),
            three_or(*[outside(f"vibration_{a}", -2, 2) for a in "xyz"]),
        ),
        three_and(
            is_type("energy_meter"),
            three_or(outside("voltage", 220, 240), less(7000, get("power"))),
        ),
        less(NOW + HOUR_MS, m["timestamp"]),
        less(m["timestamp"], NOW - 7 * DAY_MS),
    )
    if m["event_id"] is None:
        return "SCHEMA"
    return {True: "ANOMALY", False: "PASSED", None: "INDETERMINATE"}[verdict]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(message, min_size=40, max_size=120))
def test_random_messages(spark, batch):
    rows = gate_messages(to_messages(spark, [json.dumps(m) for m in batch]), NOW)
    got = {r.offset: r.gate for r in rows.select("offset", "gate").collect()}
    assert [got[i] for i in range(len(batch))] == [expected_gate(m) for m in batch]
