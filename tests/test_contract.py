"""What the contract check says of single messages."""

from __future__ import annotations

import dataclasses
import json

import pytest

from gaugeflow.operators import contract

GOOD = {
    "event_id": "e", "device_id": "d", "device_type": "pressure_sensor", "timestamp": 1,
    "readings": {"pressure": 1.5, "temperature": 20},
}

CASES = [
    ("whole", {}, set()),
    ("no metadata, or null", {"metadata": None}, set()),
    ("nulls within", {"metadata": {"location": None, "battery_level": None}}, set()),
    ("flag as boolean", {"metadata": {"anomaly_detected": True}}, set()),
    ("flag as text", {"metadata": {"anomaly_detected": "true"}}, set()),
    ("metadata not an object", {"metadata": "x"}, {("metadata", "mistyped")}),
    ("signal as text", {"metadata": {"signal_strength": "70"}},
     {("metadata.signal_strength", "mistyped")}),
    ("floor and battery", {"metadata": {"battery_level": [], "location": {"floor": 1.5}}},
     {("metadata.battery_level", "mistyped"), ("metadata.location.floor", "mistyped")}),
    ("unknown type", {"device_type": "toaster"}, {("device_type", "unknown")}),
    ("type not a text", {"device_type": 5}, {("device_type", "mistyped")}),
    ("readings not an object", {"readings": [1]}, {
        ("readings", "mistyped"), ("readings.pressure", "missing"),
        ("readings.temperature", "missing"),
    }),
    ("no readings in it", {"readings": {}}, {
        ("readings.pressure", "missing"), ("readings.temperature", "missing"),
    }),
    ("null and text readings", {"readings": {"pressure": None, "temperature": "1"}}, {
        ("readings.pressure", "null"), ("readings.temperature", "mistyped"),
    }),
]


@pytest.fixture(scope="module")
def found(spark):
    out = {}
    for name, change, _ in CASES:
        rows = spark.createDataFrame([(json.dumps(GOOD | change),)], "value string")
        out[name] = {(r.field, r.violation) for r in contract.violations(rows).collect()}
    return out


@pytest.mark.parametrize("name, expected", [(n, e) for n, _, e in CASES])
def test_violations(found, name, expected):
    assert found[name] == expected


def test_messages_that_are_no_object(spark):
    rows = spark.createDataFrame([("{",), (None,), ("[1]",)], "value string")
    got = sorted((r.field, r.violation) for r in contract.violations(rows).collect())
    missing = [(f.path, "missing") for f in contract.REQUIRED]
    assert got == sorted([("$", "unreadable")] * 2 + missing)


A, B = contract.Field("a", ("STRING",)), contract.Field("b", ("BIGINT",), values=("1", "2"))


def changed(field, **to):
    return dataclasses.replace(field, **to)


@pytest.mark.parametrize("old, new, found, together", [
    ((A,), (A,), [], "both"),
    ((A,), (A, B), [("b", "added", True, False)], "forward"),
    ((A,), (A, changed(B, optional=True)), [("b", "added", False, False)], "both"),
    ((A, B), (A,), [("b", "removed", False, True)], "backward"),
    ((A, changed(B, optional=True)), (A,), [("b", "removed", False, False)], "both"),
    ((A,), (changed(A, optional=True),), [("a", "made optional", False, True)], "backward"),
    ((changed(A, optional=True),), (A,), [("a", "made required", True, False)], "forward"),
    ((A,), (changed(A, kinds=("STRING", "BIGINT")),), [("a", "types widened", False, True)], "backward"),
    ((A,), (changed(A, kinds=("BIGINT",)),), [("a", "types changed", True, True)], "none"),
    ((B,), (changed(B, values=("1",)),), [("b", "values narrowed", True, False)], "forward"),
    ((B,), (changed(B, values=()),), [("b", "values widened", False, True)], "backward"),
    ((changed(B, values=()),), (B,), [("b", "values narrowed", True, False)], "forward"),
    ((B,), (changed(B, values=("2", "3"), optional=True),), [
        ("b", "made optional", False, True), ("b", "values changed", True, True),
    ], "none"),
])
def test_versions(old, new, found, together):
    got = [(c.path, c.change, c.backward, c.forward) for c in contract.compare(old, new)]
    assert got == found and contract.readable(old, new) == together


def test_a_break_shows_in_messages(spark):
    """What breaks backward is violated by old messages under the new version only."""
    texts = [json.dumps({"a": "x", "b": 1}), json.dumps({"a": "x"}), json.dumps({"a": 3})]
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    optional = changed(B, optional=True)
    got = contract.version_impact(rows, (A, optional), (changed(A, kinds=("STRING", "BIGINT")), B))
    assert sorted(map(tuple, got.collect()), key=repr) == [
        ("a", None, "types widened", False, True, 1, 0),
        ("b", None, "made required", True, False, 0, 2),
    ]
