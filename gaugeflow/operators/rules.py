"""Range rules as data, compiled to one boolean ``Column``.

A rule list turns into a plain expression, not into a join with a rule table: it is
evaluated inside the scan's codegen stage and never shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeflow.functions.clock import DAY_MS, HOUR_MS


@dataclass(frozen=True)
class RangeRule:
    """``metric`` of ``device_type`` is in range from ``low`` to ``high``, ends included."""

    device_type: str
    metric: str
    low: float | None
    high: float | None

    def breach(self, readings: Column) -> Column:
        """True outside the range, NULL when the metric is missing or null."""
        value = readings[self.metric]
        tests = []
        if self.low is not None:
            tests.append(value < F.lit(self.low))
        if self.high is not None:
            tests.append(value > F.lit(self.high))
        return reduce(Column.__or__, tests)


@dataclass(frozen=True)
class TimeLimits:
    """How far event time may lie ahead of or behind the clock before it is an anomaly."""

    max_future_ms: int = HOUR_MS
    max_age_ms: int = 7 * DAY_MS


# The limits in force (LIVE) and the full ranges per metric (DECLARED).
LIVE = (
    RangeRule("temperature_sensor", "temperature", 18.0, 25.0),
    RangeRule("temperature_sensor", "humidity", 30.0, 60.0),
    RangeRule("pressure_sensor", "pressure", 1000.0, 1020.0),
    RangeRule("vibration_sensor", "vibration_x", -2.0, 2.0),
    RangeRule("vibration_sensor", "vibration_y", -2.0, 2.0),
    RangeRule("vibration_sensor", "vibration_z", -2.0, 2.0),
    RangeRule("energy_meter", "voltage", 220.0, 240.0),
    RangeRule("energy_meter", "power", None, 7000.0),
)
DECLARED = (
    RangeRule("temperature_sensor", "temperature", 18.0, 25.0),
    RangeRule("temperature_sensor", "humidity", 30.0, 60.0),
    RangeRule("pressure_sensor", "pressure", 1000.0, 1020.0),
    RangeRule("pressure_sensor", "temperature", 15.0, 30.0),
    RangeRule("vibration_sensor", "vibration_x", -2.0, 2.0),
    RangeRule("vibration_sensor", "vibration_y", -2.0, 2.0),
    RangeRule("vibration_sensor", "vibration_z", -2.0, 2.0),
    RangeRule("vibration_sensor", "temperature", 20.0, 40.0),
    RangeRule("energy_meter", "voltage", 220.0, 240.0),
    RangeRule("energy_meter", "current", 0.0, 30.0),
    RangeRule("energy_meter", "power", 0.0, 7000.0),
    RangeRule("energy_meter", "power_factor", 0.85, 0.99),
)
PROFILES = {"live": LIVE, "declared": DECLARED}


def out_of_range(rules: tuple[RangeRule, ...] = LIVE, readings: Column | None = None) -> Column:
    """True when any rule of the row's device type is broken; three-valued.

    A missing metric makes the answer NULL unless another metric is out of range. A
    known device type without rules gives false.
    """
    readings = F.col("readings") if readings is None else readings
    kind = F.col("device_type")
    per_type = [
        (kind == name) & reduce(Column.__or__, [r.breach(readings) for r in group])
        for name, group in groupby(rules, key=lambda r: r.device_type)
    ]
    return reduce(Column.__or__, per_type)


def out_of_time(as_of_ms: Column, limits: TimeLimits = TimeLimits()) -> Column:
    """True when event time is strictly beyond either limit, NULL without event time."""
    at = F.col("timestamp")
    return (at > as_of_ms + F.lit(limits.max_future_ms).cast("bigint")) | (
        at < as_of_ms - F.lit(limits.max_age_ms).cast("bigint")
    )


def breached_rules(rules: tuple[RangeRule, ...] = DECLARED) -> Column:
    """Names of the metrics of this row that break their range, in rule order."""
    readings = F.col("readings")
    names = [
        F.when((F.col("device_type") == r.device_type) & r.breach(readings), F.lit(r.metric))
        for r in rules
    ]
    return F.array_compact(F.array(*names))
