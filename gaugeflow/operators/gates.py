"""The quality gates: one column, four disjoint and exhaustive values.

``filter(c)`` and ``filter(~c)`` both drop rows where ``c`` is NULL. Such rows get a gate
of their own here instead of vanishing, while the passed and anomaly sets stay exactly
those of the two filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow import schemas
from gaugeflow.functions.clock import utc_day
from gaugeflow.functions.once import evaluated_once
from gaugeflow.operators.rules import LIVE, RangeRule, TimeLimits, out_of_range, out_of_time
from gaugeflow.schemas import QUALITY_COLUMNS, TELEMETRY_COLUMNS

PASSED, ANOMALY, INDETERMINATE, SCHEMA = "PASSED", "ANOMALY", "INDETERMINATE", "SCHEMA"
GATES = (PASSED, ANOMALY, INDETERMINATE, SCHEMA)

# Fixed values written to the validated and anomaly tables.
STATUS_PASSED = "PASSED"
STATUS_ANOMALY = "ANOMALY_DETECTED"
METHOD = "SPARK_RULES"
SCORE_PASSED, SCORE_CONFIRMED, SCORE_SUSPECTED = 0.0, 1.0, 0.8

# Partitions for event times far from the clock of the run: a device with a broken clock
# must not open one directory per day of history or future. Events from the future share
# one date. Events from too long ago are dated by their arrival: DATE_PAST and as many days as
# lie between 1970 and the day they came in, which ends before PAST_END.
DATE_PAST, PAST_END, DATE_FUTURE = "0001-01-01", "1000-01-01", "9999-12-31"


def stream_clock() -> Column:
    """Clock of a micro-batch in whole seconds; fixed per batch and stable on replay."""
    return F.unix_seconds(F.current_timestamp()) * F.lit(1000).cast("bigint")


def fixed_clock(as_of_ms: int) -> Column:
    return F.lit(as_of_ms).cast("bigint")


def is_anomalous(
    as_of_ms: Column,
    rules: tuple[RangeRule, ...] = LIVE,
    limits: TimeLimits = TimeLimits(),
) -> Column:
    """Out of range or out of time: true, false, or NULL where the row cannot tell."""
    return out_of_range(rules) | out_of_time(as_of_ms, limits)


def gate_of(anomalous: Column) -> Column:
    """The gate of a row, given its verdict."""
    return (
        F.when(F.col("event_id").isNull(), SCHEMA)
        .when(anomalous, ANOMALY)
        .when(anomalous.isNull(), INDETERMINATE)
        .otherwise(PASSED)
    )


def anomaly_score() -> Column:
    """Score of an anomalous row: higher when the device flagged it itself."""
    flagged = F.col("metadata.anomaly_detected") == "true"
    return F.when(flagged, F.lit(SCORE_CONFIRMED)).otherwise(F.lit(SCORE_SUSPECTED))


def event_date(as_of_ms: Column, limits: TimeLimits = TimeLimits()) -> Column:
    """Partition date: the event's UTC day; outside the limits that of the arrival, or the end."""
    at = F.col("timestamp")
    return (
        F.when(at.isNull(), utc_day(as_of_ms))
        .when(at < as_of_ms - F.lit(limits.max_age_ms).cast("bigint"), _arrived(utc_day(as_of_ms)))
        .when(
            at > as_of_ms + F.lit(limits.max_future_ms).cast("bigint"),
            F.lit(DATE_FUTURE).cast("date"),
        )
        .otherwise(utc_day(at))
    )


def _arrived(day: Column) -> Column:
    """Partition date of events from too long ago that come in on ``day``."""
    since_1970 = F.datediff(day, F.lit("1970-01-01").cast("date"))
    return F.date_add(F.lit(DATE_PAST).cast("date"), since_1970)


def dates_from(since_ms: int) -> Column:
    """Partitions that can hold events from ``since_ms`` on.

    Dates grow with event time in all but the partitions of old events. An old event is older
    than the clock it came in by, so one from ``since_ms`` on came in on its day or later;
    partitions of earlier arrivals hold none. DATE_PAST itself has rows of any arrival.
    """
    date, day = F.col("event_date"), utc_day(F.lit(since_ms).cast("bigint"))
    past = F.lit(PAST_END).cast("date")
    old = (date < past) & ((date >= _arrived(day)) | (date == F.lit(DATE_PAST).cast("date")))
    return ((date >= past) & (date >= day)) | old


def far_off() -> Column:
    """Partitions of event times far from the clock."""
    date = F.col("event_date")
    return (date < F.lit(PAST_END).cast("date")) | (date == F.lit(DATE_FUTURE).cast("date"))


def is_far_off(date: str) -> bool:
    return date < PAST_END or date == DATE_FUTURE


def classify(
    telemetry: DataFrame,
    as_of_ms: int | Column,
    rules: tuple[RangeRule, ...] = LIVE,
    limits: TimeLimits = TimeLimits(),
) -> DataFrame:
    """Add ``gate`` and the three quality columns; no row is dropped or moved."""
    clock = fixed_clock(as_of_ms) if isinstance(as_of_ms, int) else as_of_ms
    gate = F.col("gate")
    passed, anomaly = gate == PASSED, gate == ANOMALY
    verdict = evaluated_once(is_anomalous(clock, rules, limits)).alias("_anomalous")
    tagged = telemetry.select("*", verdict).select(
        *telemetry.columns, gate_of(F.col("_anomalous")).alias("gate")
    )
    return tagged.withColumns(
        {
            "quality_status": F.when(passed, STATUS_PASSED).when(anomaly, STATUS_ANOMALY),
            "anomaly_score": F.when(passed, F.lit(SCORE_PASSED)).when(anomaly, anomaly_score()),
            "validation_method": F.when(passed | anomaly, METHOD),
        }
    )


def reason() -> Column:
    """Why a row is in the dead-letter set; NULL for rows that are not."""
    undecided = (
        F.when(F.col("timestamp").isNull(), "event time missing")
        .when(F.col("device_type").isNull(), "device_type missing")
        .when(F.col("readings").isNull(), "readings missing")
        .when(F.size("readings") == 0, "readings empty")
        .otherwise("required metric missing or null")
    )
    gate = F.col("gate")
    return F.when(gate == SCHEMA, "event_id missing or message unreadable").when(
        gate == INDETERMINATE, undecided
    )


def dataset_rows(
    gated: DataFrame, as_of_ms: int | Column, limits: TimeLimits = TimeLimits()
) -> DataFrame:
    """Classified messages in the shape of the one stored dataset.

    The message text is kept only for rejected rows; for all others it repeats the parsed
    columns.
    """
    clock = fixed_clock(as_of_ms) if isinstance(as_of_ms, int) else as_of_ms
    rejected = F.col("gate").isin(SCHEMA, INDETERMINATE)
    return gated.withColumns(
        {
            "reason": reason(),
            "event_date": event_date(clock, limits),
            "value": F.when(rejected, F.col("value")),
        }
    ).select(*schemas.gated().names)


def raw_rows(gated: DataFrame, *extra: str) -> DataFrame:
    """The audit copy: every row, good or bad, without verdict or envelope."""
    return gated.select(*TELEMETRY_COLUMNS, *extra)


def passed_rows(gated: DataFrame, *extra: str) -> DataFrame:
    rows = gated.filter(F.col("gate") == PASSED)
    return rows.select(*TELEMETRY_COLUMNS, *QUALITY_COLUMNS, *extra)


def anomaly_rows(gated: DataFrame, *extra: str) -> DataFrame:
    rows = gated.filter(F.col("gate") == ANOMALY)
    return rows.select(*TELEMETRY_COLUMNS, *QUALITY_COLUMNS, *extra)


def rejected_rows(gated: DataFrame) -> DataFrame:
    return gated.filter(F.col("gate").isin(SCHEMA, INDETERMINATE))
