"""Device models kept up to date by what has been landed since the last refresh.

One row per device is the state of a model, in buckets by a hash of the device. A refresh
reads the batches that streams have landed since, reduces them to one row per device, and
merges these with the rows of the buckets they fall in; other buckets are not read or written.
State and the last batch of each stream are committed together, so a refresh that dies or
runs twice takes no batch twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeflow import snapshots
from gaugeflow.branches import Branch, landed_rows, up_to
from gaugeflow.functions.clock import DAY_MS, day_start_ms, utc_seconds
from gaugeflow.operators import gates
from gaugeflow.operators.latest import recency
from gaugeflow.plans.device_models import readings_text
from gaugeflow.streaming import ledger

BUCKET = "bucket"
# Buckets of a new state. As many as its size in files of a good size, and then it stays.
BUCKETS = 64

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class KeyedModel:
    """``reduce`` makes state of passed rows, ``merge`` one row per key of several, ``show``
    the model of its state. ``state`` names the columns, in their order."""

    state: str
    keys: tuple[str, ...]
    reduce: Step
    merge: Step
    show: Step

    def schema(self) -> StructType:
        return StructType.fromDDL(f"{self.state}, {BUCKET} int")


def _summary_state(passed: DataFrame) -> DataFrame:
    day = F.call_function("div", day_start_ms("timestamp"), F.lit(DAY_MS).cast("bigint"))
    return passed.groupBy("device_id", "device_type").agg(
        F.count("*").alias("total_readings"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
        F.collect_set(day).alias("days"),
    )


def _summary_merge(state: DataFrame) -> DataFrame:
    return state.groupBy("device_id", "device_type").agg(
        F.sum("total_readings").alias("total_readings"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.array_distinct(F.flatten(F.collect_list("days"))).alias("days"),
    )


def _summary(state: DataFrame) -> DataFrame:
    days = F.size("days").cast("bigint").alias("active_days")
    return state.select("device_id", "device_type", "total_readings", "first_seen", "last_seen", days)


_NEWEST = ("timestamp", "event_id", "device_type", "readings", "location", "battery_level", "signal_strength")


def _newest(rows: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct(*_NEWEST), recency()).alias("newest")
    return rows.groupBy("device_id").agg(newest).select("device_id", "newest.*")


def _newest_state(passed: DataFrame) -> DataFrame:
    told = [F.col(f"metadata.{c}").alias(c) for c in _NEWEST[4:]]
    return _newest(passed.select("device_id", *_NEWEST[:4], *told))


def _latest(state: DataFrame) -> DataFrame:
    return state.select(
        "device_id", "device_type", "location.building", "location.floor", "location.zone",
        F.col("timestamp").alias("last_reading_timestamp"),
        utc_seconds("timestamp").alias("last_reading_time"),
        readings_text().alias("latest_readings"), "battery_level", "signal_strength",
    )


KEYED_MODELS = {
    "device_summary_simple": KeyedModel(
        "device_id string, device_type string, total_readings bigint, first_seen bigint, "
        "last_seen bigint, days array<bigint>",
        ("device_id", "device_type"), _summary_state, _summary_merge, _summary,
    ),
    "device_metrics_latest": KeyedModel(
        "device_id string, timestamp bigint, event_id string, device_type string, "
        "readings map<string,double>, location struct<building: string, floor: int, zone: string>, "
        "battery_level int, signal_strength int",
        ("device_id",), _newest_state, _newest, _latest,
    ),
}


def path_of(branch: Branch, name: str) -> str:
    return f"{branch.root}/{branch.name}/models/{name}"


def refresh(spark: SparkSession, branch: Branch, name: str, buckets: int = BUCKETS) -> int:
    """Take the newly landed batches into a model; returns how many buckets were rewritten.

    ``buckets`` counts when the state is new; later refreshes go by the buckets it has.
    """
    model, path = KEYED_MODELS[name], path_of(branch, name)
    before = snapshots.load(spark, path)
    if before is None:
        snapshots.commit(spark, path, snapshots.Snapshot(1, {}, {_COUNT: buckets}))
        before = snapshots.load(spark, path)
    known = {stream: mark for stream, mark in before.marks.items() if stream != _COUNT}
    marks = ledger.beyond(spark, branch.landing, known)
    if not marks:
        return 0
    fresh = landed_rows(spark, branch.landing).filter(up_to(marks) & ~up_to(known))
    place = F.pmod(F.xxhash64(*model.keys[:1]), F.lit(before.marks[_COUNT])).cast("int")
    columns = model.schema().names
    changes = model.reduce(gates.passed_rows(fresh)).withColumn(BUCKET, place).select(*columns)
    touched = {str(r[0]) for r in changes.select(BUCKET).distinct().collect()}
    former = snapshots.read(spark, path, before, model.schema(), touched)
    merged = model.merge(former.unionByName(changes)).withColumn(BUCKET, place)
    snapshots.change(
        spark, path, before, merged.hint("rebalance", BUCKET), touched, marks, by=BUCKET
    )
    return len(touched)


# Among the marks, under a name no stream has: buckets of the state.
_COUNT = "buckets"


def result(spark: SparkSession, branch: Branch, name: str) -> DataFrame:
    """The model as of its last refresh."""
    model, path = KEYED_MODELS[name], path_of(branch, name)
    found = snapshots.load(spark, path) or snapshots.Snapshot()
    return model.show(snapshots.read(spark, path, found, model.schema()))
