"""Hourly sensor aggregates on the stream.

Two forms. ``fold_batch`` keeps mergeable accumulators (count, sum, least, greatest) of every
hour, adds those of each landed batch, and so has every hour up to the last batch at any time,
however late its rows come. ``start_rollup`` gives each hour out once, when the watermark has
closed it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gaugeflow import snapshots
from gaugeflow.functions.clock import SECOND_MS, hour_start_ms, utc_day, utc_seconds
from gaugeflow.operators import gates
from gaugeflow.operators.rules import TimeLimits
from gaugeflow.operators.sensors import by_metric, hourly_sensor_aggregates
from gaugeflow.schemas import LANDED, gated as gated_schema
from gaugeflow.sources.stores import TelemetryStore
from gaugeflow.streaming.ledger import Batch
from gaugeflow.streaming.triggers import TRIGGER, triggered

HOUR = ["device_id", "device_type", "metric", "hour_ms"]


def _accumulators() -> StructType:
    return StructType.fromDDL(
        "device_id string, device_type string, metric string, hour_ms bigint, "
        "reading_count bigint, value_sum double, min_value double, max_value double, "
        "event_date date"
    )


def accumulate(passed: DataFrame) -> DataFrame:
    """Count, sum, least and greatest value of passed rows per device, metric and hour."""
    values = by_metric(passed, "device_id", "device_type", "timestamp")
    return values.groupBy(*HOUR[:-1], hour_start_ms("timestamp").alias("hour_ms")).agg(
        F.count("*").alias("reading_count"),
        F.sum("value").alias("value_sum"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )


def merge(accumulators: DataFrame) -> DataFrame:
    """Accumulators of the same hour as one."""
    return accumulators.groupBy(*HOUR).agg(
        F.sum("reading_count").alias("reading_count"),
        F.sum("value_sum").alias("value_sum"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
    )


def _dated(accumulators: DataFrame) -> DataFrame:
    # Hours outside the years 1 to 9999 go to the last date; the hour itself is kept.
    end = F.lit(gates.DATE_FUTURE).cast("date")
    return accumulators.withColumn("event_date", F.coalesce(utc_day("hour_ms"), end))


def fold_batch(spark: SparkSession, landing: str, path: str, batch: Batch) -> None:
    """Add a landed batch to the hours at ``path``, once.

    The batch's accumulators become folders of the days they touch; a day in many folders is
    merged into one. The commit names the batch, so a batch that is replayed after it adds
    nothing, and one that was cut off before it has added nothing. Streams may share a path:
    one that finds another's commit in its place tries again on top of it.
    """
    schema = gated_schema().add(LANDED, "string")
    rows = spark.read.schema(schema).parquet(landing)
    own = (F.col(LANDED) == batch.name) & (F.col("gate") == gates.PASSED)
    # Read back more than once, but only its own few files.
    added = _dated(accumulate(rows.filter(own)))
    while True:
        before = snapshots.load(spark, path) or snapshots.Snapshot()
        if before.marks.get(batch.stream, -1) >= batch.number:
            return
        many = {d for d, own in before.days.items() if len(own) >= snapshots.MOST_FOLDERS}
        merged = set()
        result = added
        if many:
            days = added.select(F.col("event_date").cast("string").alias("day")).distinct()
            merged = many & {r.day for r in days.collect()}
        if merged:
            former = snapshots.read(spark, path, before, _accumulators(), merged)
            result = _dated(merge(former.drop("event_date").unionByName(added.drop("event_date"))))
        try:
            snapshots.change(
                spark, path, before, result.hint("rebalance", "event_date"), merged,
                {batch.stream: batch.number},
            )
            return
        except snapshots.ConflictError:
            continue


def hours(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Every hour that batches have been folded into, in the shape of the batch form."""
    found = snapshots.load(spark, path, version) or snapshots.Snapshot()
    rows = merge(snapshots.read(spark, path, found, _accumulators()))
    return rows.select(
        "device_id", "device_type", "metric", utc_seconds("hour_ms").alias("hour"),
        "reading_count", (F.col("value_sum") / F.col("reading_count")).alias("avg_value"),
        "min_value", "max_value",
    )


def whole_delay(limits: TimeLimits = TimeLimits()) -> str:
    """The shortest watermark delay that drops no row the gates let pass.

    Event time leads the clock by at most the future limit, and a passed row trails it by
    at most the age limit, so with their sum the watermark never overtakes a passed row.
    """
    return f"{(limits.max_future_ms + limits.max_age_ms) // SECOND_MS} seconds"


def hourly_aggregates(gated: DataFrame, delay: str = whole_delay()) -> DataFrame:
    """Count, mean, minimum and maximum per device, metric and hour of passed rows.

    Each hour comes out once, when the watermark has passed its end. State is one row of
    four accumulators per open hour, device and metric.
    """
    timed = (
        gated.filter(F.col("gate") == gates.PASSED)
        .select(
            "device_id",
            "device_type",
            F.timestamp_millis("timestamp").alias("event_time"),
            "readings",
        )
        .withWatermark("event_time", delay)
    )
    return (
        by_metric(timed, "device_id", "device_type", "event_time")
        .groupBy(F.window("event_time", "1 hour"), "device_id", "device_type", "metric")
        .agg(
            F.count("*").alias("reading_count"),
            F.avg("value").alias("avg_value"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
        )
        .select(
            "device_id",
            "device_type",
            "metric",
            utc_seconds(F.unix_millis("window.start")).alias("hour"),
            "reading_count",
            "avg_value",
            "min_value",
            "max_value",
        )
    )


def start_rollup(
    gated: DataFrame,
    path: str,
    checkpoint: str,
    *,
    delay: str = whole_delay(),
    trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """Append finished hours to a Parquet dataset, exactly once."""
    writer = (
        hourly_aggregates(gated, delay)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return triggered(writer, trigger).start()


def complete(closed: DataFrame, store: TelemetryStore) -> DataFrame:
    """Hours that the stream has closed, and the open ones from the gated data.

    The delay of the stream lets no passed row come too late, so an hour is closed once and
    whole; every hour is in the result once.
    """
    hour = ["device_id", "device_type", "metric", "hour"]
    every = hourly_sensor_aggregates(store, window_ms=None)
    known = closed.select(*[F.col(c).alias(f"_{c}") for c in hour])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in hour]
    return closed.unionByName(every.join(known, same, "left_anti"))
