"""Telemetry derived from a plain ``events`` table.

The table (event_id, ts, user_id, event_type, value, props) is turned row by row into
telemetry of four device types with good, out-of-range, empty and partly failed
readings. Everything is a narrow projection: the data grows with the table, no shuffle
is added, and a time bound is pushed to the Parquet scan on ``ts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.sources.messages import TOPIC, message_text

# Fixed value: 2024-01-30 23:59:59 UTC, the end of the events' 30 days.
AS_OF_MS = 1_706_659_199_000
# Fixed value: 40 days, so that all 30 days of events stay inside the age limit.
MAX_AGE_MS = 3_456_000_000

TOPIC_PARTITIONS = 3


_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def stream_events(
    spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same table, a file or a folder of files, as a file stream."""
    reader = spark.readStream.schema(_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    table = f"{sf_dir}/events.parquet"
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getFileStatus(path).isDirectory():
        return reader.parquet(table)
    # A stream reads folders only.
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def since(events: DataFrame, since_ms: int | None) -> DataFrame:
    """Bound event time on the stored column, where row groups can be skipped.

    ms >= n holds exactly when the microsecond time is >= n * 1000, because ms truncates.
    """
    if since_ms is None:
        return events
    bound = F.expr(
        f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {since_ms / 1000:.3f}BD)"
    )
    return events.filter(F.col("ts") >= bound)


# The recipe as SQL expressions: one parse each, where the same trees built call by call
# would take longer to describe than a small table takes to read.
_NUMBERED = (
    "event_id AS eid",
    "user_id AS u",
    "event_type AS et",
    "value AS v",
    "timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts) AS ms",
    "cast(get_json_object(props, '$.k') AS bigint) AS k",
)
# Kind of reading: all metrics, none (device back online), or only a failed first metric.
_KIND = """
    CASE WHEN et = 'signup' AND k % 10 = 0 THEN 'EMPTY'
         WHEN et = 'error' AND k % 10 = 1 THEN 'PARTIAL'
         ELSE 'FULL' END AS kind
"""
_DEVICE_TYPE = """
    CASE u % 4 WHEN 0 THEN 'temperature_sensor' WHEN 1 THEN 'pressure_sensor'
               WHEN 2 THEN 'vibration_sensor' ELSE 'energy_meter' END
"""
# Devices with u % 40 = 8 report the same values for ever.
_READINGS = """
    CASE kind
      WHEN 'FULL' THEN CASE u % 4
        WHEN 0 THEN map('temperature', if(u % 40 = 8, 18D, 17D + k * 0.09D),
                        'humidity', if(u % 40 = 8, 30D, 30D + v / 10D))
        WHEN 1 THEN map('pressure', 999D + k * 0.22D, 'temperature', 15D + k * 0.2D)
        WHEN 2 THEN map('vibration_x', (k - 50) / 23D, 'vibration_y', v / 100D,
                        'vibration_z', (50 - k) / 50D, 'temperature', 20D + k * 0.2D)
        ELSE map('voltage', 219D + k * 0.22D, 'current', v / 10D, 'power', v * 20D,
                 'power_factor', 0.76D + (u % 5) * 0.05D + k * 0.0005D) END
      WHEN 'PARTIAL' THEN CASE u % 4
        WHEN 0 THEN map('temperature', double(null)) WHEN 1 THEN map('pressure', double(null))
        WHEN 2 THEN map('vibration_x', double(null)) ELSE map('voltage', double(null)) END
      ELSE map_from_arrays(array()::array<string>, array()::array<double>) END
"""
_METADATA = """
    named_struct(
      'location', if(kind = 'FULL', named_struct(
          'building', concat('Building-', u % 5 + 1),
          'floor', int(u % 10 + 1),
          'zone', CASE u % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END), null),
      'firmware_version', if(u % 2 = 0, '1.0.0', '2.1.0'),
      'signal_strength', int(50 + (u % 3) * 15 + k % 10),
      'battery_level', if(u % 4 = 3, null, int(15 + (u * 7 + k) % 85)),
      'anomaly_detected', if(k % 50 = 3, 'true', null),
      'anomaly_type', if(k % 50 = 3, if(et = 'view', 'spike', 'drop'), null),
      'status', if(kind = 'EMPTY', 'reconnected', null),
      'error', if(kind = 'PARTIAL', 'sensor_failure', null))
"""
_TELEMETRY = (
    "if(eid % 97 = 0, null, concat('e', eid)) AS event_id",
    "concat('dev-', u) AS device_id",
    f"{_DEVICE_TYPE} AS device_type",
    "ms AS timestamp",
    # Evaluated once per row (functions/once.py): a filter on one metric would otherwise be
    # pushed below this projection with the whole expression in it.
    f"explode(array({_READINGS})) AS readings",
    f"{_METADATA} AS metadata",
)
_POSITION = (f"int(u % {TOPIC_PARTITIONS}) AS partition", "eid AS offset")


def to_telemetry(events: DataFrame, position: bool = False) -> DataFrame:
    """The six telemetry columns for every event, with its topic position if asked for."""
    kinds = events.selectExpr(*_NUMBERED).selectExpr("*", _KIND)
    return kinds.selectExpr(*_TELEMETRY, *(_POSITION if position else ()))


def to_messages(events: DataFrame, faulty: bool = False) -> DataFrame:
    """Every event as a message in the envelope of a topic with three partitions.

    With ``faulty`` some producers are broken: of each 89 events one is cut off, one has
    text where a time and a map belong, one carries its metric outside ``readings``, one
    lacks its ids and one has metadata of the wrong types.
    """
    rows = to_telemetry(events, position=True)
    value = message_text()
    if faulty:
        value = _faulty(value, F.col("offset") % 89)
    return rows.select(
        F.col("device_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        "partition",
        "offset",
        F.timestamp_millis("timestamp").alias("timestamp"),
    )


def _faulty(text: Column, fault: Column) -> Column:
    ids = ["event_id", "device_id", "device_type"]
    mistyped = F.struct(
        *ids, F.lit("not-a-timestamp").alias("timestamp"), F.lit("not-a-dict").alias("readings")
    )
    misplaced = F.struct(*ids, "timestamp", F.lit(25.0).alias("temperature"))
    unnamed = F.struct("device_id", "timestamp", "readings")
    metadata = F.struct(
        F.lit("unknown").alias("location"), F.lit("low").alias("battery_level"),
        F.lit(1).alias("anomaly_detected"),
    )
    garbled = F.struct(*ids, "timestamp", "readings", metadata.alias("metadata"))
    return (
        F.when(fault == 0, F.substring(text, F.lit(1), F.length(text) - 3))
        .when(fault == 1, F.to_json(mistyped))
        .when(fault == 2, F.to_json(misplaced))
        .when(fault == 3, F.to_json(unnamed))
        .when(fault == 4, F.to_json(garbled))
        .otherwise(text)
    )
