"""Every schema of the engine, declared once.

``StructType.add`` changes its object in place, so shared constants would let one
caller alter another's table. Each function therefore builds a fresh schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The wire schema, as DDL. Column order is table order.
_LOCATION = "building string, floor int, zone string"
_METADATA = (
    f"location struct<{_LOCATION}>, firmware_version string, signal_strength int, "
    "battery_level int, anomaly_detected string, anomaly_type string, "
    "status string, error string"
)
_TELEMETRY = (
    "event_id string, device_id string, device_type string, timestamp bigint, "
    f"readings map<string,double>, metadata struct<{_METADATA}>"
)
_QUALITY = "quality_status string, anomaly_score double, validation_method string"
_ENVELOPE = (
    "kafka_key string, topic string, partition int, offset bigint, "
    "kafka_timestamp timestamp, processing_time timestamp"
)

TELEMETRY_COLUMNS = ["event_id", "device_id", "device_type", "timestamp", "readings", "metadata"]
QUALITY_COLUMNS = ["quality_status", "anomaly_score", "validation_method"]
ENVELOPE_COLUMNS = [
    "kafka_key", "topic", "partition", "offset", "kafka_timestamp", "processing_time",
]
# Partition of landed rows: the stream and batch that landed them.
LANDED = "landed"
DEAD_LETTER_COLUMNS = [
    "value", "kafka_key", "topic", "partition", "offset", "kafka_timestamp",
    "gate", "reason", "processing_time",
]


def _struct(*ddl: str) -> T.StructType:
    return T.StructType.fromDDL(", ".join(ddl))


def telemetry() -> T.StructType:
    """The six columns of a message value and of the raw audit table."""
    return _struct(_TELEMETRY)


def quality() -> T.StructType:
    """Validated and anomaly tables: telemetry plus the verdict of the gates."""
    return _struct(_TELEMETRY, _QUALITY)


def dead_letter() -> T.StructType:
    """Rejected messages with their raw text, envelope and reason."""
    return _struct(
        "value string, kafka_key string, topic string, partition int, offset bigint, "
        "kafka_timestamp timestamp, gate string, reason string, processing_time timestamp"
    )


def envelope() -> T.StructType:
    """What a Kafka source delivers, restricted to the columns in use."""
    return _struct(
        "key binary, value binary, topic string, partition int, offset bigint, "
        "timestamp timestamp"
    )


def gated() -> T.StructType:
    """The one dataset behind all tables: every row, tagged with its gate."""
    return _struct(
        _TELEMETRY, _QUALITY, _ENVELOPE, "value string, reason string, gate string, event_date date"
    )
