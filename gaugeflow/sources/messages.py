"""Keyed JSON messages: Kafka or files that carry the same envelope.

Both forms exist for batch and stream. The Kafka connector is a jar outside Spark core;
start the session with it on the classpath to use :func:`kafka_messages` and
:func:`write_kafka`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import schemas
from gaugeflow.functions.once import evaluated_once

TOPIC = "iot-telemetry"

# The source options the pipeline relies on.
KAFKA_OPTIONS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    *,
    stream: bool = True,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    fail_on_data_loss: bool = False,
) -> DataFrame:
    """The topic as an endless stream, or as one batch of what it holds now.

    By default offsets that the broker no longer has are skipped; ``fail_on_data_loss``
    stops the job instead.

    ``min_partitions`` splits large topic partitions into several tasks, so that a topic
    with few partitions does not bound the parallelism of parsing.
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.format("kafka").options(**KAFKA_OPTIONS)
    if fail_on_data_loss:
        reader = reader.option("failOnDataLoss", "true")
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if stream and max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load()


def file_messages(
    spark: SparkSession,
    path: str,
    *,
    stream: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files in the envelope schema, as a stand-in for a topic or a replay of one."""
    reader = spark.readStream if stream else spark.read
    reader = reader.schema(schemas.envelope())
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def parse_envelope(messages: DataFrame) -> DataFrame:
    """Envelope to telemetry columns: text key, typed value, broker position, clock.

    Parsing is permissive: a field of the wrong type turns NULL and the rest survives;
    text that is not JSON gives NULL in every field. ``value`` keeps the original text.
    """
    text = messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
    )
    data = evaluated_once(F.from_json("value", schemas.telemetry())).alias("data")
    return text.select("*", data).select(
        "kafka_key",
        "data.*",
        "topic",
        "partition",
        "offset",
        "kafka_timestamp",
        F.current_timestamp().alias("processing_time"),
        "value",
    )


def message_text() -> Column:
    """Telemetry columns as the JSON text of one message; absent fields are left out."""
    return F.to_json(F.struct(*schemas.TELEMETRY_COLUMNS))


def encode(telemetry: DataFrame) -> DataFrame:
    """Telemetry to ``key``/``value`` for a message sink.

    Keyed by device so that a device's messages stay in order; a row without a device
    gets a random key and spreads over the partitions.
    """
    return telemetry.select(
        F.coalesce(F.col("device_id"), F.uuid()).cast("binary").alias("key"),
        message_text().cast("binary").alias("value"),
    )


def write_kafka(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Append encoded messages to a topic with an idempotent, fully acknowledged producer."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("topic", topic)
        .save()
    )
