"""Messages to gated telemetry, continuously.

Each message is parsed and classified once and written once, tagged with its gate. Raw,
validated, anomaly and dead-letter tables are views of that one dataset, so no crash can
leave them unequal and no batch is computed more than once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeflow.operators import dead_letter, gates
from gaugeflow.operators.rules import LIVE, RangeRule, TimeLimits
from gaugeflow.schemas import LANDED
from gaugeflow.sources.messages import parse_envelope
from gaugeflow.streaming import ledger, rollup
from gaugeflow.streaming.triggers import TRIGGER, triggered

PARTITIONS = ("event_date", "gate")


def gate_messages(
    messages: DataFrame,
    as_of_ms: int | None = None,
    rules: tuple[RangeRule, ...] = LIVE,
    limits: TimeLimits = TimeLimits(),
) -> DataFrame:
    """Messages, batch or stream, as rows of the gated dataset.

    Without ``as_of_ms`` the clock is that of the micro-batch, which is part of its
    recorded plan: a batch that is replayed gets the same verdicts.
    """
    clock: int | Column = gates.stream_clock() if as_of_ms is None else as_of_ms
    gated = gates.classify(parse_envelope(messages), clock, rules, limits)
    return gates.dataset_rows(gated, clock, limits)


def spread_for_writing(rows: DataFrame, tasks: int) -> DataFrame:
    """Bring rows of a partition together in few tasks, so that few files are written.

    Wide parsing would otherwise write one small file per task and partition. The salt
    keeps the passed rows, most of the data, on all ``tasks`` and each other gate on an
    eighth of them.
    """
    position = F.xxhash64("partition", "offset")
    width = F.when(F.col("gate") == gates.PASSED, tasks).otherwise(max(1, tasks // 8))
    return rows.repartition(tasks, *PARTITIONS, F.pmod(position, width))


def start_dataset_sink(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: str | None = TRIGGER,
    write_tasks: int | None = None,
    hours: str | None = None,
) -> StreamingQuery:
    """Append gated rows to a Parquet dataset, each once.

    ``trigger=None`` works off what is there and stops. Files are partitioned by event
    date and gate, so reading one gate from a time on skips all other files, and below
    that by stream and batch. A replayed batch has the same rows and replaces its own
    folders, so repeating it adds nothing; there is no log of files that grows. A reader
    sees a batch's folders as they are committed; its entry in the ledger, with counts taken
    while it was written, says that all are there.

    With ``hours`` the batch's passed rows are then folded into the hourly aggregates at that
    path, from the files just written.
    """
    if write_tasks:
        rows = spread_for_writing(rows, write_tasks)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, own = batch.sparkSession, batch_of(batch, batch_id)
        counts = Observation()
        (
            ledger.observed(batch.withColumn(LANDED, F.lit(own.name)), counts)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PARTITIONS, LANDED)
            .parquet(path)
        )
        if hours is not None and counts.get[gates.PASSED.lower()]:
            rollup.fold_batch(spark, path, hours, own)
        ledger.record(spark, path, own, counts.get)

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return triggered(writer, trigger).start()


def start_table_sink(
    rows: DataFrame, namespace: str, checkpoint: str, *, trigger: str | None = TRIGGER
) -> StreamingQuery:
    """Route gated rows into separate catalog tables, by event date, stream and batch.

    For formats or readers that need the tables apart. The batch is held while the four
    tables are written from it, and a replayed batch replaces its own partitions in each,
    so repeating it adds nothing. Any number of streams can write to the same tables.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        own = F.lit(batch_of(batch, batch_id).name)
        try:
            for table, routed in routes(batch, "event_date").items():
                tagged = routed.withColumn(LANDED, own)
                tagged.write.mode("overwrite").insertInto(f"{namespace}.{table}")
        finally:
            batch.unpersist()

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return triggered(writer, trigger).start()


def batch_of(batch: DataFrame, batch_id: int) -> ledger.Batch:
    """The stream and number of a batch, from within the function that writes it.

    The id of a stream is kept in its checkpoint, so a restart has the same one and another
    stream another.
    """
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not stream:
        raise RuntimeError("a batch without the id of its stream")
    return ledger.Batch(stream, batch_id)


def routes(gated: DataFrame, *extra: str) -> dict[str, DataFrame]:
    """The rows of each table."""
    return {
        "raw_telemetry": gates.raw_rows(gated, *extra),
        "validated_telemetry": gates.passed_rows(gated, *extra),
        "anomaly_alerts": gates.anomaly_rows(gated, *extra),
        "dead_letter_queue": dead_letter.dead_letters(gated, *extra),
    }


def wait(spark: SparkSession, queries: Sequence[StreamingQuery]) -> None:
    """Block until all streams have ended. An interrupt stops them; a failure of one stops
    the others and is raised.
    """
    # Forget streams that ended earlier in this session; the loop looks at its own first.
    spark.streams.resetTerminated()
    try:
        while any(query.isActive for query in queries) and not _failures(queries):
            try:
                spark.streams.awaitAnyTermination()
            except StreamingQueryException:
                pass
            spark.streams.resetTerminated()
    except KeyboardInterrupt:
        pass
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
    for failure in _failures(queries):
        raise failure


def _failures(queries: Sequence[StreamingQuery]) -> list[StreamingQueryException]:
    return [error for query in queries if (error := query.exception()) is not None]
