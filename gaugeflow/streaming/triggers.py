"""When a stream runs its batches."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter

# Fixed value: time between micro-batches.
TRIGGER = "10 seconds"


def triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """Without a trigger the stream works off what is there and stops."""
    if trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)
