"""Gated telemetry behind one small interface.

Models ask a store for validated, anomalous or raw rows, optionally from a time on. Each
store applies the time bound in the form its files can prune on.
"""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import schemas, snapshots
from gaugeflow.operators import gates
from gaugeflow.operators.dead_letter import dead_letters
from gaugeflow.operators.rules import LIVE, RangeRule, TimeLimits
from gaugeflow.schemas import DEAD_LETTER_COLUMNS, QUALITY_COLUMNS, TELEMETRY_COLUMNS
from gaugeflow.sources import events


class TelemetryStore(ABC):
    """Source of the tables that models and dashboards read."""

    @abstractmethod
    def raw(self, since_ms: int | None = None) -> DataFrame:
        """Audit rows: the six telemetry columns of every message."""

    @abstractmethod
    def validated(self, since_ms: int | None = None) -> DataFrame:
        """Rows that passed, with quality columns."""

    @abstractmethod
    def anomalies(self, since_ms: int | None = None) -> DataFrame:
        """Rows that broke a rule, with quality columns."""

    @abstractmethod
    def tagged(self, since_ms: int | None = None) -> DataFrame:
        """Telemetry with ``gate`` and quality columns, for one pass over several gates.

        Passed and anomalous rows occur once under their gate. What other rows look like
        depends on the store.
        """

    def register_views(self) -> None:
        """Expose the three tables to ``spark.sql`` under their usual names."""
        self.raw().createOrReplaceTempView("raw_telemetry")
        self.validated().createOrReplaceTempView("validated_telemetry")
        self.anomalies().createOrReplaceTempView("anomaly_alerts")


class GatedStore(TelemetryStore):
    """A store over one dataset of rows tagged with their gate."""

    @abstractmethod
    def rows(self, since_ms: int | None = None) -> DataFrame:
        """All rows with gate and quality columns, from ``since_ms`` on."""

    def raw(self, since_ms: int | None = None) -> DataFrame:
        return gates.raw_rows(self.rows(since_ms))

    def validated(self, since_ms: int | None = None) -> DataFrame:
        return gates.passed_rows(self.rows(since_ms))

    def anomalies(self, since_ms: int | None = None) -> DataFrame:
        return gates.anomaly_rows(self.rows(since_ms))

    def tagged(self, since_ms: int | None = None) -> DataFrame:
        columns = [*TELEMETRY_COLUMNS, *QUALITY_COLUMNS, "gate"]
        return self.rows(since_ms).select(*columns)


class FrameStore(GatedStore):
    """Gated rows already at hand as a DataFrame."""

    def __init__(self, gated: DataFrame):
        self._gated = gated

    def rows(self, since_ms: int | None = None) -> DataFrame:
        return _from(self._gated, since_ms)


class EventsStore(GatedStore):
    """Telemetry derived from the ``events`` table and gated on the fly."""

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        as_of_ms: int = events.AS_OF_MS,
        rules: tuple[RangeRule, ...] = LIVE,
        limits: TimeLimits = TimeLimits(max_age_ms=events.MAX_AGE_MS),
    ):
        self._as_of, self._rules, self._limits = as_of_ms, rules, limits
        self._events = events.read_events(spark, sf_dir)

    def rows(self, since_ms: int | None = None) -> DataFrame:
        rows = events.to_telemetry(events.since(self._events, since_ms))
        return gates.classify(rows, self._as_of, self._rules, self._limits)


class DatasetStore(GatedStore):
    """A gated dataset on files, partitioned by event date.

    The files are listed once, so that all reads of one store, such as the scans of one
    model, see the same data; make a new store to see new files. Of a published dataset this
    is one version, the newest unless another is asked for.
    """

    def __init__(
        self, spark: SparkSession, path: str, file_format: str = "parquet",
        version: int | None = None,
    ):
        found = snapshots.load(spark, path, version)
        if found is not None:
            self._rows = snapshots.read(spark, path, found, schemas.gated())
            return
        rows = spark.read.format(file_format).schema(schemas.gated()).load(path)
        # Landing data have a partition of their own besides.
        self._rows = rows.select(*schemas.gated().names)

    def rows(self, since_ms: int | None = None) -> DataFrame:
        if since_ms is None:
            return self._rows
        return _from(self._rows.filter(gates.dates_from(since_ms)), since_ms)

    def dead_letters(self) -> DataFrame:
        return dead_letters(self._rows)

    def register_views(self) -> None:
        super().register_views()
        self.dead_letters().createOrReplaceTempView("dead_letter_queue")


class TableStore(TelemetryStore):
    """Three separate catalog tables, of any format Spark can read."""

    def __init__(self, spark: SparkSession, namespace: str):
        self._spark, self._namespace = spark, namespace

    def _table(self, name: str, columns: list[str], since_ms: int | None = None) -> DataFrame:
        table = f"{self._namespace}.{name}"
        # Streams replace partitions from a session of their own; drop stale file listings.
        self._spark.catalog.refreshTable(table)
        rows = self._spark.read.table(table)
        if since_ms is not None:
            rows = rows.filter(gates.dates_from(since_ms))
        return _from(rows.select(*columns), since_ms)

    def raw(self, since_ms: int | None = None) -> DataFrame:
        return self._table("raw_telemetry", TELEMETRY_COLUMNS, since_ms)

    def validated(self, since_ms: int | None = None) -> DataFrame:
        return self._table("validated_telemetry", TELEMETRY_COLUMNS + QUALITY_COLUMNS, since_ms)

    def anomalies(self, since_ms: int | None = None) -> DataFrame:
        return self._table("anomaly_alerts", TELEMETRY_COLUMNS + QUALITY_COLUMNS, since_ms)

    def tagged(self, since_ms: int | None = None) -> DataFrame:
        passed = self.validated(since_ms).withColumn("gate", F.lit(gates.PASSED))
        anomalous = self.anomalies(since_ms).withColumn("gate", F.lit(gates.ANOMALY))
        return passed.unionByName(anomalous)

    def dead_letters(self) -> DataFrame:
        return self._table("dead_letter_queue", DEAD_LETTER_COLUMNS)

    def register_views(self) -> None:
        super().register_views()
        self.dead_letters().createOrReplaceTempView("dead_letter_queue")


def _from(rows: DataFrame, since_ms: int | None) -> DataFrame:
    if since_ms is None:
        return rows
    return rows.filter(F.col("timestamp") >= F.lit(since_ms).cast("bigint"))
