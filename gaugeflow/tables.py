"""Catalog tables: create, list, drop, and full-refresh materialisation."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gaugeflow import schemas

_VERSION = re.compile(r"__v[0-9a-f]{32}")

TABLES = {
    "raw_telemetry": schemas.telemetry,
    "validated_telemetry": schemas.quality,
    "anomaly_alerts": schemas.quality,
    "dead_letter_queue": schemas.dead_letter,
}


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    """Create a namespace if it is missing; its tables lie in ``location``, or the warehouse."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}{where}")


def create_tables(spark: SparkSession, namespace: str, file_format: str = "parquet") -> list[str]:
    """Create the tables that are missing, empty; returns the names of the new ones.

    Partitioned by event date, so that a window skips files, and below that by stream and
    batch, so that a replayed batch replaces what it wrote and nothing else.
    """
    create_namespace(spark, namespace)
    created = []
    for name, schema in TABLES.items():
        table = f"{namespace}.{name}"
        if spark.catalog.tableExists(table):
            continue
        columns = schema().add("event_date", T.DateType()).add(schemas.LANDED, T.StringType())
        empty = spark.createDataFrame([], columns)
        empty.write.format(file_format).partitionBy("event_date", schemas.LANDED).saveAsTable(table)
        created.append(name)
    return created


def list_tables(spark: SparkSession, namespace: str) -> list[str]:
    """Names of tables, of materialised ones without their versions."""
    return [name for name in _all_tables(spark, namespace) if not _VERSION.search(name)]


def _all_tables(spark: SparkSession, namespace: str) -> list[str]:
    rows = spark.sql(f"SHOW TABLES IN {namespace}").filter("NOT isTemporary").select("tableName")
    return sorted(row.tableName for row in rows.collect())


def drop_tables(spark: SparkSession, namespace: str) -> None:
    for name in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {namespace}.{name}")


def materialise(rows: DataFrame, table: str, file_format: str = "parquet") -> None:
    """Replace a table by a query's result.

    The result is written whole as a new version; then the view that has the table's name is
    pointed at it, which is one statement of the catalog. Readers find the old version or the
    new one, at any time. A run that dies leaves the view as it was; what it has written is
    removed by the next one. The version before stays, for readers that have begun. A table of
    a named catalog is replaced by that catalog in one step.
    """
    namespace, _, name = table.rpartition(".")
    if "." in namespace:
        rows.writeTo(table).using(file_format).createOrReplace()
        return
    spark = rows.sparkSession
    now = _current(spark, namespace, name)
    fresh = f"{name}__v{uuid.uuid4().hex}"
    rows.write.format(file_format).saveAsTable(f"{namespace}.{fresh}")
    if now is None and spark.catalog.tableExists(table):
        # Made before tables had versions: it becomes one, once.
        now = f"{name}__v{uuid.uuid4().hex}"
        spark.sql(f"ALTER TABLE {table} RENAME TO {namespace}.{now}")
    _point(spark, table, f"{namespace}.{fresh}")
    _drop_versions(spark, namespace, name, {fresh, now})


def _point(spark: SparkSession, view: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {version}")


def _current(spark: SparkSession, namespace: str, name: str) -> str | None:
    """The version that a materialised table shows."""
    if not spark.catalog.tableExists(f"{namespace}.{name}"):
        return None
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {namespace}.{name}").filter("col_name = 'View Text'")
    found = [_VERSION.search(row.data_type) for row in told.select("data_type").collect()]
    return f"{name}{found[0][0]}" if found and found[0] else None


def _drop_versions(spark: SparkSession, namespace: str, name: str, kept: set) -> None:
    for other in _all_tables(spark, namespace):
        if re.fullmatch(re.escape(name) + _VERSION.pattern, other) and other not in kept:
            spark.sql(f"DROP TABLE IF EXISTS {namespace}.{other}")
