"""Branches: isolated copies of the pipeline, and publishing from one to another.

A branch is a namespace and a set of folders. Streams of a branch own its landing
dataset; published data lives in a dataset of its own, in larger files and behind a manifest.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow import snapshots
from gaugeflow.operators.gates import GATES, far_off, is_far_off
from gaugeflow.schemas import LANDED, gated
from gaugeflow.sources.stores import DatasetStore
from gaugeflow.streaming import ledger

MAIN = "main"
NAMESPACE = "iot_monitoring"


@dataclass(frozen=True)
class Branch:
    """Where a branch keeps its things. ``root`` is a folder all executors share."""

    root: str
    name: str = MAIN
    catalog: str | None = None

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", self.name):
            raise ValueError(f"not a branch name: {self.name!r}")

    @property
    def namespace(self) -> str:
        """Schema of the branch's tables; the main branch has the plain name."""
        suffix = "" if self.name == MAIN else "__" + re.sub(r"\W", "_", self.name)
        prefix = f"{self.catalog}." if self.catalog else ""
        return f"{prefix}{NAMESPACE}{suffix}"

    @property
    def landing(self) -> str:
        return f"{self.root}/{self.name}/landing"

    @property
    def published(self) -> str:
        return f"{self.root}/{self.name}/published"

    @property
    def rollup(self) -> str:
        return f"{self.root}/{self.name}/hourly"

    def checkpoint(self, stream: str = "unified") -> str:
        return f"{self.root}/{self.name}/checkpoints/{stream}"


class AuditError(ValueError):
    """The data of a branch is not fit to publish."""


# What tells one message from another.
KEY = ["topic", "partition", "offset"]
_WHOLE = " AND ".join(f"`{k}` IS NOT NULL" for k in KEY)
# A message without a whole key is told by what it says.
_CONTENT = [
    "kafka_key", "kafka_timestamp", "event_id", "device_id", "device_type", "timestamp",
    "readings", "metadata", "value", *KEY,
]


def audit(landing: DataFrame) -> None:
    """Raise unless every row has a known gate."""
    stray = landing.filter(F.col("gate").isNull() | ~F.col("gate").isin(*GATES))
    if not stray.isEmpty():
        raise AuditError("rows without a known gate")


def _broken(rows: DataFrame) -> DataFrame:
    """Rows without a whole key, with a digest of their message."""
    told = F.sha2(F.to_json(F.struct(*_CONTENT)), 256)
    return rows.filter(f"NOT ({_WHOLE})").withColumn("_content", told)


def _compared(rows: DataFrame, others: DataFrame, how: str) -> DataFrame:
    """Rows whose message is among ``others`` (left_semi) or is not (left_anti).

    Of rows with a whole key only the key is read for this.
    """
    keyed = rows.filter(_WHOLE).join(others.filter(_WHOLE).select(*KEY), KEY, how)
    rest = _broken(rows).join(_broken(others).select("_content"), "_content", how)
    return keyed.unionByName(rest.drop("_content"))


def _once(rows: DataFrame) -> DataFrame:
    """Of a message that several streams have landed, the row judged last.

    A message without a whole key is taken from one of the streams, as often as it is there.
    """
    stream = F.substring_index(LANDED, "-", 5)
    newest = Window.partitionBy(*KEY).orderBy(F.desc("processing_time"), F.desc(LANDED))
    keyed = rows.filter(_WHOLE).withColumn("_rank", F.row_number().over(newest))
    first = Window.partitionBy("_content").orderBy("_stream")
    rest = _broken(rows).withColumn("_stream", stream).withColumn("_rank", F.rank().over(first))
    both = keyed.unionByName(rest.drop("_content", "_stream"))
    return both.filter("_rank = 1").drop("_rank")


def landed_rows(spark: SparkSession, landing: str) -> DataFrame:
    """The landing dataset with the batch of each row; null in rows that no stream landed."""
    schema = gated().add(LANDED, "string")
    return spark.read.schema(schema).parquet(landing).select(*schema.names)


def up_to(marks: dict[str, int]) -> Column:
    """Rows of batches that are not beyond the marks; a test on partitions alone."""
    stream = F.substring_index(LANDED, "-", 5)
    number = F.substring_index(LANDED, "-", -1).cast("bigint")
    known = [(stream == name) & (number <= mark) for name, mark in marks.items()]
    return functools.reduce(Column.__or__, known, F.lit(False))


def publish(
    spark: SparkSession,
    source: Branch,
    target: Branch | None = None,
    *,
    since_date: str | None = None,
    replace: bool = False,
) -> DatasetStore:
    """Take the batches that streams of a branch have landed since the last publish into the
    published dataset of ``target``.

    A message is in the published dataset once: by topic, partition and offset, or by its
    content where one of these is missing. A message that is landed again replaces its former
    row, whatever its date. Repeating a publish changes nothing, and landing data that were
    cleaned up after a publish take nothing away. ``replace`` makes all landing data the
    authority for their dates instead. Rows that no stream has landed (batch jobs write
    without the partition of a batch) are taken every time.

    The work follows the new rows: they are added in folders of their own, and the keys of the
    dates they touch are read. Only dates with a message that is landed again, and dates in
    many folders, are written anew. All of it shows at once, when the manifest is committed,
    with the last batch taken of each stream in it; a publish that dies before leaves the
    former version whole, and the next one takes the same batches.

    Small stream files become files of the advisory size: the rebalance gathers each date
    and splits a large one by its measured size over many tasks; within a date rows are sorted
    by gate and device, so that a reader of one gate skips row groups of the others.
    ``since_date`` limits the work to recent event dates and those of far-off event times; the
    batches then count as not taken.
    """
    target = target or source
    before = snapshots.load(spark, target.published) or snapshots.Snapshot()
    known = {} if replace else before.marks
    marks = ledger.beyond(spark, source.landing, known)
    landing = landed_rows(spark, source.landing)
    unnumbered = not landing.filter(F.col(LANDED).isNull()).isEmpty()
    new = F.col(LANDED).isNull() | (up_to(marks) & ~up_to(known))
    fresh = landing.filter(new)
    if since_date is not None:
        recent = F.col("event_date") >= F.lit(since_date).cast("date")
        fresh = fresh.filter(recent | far_off())
    if not marks and not unnumbered:
        return DatasetStore(spark, target.published)
    audit(fresh)
    if len(marks) + unnumbered > 1:
        fresh = _once(fresh)
    fresh = fresh.select(*gated().names)
    day = F.col("event_date").cast("string")
    touched = {r.day for r in fresh.select(day.alias("day")).distinct().collect()}
    rows, rewritten = fresh, touched
    if not replace:
        far = {d for d in before.days if is_far_off(d)}
        old = snapshots.read(spark, target.published, before, gated(), touched | far)
        clashing = _compared(old, fresh, "left_semi").select(day.alias("day")).distinct()
        many = {d for d in touched if len(before.days.get(d, ())) >= snapshots.MOST_FOLDERS}
        rewritten = many | {r.day for r in clashing.collect()}
        if rewritten:
            former = snapshots.read(spark, target.published, before, gated(), rewritten)
            rows = fresh.unionByName(_compared(former, fresh, "left_anti"))
    snapshots.change(
        spark,
        target.published,
        before,
        rows.hint("rebalance", "event_date").sortWithinPartitions(
            "event_date", "gate", "device_id", "timestamp"
        ),
        rewritten,
        {} if since_date is not None else marks,
    )
    return DatasetStore(spark, target.published)


def clean(
    spark: SparkSession, source: Branch, target: Branch | None = None, *, keep: int = 2
) -> list[str]:
    """Remove landed batches that are proven to be in the published dataset of ``target``.

    A batch is removed if the manifest has it and every one of its messages is found among the
    published ones; a batch with a message that is not raises an error and nothing is
    removed. Batches that were landed later stay, and so do rows that no stream landed. Entries
    of removed batches move to the report. Of the published dataset the last ``keep`` versions
    stay readable. Returns the names of the removed batches.
    """
    target = target or source
    now = snapshots.load(spark, target.published) or snapshots.Snapshot()
    done = [b for b in ledger.landed(spark, source.landing) if b.number <= now.marks.get(b.stream, -1)]
    if done:
        if snapshots.names_in(spark, source.landing):
            landing = landed_rows(spark, source.landing).filter(up_to(now.marks))
            published = snapshots.read(spark, target.published, now, gated())
            if not _compared(landing, published, "left_anti").isEmpty():
                raise AuditError("landed messages that are not published")
        names = {f"{LANDED}={b.name}" for b in done}
        for date in snapshots.names_in(spark, source.landing):
            for gate in _folders(spark, f"{source.landing}/{date}", "gate="):
                for batch in _folders(spark, gate, f"{LANDED}="):
                    if batch.rpartition("/")[2] in names:
                        snapshots.delete(spark, batch)
        ledger.fold(spark, source.landing, done)
    if now.version:
        snapshots.drop_old(spark, target.published, keep)
    return sorted(b.name for b in done)


def _folders(spark: SparkSession, folder: str, kind: str) -> list[str]:
    names = snapshots.names_in(spark, folder) if "=" in folder.rpartition("/")[2] else []
    return [f"{folder}/{name}" for name in names if name.startswith(kind)]
