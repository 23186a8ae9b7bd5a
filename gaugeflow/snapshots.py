"""Datasets of dated folders behind a manifest, switched as a whole.

A change writes its rows into a folder of its own, ``version=<n>-<id>/event_date=<day>/``, and
then commits manifest ``n``: which folders make up each day, and the last batch of each stream
that is in them. Readers take the newest manifest. A change that dies before its commit leaves
a folder that no manifest names; the dataset stays as it was. Two changes cannot commit the
same number: the second one fails and can be repeated on top of the first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection
from dataclasses import dataclass, field

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MANIFESTS = "_manifests"
DAY = "event_date"
# A day in more folders than this is written anew by the next change that adds to it.
MOST_FOLDERS = 16


class ConflictError(RuntimeError):
    """Another change was committed in the meantime."""


@dataclass(frozen=True)
class Snapshot:
    """``days`` has the folders of each day, ``marks`` the last batch taken of each stream."""

    version: int = 0
    days: dict[str, list[str]] = field(default_factory=dict)
    marks: dict[str, int] = field(default_factory=dict)


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The Hadoop file system of a path, and the path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names_in(spark: SparkSession, folder: str) -> list[str]:
    files, where = file_system(spark, folder)
    if not files.exists(where):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(where))


def delete(spark: SparkSession, path: str) -> None:
    files, where = file_system(spark, path)
    files.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    files, where = file_system(spark, path)
    out = files.create(where, True)
    try:
        out.write(text.encode())
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    files, where = file_system(spark, path)
    stream = files.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions of the dataset, oldest first."""
    found = names_in(spark, f"{path}/{MANIFESTS}")
    return sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json") and n[0] != ".")


def _manifest(path: str, version: int) -> str:
    return f"{path}/{MANIFESTS}/{version:012d}.json"


def load(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """A committed version, by default the newest; None for a dataset without manifests."""
    known = versions(spark, path)
    if version is not None and version not in known:
        raise ValueError(f"no version {version} of {path}")
    if not known:
        return None
    return Snapshot(**json.loads(read_text(spark, _manifest(path, version or known[-1]))))


def commit(spark: SparkSession, path: str, snapshot: Snapshot) -> None:
    """Make ``snapshot`` the newest version, or raise if its number is taken."""
    beside = f"{path}/{MANIFESTS}/.{uuid.uuid4().hex}"
    write_text(spark, beside, json.dumps(vars(snapshot)))
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        jvm.org.apache.hadoop.fs.Path(path).toUri(), spark._jsc.hadoopConfiguration()
    ) if "://" in path else jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        spark._jsc.hadoopConfiguration()
    )
    # Without the option to overwrite, a rename onto a file that exists fails.
    options = spark.sparkContext._gateway.new_array(
        getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0
    )
    target = jvm.org.apache.hadoop.fs.Path(_manifest(path, snapshot.version))
    try:
        context.rename(jvm.org.apache.hadoop.fs.Path(beside), target, options)
    except Exception as error:
        delete(spark, beside)
        if "FileAlreadyExists" in str(error):
            raise ConflictError(f"version {snapshot.version} of {path} exists") from error
        raise


def read(
    spark: SparkSession, path: str, snapshot: Snapshot, schema: StructType,
    days: Collection[str] | None = None,
) -> DataFrame:
    """The rows of a version, or of some of its days."""
    chosen = snapshot.days if days is None else {d: snapshot.days[d] for d in days if d in snapshot.days}
    folders = [f"{path}/{folder}" for own in chosen.values() for folder in own]
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return rows.select(*schema.names)


def change(
    spark: SparkSession, path: str, before: Snapshot, rows: DataFrame, replaced: Collection[str],
    marks: dict[str, int], by: str = DAY,
) -> Snapshot:
    """Commit ``rows``: days in ``replaced`` have them alone, others have them in addition.

    A dataset can have other parts than days, by the values of column ``by``.
    """
    version = before.version + 1
    name = f"version={version:012d}-{uuid.uuid4().hex}"
    rows.write.partitionBy(by).parquet(f"{path}/{name}")
    days = {day: folders for day, folders in before.days.items() if day not in replaced}
    for folder in names_in(spark, f"{path}/{name}"):
        if folder.startswith(f"{by}="):
            day = folder.removeprefix(f"{by}=")
            days[day] = [*days.get(day, []), f"{name}/{folder}"]
    after = Snapshot(version, days, before.marks | marks)
    commit(spark, path, after)
    return after


def drop_old(spark: SparkSession, path: str, keep: int) -> None:
    """Remove all but the last ``keep`` versions, and folders that none of these name.

    Folders of a change that is not committed yet have a higher number and stay.
    """
    if keep < 1:
        raise ValueError("at least one version must stay")
    known = versions(spark, path)
    if not known:
        return
    held = [load(spark, path, version) for version in known[-keep:]]
    used = {folder for snapshot in held for own in snapshot.days.values() for folder in own}
    for version in known[:-keep]:
        delete(spark, _manifest(path, version))
    for name in names_in(spark, path):
        if not name.startswith("version="):
            continue
        if int(name.removeprefix("version=").split("-")[0]) > known[-1]:
            continue
        for folder in names_in(spark, f"{path}/{name}"):
            if f"{name}/{folder}" not in used:
                delete(spark, f"{path}/{name}/{folder}")
        if not names_in(spark, f"{path}/{name}"):
            delete(spark, f"{path}/{name}")
