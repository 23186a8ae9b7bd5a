"""No row is lost or doubled: snapshots, the ledger of batches, several streams, folded hours."""

from __future__ import annotations

import json
import re
import shutil

import pytest
from pyspark.sql import functions as F

from gaugeflow import snapshots, tables
from gaugeflow.branches import AuditError, Branch, clean, publish
from gaugeflow.functions.clock import DAY_MS
from gaugeflow.operators import gates, sensors
from gaugeflow.operators.rules import TimeLimits
from gaugeflow.plans import device_models, incremental
from gaugeflow.sources import events
from gaugeflow.sources.messages import file_messages
from gaugeflow.sources.stores import DatasetStore, FrameStore, TableStore
from gaugeflow.streaming import ingest, ledger, rollup
from oracle import canonical
from test_streaming import gated, plain

KEY = ["topic", "partition", "offset"]


@pytest.fixture(scope="module")
def messages(spark, tiny, tmp_path_factory):
    """All messages, in four deliveries of files; every tenth has no offset."""
    path = str(tmp_path_factory.mktemp("messages") / "all")
    rows = events.to_messages(events.read_events(spark, tiny), faulty=True)
    part = (F.col("offset") % 4).cast("int").alias("part")
    offset = F.when(F.col("offset") % 10 != 7, F.col("offset"))
    rows.select("*", part).withColumn("offset", offset).repartition("part").write.partitionBy(
        "part"
    ).parquet(path)
    return path


def whole(spark, messages):
    return gated(spark.read.parquet(messages).drop("part"))


def land(spark, folder, branch, stream="unified", files=1, **options):
    rows = gated(file_messages(spark, folder, max_files_per_trigger=files))
    ingest.start_dataset_sink(
        rows, branch.landing, branch.checkpoint(stream), trigger=None, **options
    ).awaitTermination()


def deliver(messages, inbox, *parts):
    inbox.mkdir(exist_ok=True)
    for part in parts:
        for file in sorted((messages / f"part={part}").glob("*.parquet")):
            shutil.copy(file, inbox / f"{part}-{file.name}")
    return str(inbox)


@pytest.fixture
def folder(messages, tmp_path):
    from pathlib import Path

    return lambda name, *parts: deliver(Path(messages), tmp_path / name, *parts)


def test_rows_without_a_key_are_published_once(spark, messages, folder, tmp_path):
    branch = Branch(str(tmp_path))
    land(spark, folder("in", 0, 1, 2, 3), branch)
    for _ in range(3):
        assert publish(spark, branch).rows().count() == 1000
    assert plain(DatasetStore(spark, branch.published).rows()) == plain(whole(spark, messages))
    # Another stream lands everything again, before and after the next publish.
    for stream in ("second", "third"):
        land(spark, folder("in", 0, 1, 2, 3), branch, stream, files=4)
    assert DatasetStore(spark, branch.landing).rows().count() == 3000
    for _ in range(2):
        assert publish(spark, branch).rows().count() == 1000
    assert publish(spark, branch, replace=True).rows().count() == 1000


def test_a_publish_that_dies_leaves_the_old_version(spark, messages, folder, tmp_path, monkeypatch):
    branch = Branch(str(tmp_path))
    land(spark, folder("in", 0, 1), branch)
    before = plain(publish(spark, branch).rows())
    reader = DatasetStore(spark, branch.published)
    land(spark, folder("in", 2), branch)

    def dies(*_):
        raise RuntimeError("killed")

    for step in ("commit", "names_in"):
        with monkeypatch.context() as patched:
            if step == "commit":
                patched.setattr(snapshots, "commit", dies)
            else:
                real = snapshots.names_in
                patched.setattr(
                    snapshots, "names_in",
                    lambda s, f: dies() if "version=" in f else real(s, f),
                )
            with pytest.raises(RuntimeError, match="killed"):
                publish(spark, branch)
        assert plain(DatasetStore(spark, branch.published).rows()) == before
    assert publish(spark, branch).rows().count() == whole(spark, messages).count() * 3 // 4
    assert plain(reader.rows()) == before
    assert plain(DatasetStore(spark, branch.published, version=1).rows()) == before
    # What the dead attempts left is removed, the published data is not.
    left = {n.split("-")[0] for n in snapshots.names_in(spark, branch.published)}
    clean(spark, branch)
    assert left == {"_manifests", "version=000000000001", "version=000000000002"}
    assert DatasetStore(spark, branch.published).rows().count() == 750
    names = snapshots.names_in(spark, branch.published)
    assert sum(n.startswith("version=000000000002") for n in names) == 1


def test_two_changes_cannot_take_the_same_version(spark, messages, folder, tmp_path):
    branch = Branch(str(tmp_path))
    land(spark, folder("in", 0), branch)
    publish(spark, branch)
    former = snapshots.load(spark, branch.published)
    with pytest.raises(snapshots.ConflictError):
        snapshots.commit(spark, branch.published, former)
    assert snapshots.load(spark, branch.published) == former
    assert not [n for n in snapshots.names_in(spark, f"{branch.published}/_manifests") if n[0] == "."]


def test_a_publish_writes_the_new_rows_only(spark, messages, folder, tmp_path):
    branch = Branch(str(tmp_path))
    for part in range(4):
        land(spark, folder("in", part), branch)
        publish(spark, branch)
    now = snapshots.load(spark, branch.published)
    assert now.version == 4 and max(map(len, now.days.values())) > 2
    for version in range(1, 5):
        files = [n for n in snapshots.names_in(spark, branch.published) if n.startswith(f"version={version:012d}")]
        (name,) = files
        assert spark.read.parquet(f"{branch.published}/{name}").count() == 250
    assert plain(DatasetStore(spark, branch.published).rows()) == plain(whole(spark, messages))


def test_days_in_many_folders_are_written_anew(spark, messages, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "MOST_FOLDERS", 2)
    branch = Branch(str(tmp_path))
    for part in range(4):
        land(spark, folder("in", part), branch)
        publish(spark, branch)
    now = snapshots.load(spark, branch.published)
    assert max(map(len, now.days.values())) <= 2
    assert plain(DatasetStore(spark, branch.published).rows()) == plain(whole(spark, messages))


def test_clean_removes_only_what_is_published(spark, messages, folder, tmp_path):
    branch = Branch(str(tmp_path))
    assert clean(spark, branch) == []
    land(spark, folder("in", 0, 1), branch)
    publish(spark, branch)
    land(spark, folder("in", 2), branch)
    removed = clean(spark, branch)
    assert len(removed) == 2
    assert DatasetStore(spark, branch.landing).rows().count() == 250
    assert publish(spark, branch).rows().count() == 750
    report = ledger.report(spark, branch.landing)
    assert report.agg(F.sum("row_count")).first()[0] == 750 and report.count() == 3
    assert len(clean(spark, branch)) == 1 and clean(spark, branch) == []
    assert ledger.report(spark, branch.landing).count() == 3
    land(spark, folder("in", 3), branch)
    assert plain(publish(spark, branch).rows()) == plain(whole(spark, messages))


def test_clean_refuses_a_batch_that_is_not_whole_in_the_published_data(spark, messages, folder, tmp_path):
    branch = Branch(str(tmp_path))
    land(spark, folder("in", 0), branch)
    publish(spark, branch)
    now = snapshots.load(spark, branch.published)
    less = snapshots.Snapshot(now.version + 1, dict(list(now.days.items())[1:]), now.marks)
    snapshots.commit(spark, branch.published, less)
    with pytest.raises(AuditError):
        clean(spark, branch)
    assert DatasetStore(spark, branch.landing).rows().count() == 250


def test_batches_without_an_entry_wait(spark, messages, folder, tmp_path):
    """A batch whose entry is missing may be half written; a publish leaves it for later."""
    branch = Branch(str(tmp_path))
    land(spark, folder("in", 0, 1), branch)
    last = max(ledger.landed(spark, branch.landing), key=lambda b: b.number)
    entry = f"{ledger.folder(branch.landing)}/{last.name}.json"
    text = snapshots.read_text(spark, entry)
    snapshots.delete(spark, entry)
    assert publish(spark, branch).rows().count() == 250
    assert len(clean(spark, branch)) == 1
    snapshots.write_text(spark, entry, text)
    assert publish(spark, branch).rows().count() == 500


def test_report_counts_what_was_landed(spark, messages, folder, tmp_path):
    branch = Branch(str(tmp_path))
    land(spark, folder("in", 0, 1, 2, 3), branch)
    report = ledger.report(spark, branch.landing)
    rows = DatasetStore(spark, branch.landing).rows()
    sums = report.agg(*[F.sum(g.lower()).alias(g) for g in gates.GATES]).first().asDict()
    counted = {r.gate: r["count"] for r in rows.groupBy("gate").count().collect()}
    assert sums == counted and report.count() == 4
    assert report.agg(F.min("first_ms"), F.max("last_ms")).first() == rows.agg(
        F.min("timestamp"), F.max("timestamp")
    ).first()
    one = json.loads(snapshots.read_text(
        spark, f"{ledger.folder(branch.landing)}/{ledger.landed(spark, branch.landing)[0].name}.json"
    ))
    assert sum(one[g.lower()] for g in gates.GATES) == one["row_count"]
    assert ledger.report(spark, str(tmp_path / "nothing")).count() == 0


def test_two_streams_share_tables(spark, messages, folder, tmp_path):
    """Each lands half of the messages, both with batches 0 and 1."""
    namespace = Branch(str(tmp_path), "shared").namespace
    tables.create_tables(spark, namespace)
    for stream, parts in (("a", (0, 1)), ("b", (2, 3))):
        rows = gated(file_messages(spark, folder(stream, *parts), max_files_per_trigger=1))
        ingest.start_table_sink(
            rows, namespace, str(tmp_path / f"cp-{stream}"), trigger=None
        ).awaitTermination()
    store = TableStore(spark, namespace)
    assert store.raw().count() == 1000
    since = events.AS_OF_MS - DAY_MS
    got = store.validated(since)
    assert got.count() == FrameStore(whole(spark, messages)).validated(since).count() > 0
    plan = got._jdf.queryExecution().toString()
    (scan,) = [line for line in plan.splitlines() if "FileScan" in line]
    assert "event_date" in re.search(r"PartitionFilters: \[(.*?)\]", scan)[1]
    tables.drop_tables(spark, namespace)


def test_old_events_are_pruned_by_their_arrival(spark, messages, tmp_path):
    """Three days of arrivals, all of them events from long before."""
    path, tight = str(tmp_path / "data"), TimeLimits(max_age_ms=0)
    base = spark.read.parquet(messages).drop("part")
    parts = []
    for day in (30, 2, 0):
        clock = events.AS_OF_MS + DAY_MS - day * DAY_MS
        rows = ingest.gate_messages(base, clock, limits=tight)
        parts.append(rows)
        rows.write.mode("append").partitionBy("event_date", "gate").parquet(path)
    since = events.AS_OF_MS - DAY_MS
    store = DatasetStore(spark, path)
    want = sum(FrameStore(rows).rows(since).count() for rows in parts)
    assert store.rows(since).count() == want > 0
    dates = spark.read.parquet(path).filter(gates.far_off() & (F.col("event_date") < "1000-01-01"))
    assert dates.select("event_date").distinct().count() == 3
    read = store._rows.filter(gates.dates_from(since)).select("event_date").distinct().collect()
    old = sorted(r.event_date for r in read if r.event_date.year < 1000)
    # The arrivals of 30 days before are skipped, those of the last two days are not.
    assert len(old) == 2
    plan = store.rows(since)._jdf.queryExecution().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "event_date" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    # Data of before, with one date for all old events, is still read.
    legacy = parts[2].withColumn("event_date", F.lit(gates.DATE_PAST).cast("date"))
    legacy.write.partitionBy("event_date", "gate").parquet(str(tmp_path / "legacy"))
    got = DatasetStore(spark, str(tmp_path / "legacy")).rows(since).count()
    assert got == FrameStore(parts[2]).rows(since).count()


# ---- hours -------------------------------------------------------------------------


def by_hour(rows):
    shown = rows.select(
        "device_id", "device_type", "metric", "hour", "reading_count",
        F.round("avg_value", 9).alias("avg_value"), "min_value", "max_value",
    )
    return canonical(shown.columns, [tuple(r) for r in shown.collect()])


def test_hours_are_folded_batch_by_batch(spark, messages, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "MOST_FOLDERS", 2)
    branch = Branch(str(tmp_path))
    want = lambda: by_hour(
        sensors.hourly_sensor_aggregates(DatasetStore(spark, branch.landing), window_ms=None)
    )
    assert rollup.hours(spark, branch.rollup).count() == 0
    for part in range(4):
        land(spark, folder("in", part), branch, hours=branch.rollup)
        assert by_hour(rollup.hours(spark, branch.rollup)) == want()
    now = snapshots.load(spark, branch.rollup)
    assert now.version == 4 and list(now.marks.values()) == [3]
    assert max(map(len, now.days.values())) <= 2
    # A batch that is run again adds nothing.
    shutil.rmtree(tmp_path / "main" / "checkpoints" / "unified" / "commits")
    land(spark, folder("in", 3), branch, hours=branch.rollup)
    assert snapshots.load(spark, branch.rollup).version == 4
    assert by_hour(rollup.hours(spark, branch.rollup)) == want()
    # A second stream folds into the same hours.
    land(spark, folder("other", 1), branch, "second", hours=branch.rollup)
    assert by_hour(rollup.hours(spark, branch.rollup)) == want()


def test_a_fold_that_dies_is_made_up_for(spark, messages, folder, tmp_path, monkeypatch):
    branch = Branch(str(tmp_path))
    land(spark, folder("in", 0), branch, hours=branch.rollup)
    before = by_hour(rollup.hours(spark, branch.rollup))
    with monkeypatch.context() as patched:
        def dies(*_):
            raise RuntimeError("killed")

        patched.setattr(snapshots, "commit", dies)
        with pytest.raises(Exception, match="killed"):
            land(spark, folder("in", 1), branch, hours=branch.rollup)
    assert by_hour(rollup.hours(spark, branch.rollup)) == before
    assert len(ledger.landed(spark, branch.landing)) == 1
    land(spark, folder("in", 1), branch, hours=branch.rollup)
    store = DatasetStore(spark, branch.landing)
    assert by_hour(rollup.hours(spark, branch.rollup)) == by_hour(
        sensors.hourly_sensor_aggregates(store, window_ms=None)
    )


# ---- keyed models ------------------------------------------------------------------


@pytest.mark.parametrize("name, full", [
    ("device_summary_simple", device_models.device_summary),
    ("device_metrics_latest", device_models.device_metrics_latest),
])
def test_incremental_models_equal_full_ones(spark, messages, folder, tmp_path, monkeypatch, name, full):
    branch = Branch(str(tmp_path))
    shown = lambda rows: canonical(rows.columns, [tuple(r) for r in rows.collect()])
    want = lambda: shown(full(DatasetStore(spark, branch.landing)))
    for part in range(3):
        land(spark, folder("in", part), branch)
        if part == 1:  # dies between writing and committing
            with monkeypatch.context() as patched:
                def dies(*_):
                    raise RuntimeError("killed")

                patched.setattr(snapshots, "commit", dies)
                with pytest.raises(RuntimeError, match="killed"):
                    incremental.refresh(spark, branch, name, 4)
        assert 0 < incremental.refresh(spark, branch, name, 4) <= 4
        assert incremental.refresh(spark, branch, name, 4) == 0
        assert shown(incremental.result(spark, branch, name)) == want()


def test_a_refresh_rewrites_only_the_buckets_it_touches(spark, messages, folder, tmp_path):
    branch, name = Branch(str(tmp_path)), "device_metrics_latest"
    land(spark, folder("in", 0, 1), branch)
    incremental.refresh(spark, branch, name, 64)
    path = incremental.path_of(branch, name)
    before = snapshots.load(spark, path).days
    one = spark.read.parquet(messages).drop("part").filter("key = cast('dev-3' AS binary)")
    one.coalesce(1).write.parquet(str(tmp_path / "one"))
    land(spark, str(tmp_path / "one"), branch, "other")
    assert incremental.refresh(spark, branch, name, 64) == 1
    after = snapshots.load(spark, path).days
    assert sum(before.get(b) != after[b] for b in after) == 1
    store = DatasetStore(spark, branch.landing)
    rows = incremental.result(spark, branch, name)
    assert canonical(rows.columns, [tuple(r) for r in rows.collect()]) == canonical(
        rows.columns, [tuple(r) for r in device_models.device_metrics_latest(store).collect()]
    )
