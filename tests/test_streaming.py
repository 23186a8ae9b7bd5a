"""Stream equals batch, replays add nothing, and branches publish whole dates."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from gaugeflow import tables
from gaugeflow.branches import AuditError, Branch, publish
from gaugeflow.functions.clock import DAY_MS
from gaugeflow.operators.rules import TimeLimits
from gaugeflow.plans import device_models
from gaugeflow.sources import events
from gaugeflow.sources.messages import file_messages
from gaugeflow.sources.stores import DatasetStore, FrameStore, TableStore
from gaugeflow.streaming import ingest, rollup
from oracle import canonical, spark_rows

LIMITS = TimeLimits(max_age_ms=events.MAX_AGE_MS)
COMPARED = [
    "event_id", "device_id", "device_type", "timestamp", "gate", "reason", "event_date",
    "quality_status", "anomaly_score", "kafka_key", "topic", "partition", "offset", "value",
]


def plain(rows):
    """Rows without the clock of the run, with the map as text."""
    shown = rows.select(*COMPARED, F.to_json("readings").alias("r"), F.to_json("metadata").alias("m"))
    return canonical(shown.columns, [tuple(r) for r in shown.collect()])


def gated(messages):
    return ingest.gate_messages(messages, events.AS_OF_MS, limits=LIMITS)


@pytest.fixture(scope="module")
def topic(spark, tiny, tmp_path_factory):
    """Messages as files, as they would arrive in three deliveries; the last one is late."""
    base = tmp_path_factory.mktemp("topic")
    messages = events.to_messages(events.read_events(spark, tiny), faulty=True)
    parts = []
    for i in range(3):
        part = base / f"part{i}"
        rows = messages.filter(F.col("offset").between(i * 334, i * 334 + 333))
        rows.coalesce(1).write.parquet(str(part))
        parts.append(part)
    return messages, parts


def deliver(part, inbox):
    inbox.mkdir(exist_ok=True)
    for file in part.glob("*.parquet"):
        shutil.copy(file, inbox / file.name)


def land(spark, inbox, path, checkpoint, **options):
    rows = gated(file_messages(spark, str(inbox)))
    query = ingest.start_dataset_sink(rows, path, checkpoint, trigger=None, **options)
    query.awaitTermination()


def test_stream_equals_batch_and_replay_adds_nothing(spark, topic, tmp_path):
    messages, parts = topic
    inbox, path, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    deliver(parts[0], inbox)
    deliver(parts[1], inbox)
    land(spark, inbox, path, checkpoint)
    before = DatasetStore(spark, path).rows().count()
    land(spark, inbox, path, checkpoint)
    assert DatasetStore(spark, path).rows().count() == before == 668
    deliver(parts[2], inbox)
    land(spark, inbox, path, checkpoint, write_tasks=16)
    assert plain(DatasetStore(spark, path).rows()) == plain(gated(messages))


def test_wall_clock_stream(spark, topic, tmp_path):
    """Without a fixed instant the batch's own clock judges: old rows are stale."""
    deliver(topic[1][0], tmp_path / "in")
    rows = ingest.gate_messages(file_messages(spark, str(tmp_path / "in")))
    path = str(tmp_path / "out")
    ingest.start_dataset_sink(rows, path, str(tmp_path / "cp"), trigger=None).awaitTermination()
    gates = {r.gate for r in spark.read.parquet(path).select("gate").distinct().collect()}
    assert gates == {"ANOMALY", "SCHEMA", "INDETERMINATE"}


def test_dataset_store_prunes_and_keeps_all(spark, topic, tmp_path):
    messages, _ = topic
    path = str(tmp_path / "data")
    rows = gated(messages)
    rows.write.partitionBy("event_date", "gate").parquet(path)
    store, frame = DatasetStore(spark, path), FrameStore(rows)
    for since in (None, 0, events.AS_OF_MS - DAY_MS, events.AS_OF_MS - 12 * DAY_MS - 1):
        for view in ("raw", "validated", "anomalies"):
            got, want = getattr(store, view)(since), getattr(frame, view)(since)
            assert got.columns == want.columns
            assert got.count() == want.count()
    plan = store.validated(events.AS_OF_MS - DAY_MS)._jdf.queryExecution().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "gate#" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "event_date#" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(timestamp," in scan.split("PushedFilters")[1]


def test_pruning_keeps_rows_with_folded_dates(spark, topic, tmp_path):
    """Event times beyond the limits lie in end partitions and are still found."""
    messages, _ = topic
    tight = TimeLimits(max_future_ms=0, max_age_ms=DAY_MS)
    middle = events.AS_OF_MS - 10 * DAY_MS
    rows = ingest.gate_messages(messages, middle, limits=tight)
    path = str(tmp_path / "data")
    rows.write.partitionBy("event_date", "gate").parquet(path)
    assert spark.read.parquet(path).select("event_date").distinct().count() <= 4
    for days in (2, 12, 25):
        since = events.AS_OF_MS - days * DAY_MS
        got = DatasetStore(spark, path).anomalies(since).count()
        assert got == FrameStore(rows).anomalies(since).count() > 0


def test_table_sink_routes_and_replays(spark, topic, tmp_path):
    messages, parts = topic
    namespace = Branch(str(tmp_path), "feature-x").namespace
    assert namespace == "iot_monitoring__feature_x"
    assert tables.create_tables(spark, namespace) == list(tables.TABLES)
    assert tables.create_tables(spark, namespace) == []
    assert tables.list_tables(spark, namespace) == sorted(tables.TABLES)
    for part in parts:
        deliver(part, tmp_path / "in")
    rows = gated(file_messages(spark, str(tmp_path / "in"), max_files_per_trigger=1))
    want = {name: frame.count() for name, frame in ingest.routes(gated(messages)).items()}
    for _ in range(2):
        ingest.start_table_sink(
            rows, namespace, str(tmp_path / "cp"), trigger=None
        ).awaitTermination()
        store = TableStore(spark, namespace)
        views = (store.raw(), store.validated(), store.anomalies(), store.dead_letters())
        assert dict(zip(tables.TABLES, (v.count() for v in views))) == want
        # The stream has not noted that its last batch is done, so it runs again.
        for file in (tmp_path / "cp" / "commits").glob("*2*"):
            file.unlink()
    assert store.validated(events.AS_OF_MS - DAY_MS).count() == FrameStore(
        gated(messages)
    ).validated(events.AS_OF_MS - DAY_MS).count()
    health = device_models.device_health(store, events.AS_OF_MS, 30 * DAY_MS)
    same = device_models.device_health(FrameStore(gated(messages)), events.AS_OF_MS, 30 * DAY_MS)
    assert spark_rows(health) == spark_rows(same)
    tables.drop_tables(spark, namespace)
    assert tables.list_tables(spark, namespace) == []
    tables.drop_tables(spark, namespace)


def test_branches_and_publish(spark, topic, tmp_path):
    messages, parts = topic
    main, feature = Branch(str(tmp_path)), Branch(str(tmp_path), "feature")
    assert main.namespace == "iot_monitoring"
    assert main.checkpoint() != feature.checkpoint()
    with pytest.raises(ValueError):
        Branch(str(tmp_path), "../main")

    deliver(parts[0], tmp_path / "in")
    land(spark, tmp_path / "in", main.landing, main.checkpoint())
    first = publish(spark, main).rows()
    assert plain(first) == plain(DatasetStore(spark, main.landing).rows())

    # The feature branch sees all deliveries; publishing it replaces its dates in main.
    for part in parts:
        deliver(part, tmp_path / "in-feature")
    land(spark, tmp_path / "in-feature", feature.landing, feature.checkpoint())
    assert DatasetStore(spark, main.landing).rows().count() == 334
    for _ in range(2):
        assert plain(publish(spark, feature, main).rows()) == plain(gated(messages))

    # A landing that holds less than what is published for its dates takes nothing away.
    deliver(parts[1], tmp_path / "less")
    less = Branch(str(tmp_path), "less")
    rows = gated(file_messages(spark, str(tmp_path / "less"), stream=False)).limit(5)
    rows.write.partitionBy("event_date", "gate").parquet(less.landing)
    publish(spark, less, main)
    assert plain(DatasetStore(spark, main.published).rows()) == plain(gated(messages))
    publish(spark, less, main, replace=True)
    dates = {r.event_date for r in rows.select("event_date").distinct().collect()}
    kept = gated(messages).filter(~F.col("event_date").isin(*dates)).count()
    assert DatasetStore(spark, main.published).rows().count() == kept + 5


def test_publish_removes_gates_a_date_no_longer_has(spark, topic, tmp_path):
    messages, _ = topic
    old, new = Branch(str(tmp_path), "old"), Branch(str(tmp_path), "new")
    rows = gated(messages)
    rows.write.partitionBy("event_date", "gate").parquet(old.landing)
    relabelled = rows.withColumn("gate", F.lit("PASSED"))
    relabelled.write.partitionBy("event_date", "gate").parquet(new.landing)
    publish(spark, old, new)
    publish(spark, new)
    counts = DatasetStore(spark, new.published).rows().groupBy("gate").count().collect()
    assert [tuple(r) for r in counts] == [("PASSED", 1000)]


def test_audit_rejects_unknown_gates(spark, topic, tmp_path):
    branch = Branch(str(tmp_path))
    rows = gated(topic[0]).withColumn("gate", F.lit("MAYBE"))
    rows.write.partitionBy("event_date", "gate").parquet(branch.landing)
    with pytest.raises(AuditError):
        publish(spark, branch)


def test_rollup_emits_each_closed_hour_once(spark, topic, tmp_path):
    messages, parts = topic
    for part in parts:
        deliver(part, tmp_path / "in")
    rows = gated(file_messages(spark, str(tmp_path / "in")))
    path = str(tmp_path / "hours")
    for _ in range(2):
        rollup.start_rollup(
            rows, path, str(tmp_path / "cp"), delay="1 day", trigger=None
        ).awaitTermination()
    got = spark.read.parquet(path)
    batch = rollup.hourly_aggregates(gated(messages))
    newest = gated(messages).filter("gate = 'PASSED'").agg(F.max("timestamp")).first()[0]
    bound = F.expr(
        f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {newest / 1000:.3f}BD)"
        " - interval '1' day - interval '1' hour"
    )
    closed = batch.filter(F.col("hour") <= bound)
    assert got.count() > 0
    assert canonical(got.columns, [tuple(r) for r in got.collect()]) == canonical(
        closed.columns, [tuple(r) for r in closed.collect()]
    )


def test_whole_delay_covers_both_limits():
    assert rollup.whole_delay(TimeLimits(1_000, 5_000)) == "6 seconds"
    assert rollup.whole_delay() == f"{7 * 86400 + 3600} seconds"


def test_wait_raises_the_failure_of_one_stream_and_stops_the_others(spark, topic, tmp_path):
    deliver(topic[1][0], tmp_path / "in")
    rows = gated(file_messages(spark, str(tmp_path / "in")))
    endless = ingest.start_dataset_sink(rows, str(tmp_path / "out"), str(tmp_path / "cp"))
    broken = rows.withColumn("value", F.raise_error(F.lit("broken on purpose")).cast("string"))
    failing = ingest.start_dataset_sink(
        broken, str(tmp_path / "out2"), str(tmp_path / "cp2"), trigger=None
    )
    with pytest.raises(Exception, match="broken on purpose"):
        ingest.wait(spark, [endless, failing])
    assert not endless.isActive


def test_landing_in_many_batches_with_clean_up_loses_nothing(spark, topic, tmp_path):
    """One file per batch, published and cleaned up in between, late rows for old dates."""
    messages, _ = topic
    branch = Branch(str(tmp_path))
    for number, part in enumerate(messages.randomSplit([1.0] * 5, seed=3)):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        rows = gated(file_messages(spark, str(tmp_path / "in"), max_files_per_trigger=1))
        ingest.start_dataset_sink(
            rows, branch.landing, branch.checkpoint(), trigger=None
        ).awaitTermination()
        publish(spark, branch, since_date="2024-01-20" if number == 4 else None)
        if number < 3:
            shutil.rmtree(branch.landing)
    got = DatasetStore(spark, branch.published).rows()
    late = gated(messages).filter("event_date < DATE'2024-01-20' AND event_date > DATE'0001-01-01'")
    missing = gated(messages).join(got, ["topic", "partition", "offset"], "left_anti")
    # All but what the last, limited publish was told to leave.
    assert missing.join(late, ["topic", "partition", "offset"], "left_anti").count() == 0
    assert got.count() == got.select("topic", "partition", "offset").distinct().count()
    publish(spark, branch)
    assert plain(DatasetStore(spark, branch.published).rows()) == plain(gated(messages))


def test_publish_since_a_date_takes_old_events_along(spark, topic, tmp_path):
    branch = Branch(str(tmp_path))
    old = gated(topic[0]).withColumn("event_date", F.lit("0001-01-01").cast("date"))
    old.write.partitionBy("event_date", "gate").parquet(branch.landing)
    assert publish(spark, branch, since_date="2024-01-20").rows().count() == 1000


def test_streams_read_a_table_that_is_a_folder(spark, tiny, tmp_path):
    table = events.read_events(spark, tiny)
    table.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    seen = []
    query = events.stream_events(spark, str(tmp_path), max_files_per_trigger=1)
    query.writeStream.foreachBatch(lambda batch, _: seen.append(batch.count())).option(
        "checkpointLocation", str(tmp_path / "cp")
    ).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 4 and sum(seen) == table.count()


def test_closed_and_open_hours_are_every_hour_once(spark, topic, tmp_path):
    messages, parts = topic
    for part in parts:
        deliver(part, tmp_path / "in")
    rows = gated(file_messages(spark, str(tmp_path / "in"), max_files_per_trigger=1))
    branch = Branch(str(tmp_path))
    land(spark, tmp_path / "in", branch.landing, branch.checkpoint())
    whole = rollup.hourly_aggregates(gated(messages))
    whole.filter("device_id < 'm'").write.parquet(str(tmp_path / "hours"))
    closed = spark.read.parquet(str(tmp_path / "hours"))
    got = rollup.complete(closed, DatasetStore(spark, branch.landing))
    assert canonical(got.columns, [tuple(r) for r in got.collect()]) == canonical(
        whole.columns, [tuple(r) for r in whole.collect()]
    )
    assert rows.isStreaming
