"""Materialised models, session settings and the command line."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gaugeflow import __main__ as cli
from gaugeflow import session, tables
from gaugeflow.branches import Branch
from gaugeflow.plans import incremental
from gaugeflow.plans.registry import DASHBOARDS, MODELS, run_models
from gaugeflow.sources import events
from gaugeflow.sources.messages import encode, file_messages, kafka_messages, parse_envelope
from gaugeflow.sources.stores import DatasetStore, EventsStore
from gaugeflow.streaming import rollup
from oracle import canonical


def content(spark, table):
    rows = spark.read.table(table).drop("updated_at", "dashboard_updated_at")
    return canonical(rows.columns, [tuple(r) for r in rows.collect()])


def test_full_refresh_twice_gives_the_same_tables(spark, tiny):
    store = EventsStore(spark, tiny)
    first = run_models(spark, store, "models_test", events.AS_OF_MS)
    assert first == list(MODELS)
    assert tables.list_tables(spark, "models_test") == sorted(MODELS)
    before = {name: content(spark, f"models_test.{name}") for name in MODELS}
    run_models(spark, store, "models_test", events.AS_OF_MS)
    assert {name: content(spark, f"models_test.{name}") for name in MODELS} == before
    assert before["device_summary_simple"][1]
    with pytest.raises(KeyError):
        run_models(spark, store, "models_test", names=["nothing"])


def test_a_failed_refresh_leaves_the_table(spark):
    tables.create_namespace(spark, "refresh_test")
    tables.materialise(spark.range(3), "refresh_test.kept")
    failing = spark.range(5).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.materialise(failing, "refresh_test.kept")
    assert spark.read.table("refresh_test.kept").count() == 3
    tables.materialise(spark.range(7), "refresh_test.kept")
    assert spark.read.table("refresh_test.kept").count() == 7
    assert tables.list_tables(spark, "refresh_test") == ["kept"]


def test_a_refresh_that_dies_at_any_step(spark, monkeypatch):
    """Readers find the table at every step, and the next refresh clears up."""
    tables.create_namespace(spark, "steps_test")
    tables.materialise(spark.range(2), "steps_test.t")
    count = lambda: spark.read.table("steps_test.t").count()

    def dies(*_):
        assert count() == 2
        raise RuntimeError("killed")

    for step in ("_point", "_current"):
        with monkeypatch.context() as patched:
            patched.setattr(tables, step, dies)
            with pytest.raises(RuntimeError, match="killed"):
                tables.materialise(spark.range(5), "steps_test.t")
        assert count() == 2
    with monkeypatch.context() as patched:
        seen = []
        patched.setattr(tables, "_drop_versions", lambda *_: seen.append(count()))
        tables.materialise(spark.range(6), "steps_test.t")
        assert seen == [6]
    tables.materialise(spark.range(7), "steps_test.t")
    assert count() == 7
    assert tables.list_tables(spark, "steps_test") == ["t"]
    assert len(tables._all_tables(spark, "steps_test")) == 3  # view, version, the one before
    # A plain table of the name, from before, becomes the first version.
    spark.range(4).write.saveAsTable("steps_test.plain")
    tables.materialise(spark.range(9), "steps_test.plain")
    tables.materialise(spark.range(10), "steps_test.plain")
    assert spark.read.table("steps_test.plain").count() == 10


@pytest.fixture
def restored(spark):
    """The command line sets session defaults; undo them for the tests that follow."""
    before = {key: spark.conf.get(key, None) for key in session.DEFAULTS}
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_command_line(spark, tiny, tmp_path, capsys, restored):
    inbox = tmp_path / "inbox"
    events.to_messages(events.read_events(spark, tiny)).write.parquet(str(inbox))
    root = ["--root", str(tmp_path / "data"), "--branch", "try-out"]
    at = ["--as-of-ms", str(events.AS_OF_MS)]

    cli.main([*root, "create-tables"])
    cli.main([*root, "list-tables"])
    assert "validated_telemetry" in capsys.readouterr().out
    cli.main([*root, "ingest", "--files", str(inbox), "--once", "--rollup"])
    cli.main([*root, "refresh"])
    cli.main([*root, "publish"])
    branch = Branch(str(tmp_path / "data"), "try-out")
    assert spark.read.parquet(branch.landing).count() == 1000
    assert spark.read.parquet(branch.published).count() == 1000
    assert rollup.hours(spark, branch.rollup).count() >= 0
    assert incremental.result(spark, branch, "device_summary_simple").columns
    cli.main([*root, "batches"])
    cli.main([*root, "clean"])
    assert DatasetStore(spark, branch.published).rows().count() == 1000
    cli.main([*root, "ingest", "--files", str(inbox), "--once", "--sink", "tables"])
    cli.main([*root, "query", "data_quality", *at, "--source", "tables"])
    cli.main([*root, "run-models", "device_metrics_latest", *at])
    assert "device_metrics_latest" in capsys.readouterr().out
    assert spark.catalog.tableExists("dbt_models.device_metrics_latest")
    cli.main([*root, "query", "data_quality", *at, "--output", str(tmp_path / "whole")])
    assert "record_count" in spark.read.parquet(str(tmp_path / "whole" / "data_quality")).columns
    cli.main([*root, "query", *at])
    shown = capsys.readouterr().out
    assert all(name in shown for name in DASHBOARDS)
    cli.main([*root, "drop-tables"])
    assert tables.list_tables(spark, branch.namespace) == []


def test_settings():
    assert session.catalog_settings("lake", "org.example.Catalog", uri="u", ref="dev") == {
        "spark.sql.catalog.lake": "org.example.Catalog",
        "spark.sql.catalog.lake.uri": "u",
        "spark.sql.catalog.lake.ref": "dev",
    }
    store = session.object_store_settings("http://store:9000", "a", "s")
    assert store["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_shared_dir_is_the_configured_one(spark, tmp_path):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_kafka_needs_its_connector(spark):
    """The connector is not part of Spark core; the call reports that plainly."""
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "nowhere:9092").schema


def test_encode_gives_devices_their_key_and_others_a_random_one(spark, tiny):
    rows = events.to_telemetry(events.read_events(spark, tiny))
    keyed = encode(rows).selectExpr("cast(key AS string) AS key").distinct()
    assert keyed.count() == 15
    nameless = rows.withColumn("device_id", F.lit(None).cast("string"))
    keys = encode(nameless).selectExpr("cast(key AS string) AS key").distinct().count()
    assert keys == 1000


def test_file_messages_read_as_a_batch(spark, tiny, tmp_path):
    events.to_messages(events.read_events(spark, tiny)).write.parquet(str(tmp_path / "m"))
    parsed = parse_envelope(file_messages(spark, str(tmp_path / "m"), stream=False))
    assert parsed.filter("event_id IS NOT NULL").count() == 989
