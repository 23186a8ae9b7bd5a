"""Session settings, and the shared folder for scratch data."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Runtime settings for large inputs; all can be overridden per job.
DEFAULTS = {
    # Shuffles start wide and are merged to about 128 MB per task by their real size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Hours of windows per device and metric outgrow the heap; keep them on disk.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A mistyped field turns NULL and the rest of its message survives; the gates rely on it.
    "spark.sql.json.enablePartialResults": "true",
    "spark.sql.session.timeZone": "UTC",
}


def catalog_settings(name: str, implementation: str, **properties: str) -> dict[str, str]:
    """Settings of a catalog plugin: its class and its own properties (uri, ref, warehouse)."""
    prefix = f"spark.sql.catalog.{name}"
    return {prefix: implementation} | {f"{prefix}.{k}": v for k, v in properties.items()}


def object_store_settings(
    endpoint: str, access_key: str, secret_key: str, path_style: bool = True
) -> dict[str, str]:
    """Settings of an S3-compatible object store."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def build_session(app: str, settings: dict[str, str] | None = None) -> SparkSession:
    """The session of a job: defaults, then the caller's settings, then spark-submit's."""
    builder = SparkSession.builder.appName(app)
    for key, value in (DEFAULTS | (settings or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_own_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session may do without the setting; it gets a folder of its own, the same
    for as long as the application lives.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="gaugeflow-")
    return _own_folders[context.applicationId]
