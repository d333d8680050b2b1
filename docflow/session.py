"""Session settings the library relies on, and the shared folder it writes to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_RUNTIME_SETTINGS = {
    # Frame names, parsed dates and epoch values are all defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of failing the record.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A repeated name in one record keeps its last value, as setting a field twice does.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Python workers see long texts in small batches.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def build_session(app_name: str = "docflow", **conf: str) -> SparkSession:
    """Create (or reuse) a session with the settings this library needs."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**_RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in _RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def pin_file_splits(spark: SparkSession) -> None:
    """Keep two scans of the same files split alike while executors come and go."""
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A session without the setting gets a folder below its warehouse, which every executor reaches,
    and keeps it.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set(CHECKPOINT_DIR, root)
    return root


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created or deleted here."""
    return f"{checkpoint_root(spark).rstrip('/')}/docflow/{name}-{uuid.uuid4().hex}"
