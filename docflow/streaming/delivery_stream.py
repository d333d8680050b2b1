"""Delivery as a streaming sink: batches go out in the tasks, receipts are committed with the micro-batch.

Each task sends its documents in bounded batches and writes its receipts to a file of its own. The names
of those files are its commit message; the driver commits a micro-batch by one small file that lists them, and
Spark's checkpoint moves on after that. A request that fails for good is written down before its
task fails, and so is a micro-batch that is given up. Delivery is at least once; receipts count once, as
a repeated micro-batch replaces its list.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from docflow.sources.storage import open_storage, write_json
from docflow.streaming.delivery import BATCH_SIZE

Deliver = Callable[[str, list[str]], tuple[str, int]]

_RECEIPTS = 1000


@dataclass
class Sent(WriterCommitMessage):
    """The receipt files of a task."""

    files: list[str]
    docs: int


class _ReceiptFiles:
    """Receipts of one task attempt as files of JSON lines, at most ``_RECEIPTS`` in memory."""

    def __init__(self, folder: str):
        context = TaskContext.get()
        self.folder, self.attempt = folder, f"{context.partitionId() if context else 0:06d}-{uuid.uuid4().hex}"
        self.rows: list[dict] = []
        self.files: list[str] = []

    def add(self, **row) -> None:
        self.rows.append(row)
        if len(self.rows) == _RECEIPTS:
            self.flush()

    def flush(self) -> None:
        if self.rows:
            system, top = open_storage(self.folder)
            system.create_dir(top, recursive=True)
            name = f"{self.attempt}-{len(self.files):05d}.json"
            with system.open_output_stream(f"{top}/{name}", compression=None) as out:
                out.write("".join(json.dumps(row) + "\n" for row in self.rows).encode())
            self.files.append(name)
            self.rows = []


def register_delivery(spark: SparkSession, name: str, deliver: Deliver, folder: str, batch_size: int = BATCH_SIZE) -> None:
    """Make ``deliver`` usable as ``df.writeStream.format(name)`` for rows of ``collection, json``.

    Rows should come grouped: a batch holds documents of one collection and leaves when it is full, when the
    next row belongs elsewhere, and when the task ends. ``folder`` receives receipts, commits and failures.
    """
    if batch_size < 1:
        raise ValueError("a batch holds at least one document")

    class Writer(DataSourceStreamArrowWriter):
        def write(self, iterator: Iterator[pa.RecordBatch]) -> Sent:
            receipts, docs = _ReceiptFiles(f"{folder}/receipts"), 0
            for collection, batch in _rows(iterator, batch_size):
                started = time.monotonic()
                try:
                    endpoint, retried = deliver(collection, batch)
                except Exception as error:
                    failed = _ReceiptFiles(f"{folder}/failures")
                    failed.add(collection=collection, docs=len(batch), error=f"{type(error).__name__}: {error}", batch_id=None)
                    failed.flush()
                    raise
                millis = (time.monotonic() - started) * 1000
                receipts.add(collection=collection, endpoint=endpoint, docs=len(batch), retried=retried, millis=millis)
                docs += len(batch)
            receipts.flush()
            return Sent(receipts.files, docs)

        def commit(self, messages: list[Sent | None], batchId: int) -> None:
            done = [m for m in messages if m]
            files = [{"file": f} for m in done for f in m.files]
            write_json(f"{folder}/commits", f"{batchId}.json", {"batch_id": batchId, "docs": sum(m.docs for m in done), "files": files})

        def abort(self, messages: list[Sent | None], batchId: int) -> None:
            lost = sum(m.docs for m in messages if m)
            row = {"collection": None, "docs": lost, "error": "micro-batch given up", "batch_id": batchId}
            write_json(f"{folder}/failures", f"abort-{batchId}-{uuid.uuid4().hex}.json", row)

    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "collection string, json string"

        def streamWriter(self, schema, overwrite) -> DataSourceStreamArrowWriter:
            return Writer()

    spark.dataSource.register(Sink)


def _rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, list[str]]]:
    current, held = None, []
    for batch in batches:
        names = batch.schema.names
        pairs = zip(batch.column(names.index("collection")).to_pylist(), batch.column(names.index("json")).to_pylist(), strict=True)
        for collection, text in pairs:
            if held and (collection != current or len(held) == size):
                yield current, held
                held = []
            current = collection
            held.append(text)
    if held:
        yield current, held


def start_delivery(documents: DataFrame, name: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Send a stream of ``collection, json`` through a registered delivery; offsets follow the receipts."""
    writer = documents.select("collection", "json").writeStream.format(name).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def committed_receipts(spark: SparkSession, folder: str) -> DataFrame:
    """Receipts of committed micro-batches: ``batch_id, collection, endpoint, docs, retried, millis``."""
    commits = spark.read.schema("batch_id bigint, docs bigint, files array<struct<file string>>").json(f"{folder}/commits")
    named = commits.select("batch_id", F.explode("files.file").alias("_file"))
    stored = spark.read.schema("collection string, endpoint string, docs bigint, retried bigint, millis double").json(f"{folder}/receipts")
    own = stored.withColumn("_file", F.col("_metadata.file_name"))
    return own.join(named, "_file").select("batch_id", "collection", "endpoint", "docs", "retried", "millis")


def failed_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests that failed for good, and micro-batches given up (with their ``batch_id``): ``collection, docs, error, batch_id``."""
    system, top = open_storage(f"{folder}/failures")
    system.create_dir(top, recursive=True)
    return spark.read.schema("collection string, docs bigint, error string, batch_id bigint").json(f"{folder}/failures")


def delivery_totals(spark: SparkSession, folder: str) -> DataFrame:
    """One row: requests that were accepted (``ok``), their repetitions (``retried``), and requests that ``failed`` for good."""
    sent = committed_receipts(spark, folder).select(F.lit(1).alias("ok"), "retried", "docs", F.lit(0).alias("failed"))
    failed = failed_requests(spark, folder).filter("batch_id IS NULL")
    rows = sent.union(failed.select(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(1)))
    return rows.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("ok", "retried", "docs", "failed")))
