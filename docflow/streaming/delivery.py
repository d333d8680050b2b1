"""Sending documents to an external service, in bounded batches from inside the tasks.

Delivery is at least once: a batch that cannot be sent fails its task, and Spark runs the task
again. Receivers see stable document ids, so a repeated batch overwrites itself.
"""

from __future__ import annotations

import random
import time
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Batch size, seconds between attempts, attempts after the first one, and the wait
# before the single repetition when no other endpoint is left.
BATCH_SIZE = 100
RETRY_WAIT = 5.0
MAX_RETRIES = 1
LAST_ENDPOINT_WAIT = 1.0

#: ``send(endpoint, collection, documents)``; raises if the batch was not accepted.
Send = Callable[[str, str, list[str]], None]

# Receipts handed back to Spark at a time.
_RECEIPTS = 1000

RECEIPT = "collection string, endpoint string, docs bigint, retried bigint, millis double"


def may_retry(error: BaseException) -> bool:
    """Only a lost connection is worth another attempt; the innermost cause decides."""
    seen = set()
    while (cause := error.__cause__ or error.__context__) is not None and id(cause) not in seen:
        seen.add(id(cause))
        error = cause
    return isinstance(error, ConnectionError)


@dataclass
class Retrying:
    """One destination; connection errors are retried after a fixed wait."""

    send: Send
    endpoint: str = "default"
    wait: float = RETRY_WAIT
    retries: int = MAX_RETRIES
    sleep: Callable[[float], None] = field(default=time.sleep)

    def __call__(self, collection: str, documents: list[str]) -> tuple[str, int]:
        for attempt in range(self.retries + 1):
            try:
                self.send(self.endpoint, collection, documents)
                return self.endpoint, attempt
            except Exception as error:
                if attempt == self.retries or not may_retry(error):
                    raise
                self.sleep(self.wait)
        raise AssertionError("unreachable")


@dataclass
class Failover:
    """Several equal endpoints, tried in an order drawn per batch until one accepts it.

    When only one endpoint is left it gets a second chance after a short wait. The order depends
    on the batch alone, so a repeated task makes the same choice.
    """

    send: Send
    endpoints: list[str]
    wait: float = LAST_ENDPOINT_WAIT
    sleep: Callable[[float], None] = field(default=time.sleep)

    def __post_init__(self):
        if not self.endpoints:
            raise ValueError("delivery needs at least one endpoint")

    def __call__(self, collection: str, documents: list[str]) -> tuple[str, int]:
        order = list(self.endpoints)
        random.Random(zlib.crc32(documents[0].encode())).shuffle(order)
        for failures, endpoint in enumerate(order):
            try:
                self.send(endpoint, collection, documents)
                return endpoint, failures
            except Exception:
                if failures < len(order) - 1:
                    continue
                self.sleep(self.wait)
                self.send(endpoint, collection, documents)
                return endpoint, failures + 1
        raise AssertionError("unreachable")


def send_batches(
    documents: DataFrame, deliver: Callable[[str, list[str]], tuple[str, int]], batch_size: int = BATCH_SIZE
) -> DataFrame:
    """Send ``collection, json`` rows; the result has one receipt per batch.

    Lazy like any DataFrame, and sending again each time it is evaluated: write the receipts once
    and read them from there. Partitions are ordered by collection, so that a task holds a single
    open batch. ``batch_size=1`` sends every document on its own.
    """
    if batch_size < 1:
        raise ValueError("a batch holds at least one document")

    def send_all(arrow_batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        receipts = []
        for collection, batch in _batches(arrow_batches, batch_size):
            started = time.monotonic()
            endpoint, retried = deliver(collection, batch)
            millis = (time.monotonic() - started) * 1000
            receipts.append((collection, endpoint, len(batch), retried, millis))
            if len(receipts) == _RECEIPTS:
                yield _as_batch(receipts)
                receipts = []
        if receipts:
            yield _as_batch(receipts)

    ordered = documents.select("collection", "json").sortWithinPartitions("collection")
    return ordered.mapInArrow(send_all, RECEIPT)


def _as_batch(receipts: list[tuple]) -> pa.RecordBatch:
    names = ["collection", "endpoint", "docs", "retried", "millis"]
    return pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*receipts)], names)


def _batches(arrow_batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, list[str]]]:
    """Batches of one collection each; the last one of a collection goes out when it ends."""
    current, held = None, []
    for arrow_batch in arrow_batches:
        for collection, text in zip(arrow_batch.column(0).to_pylist(), arrow_batch.column(1).to_pylist()):
            if held and (collection != current or len(held) == size):
                yield current, held
                held = []
            current = collection
            held.append(text)
    if held:
        yield current, held


def delivery_report(receipts: DataFrame, by: str = "endpoint") -> DataFrame:
    """Requests, retries, documents and latency per endpoint (or collection)."""
    return receipts.groupBy(by).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("retried").alias("retried"),
        F.sum("docs").alias("docs"),
        F.percentile_approx("millis", F.lit([0.5, 0.95, 0.99])).alias("millis_p50_p95_p99"),
    )
