"""Batches on a stream that leave when they are full or old.

One buffer per collection and slot collects the documents of several micro-batches. A full buffer leaves at once
as batches of the wanted size; what remains leaves when a timer, set as its first document arrives, runs out.
Buffers and timers are Spark's state, so a restart loses and repeats nothing that is not in a batch yet.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Documents in a full batch, milliseconds that a document waits at most.
BATCH_SIZE = 100
MAX_AGE_MILLIS = 500

STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

BATCH = "collection string, slot int, docs array<string>, flushed string"


class _Buffer(StatefulProcessor):
    def __init__(self, size: int, age: int):
        self.size, self.age = size, age

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "json string")

    def _row(self, key, docs: list[str], why: str) -> Row:
        return Row(collection=key[0], slot=key[1], docs=docs, flushed=why)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = [r[0] for r in self.waiting.get()] if self.waiting.exists() else []
        known, left = len(held), False
        # Documents of this micro-batch pass by; at most one batch is held.
        for row in rows:
            held.append(row["json"])
            if len(held) == self.size:
                yield self._row(key, held, "full")
                held, left = [], True
        if left:
            self._forget_timers()
            self.waiting.clear()
            known = 0
        if len(held) > known:
            self.waiting.appendList([(d,) for d in held[known:]])
            if not known:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.age)

    def _forget_timers(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = [r[0] for r in self.waiting.get()] if self.waiting.exists() else []
        self.waiting.clear()
        if held:
            yield self._row(key, held, "age")

    def close(self) -> None:
        pass


def flush_by_age(documents: DataFrame, size: int = BATCH_SIZE, max_age_millis: int = MAX_AGE_MILLIS) -> DataFrame:
    """Stream of batches ``collection, slot, docs, flushed`` from a stream with ``collection, slot, json``.

    A batch has at most ``size`` documents of one collection and slot. ``flushed`` tells why it left: ``full``, or
    ``age`` when its first document has waited ``max_age_millis`` (timers are looked at with every
    micro-batch, of which the stream runs one per trigger while timers wait). A NULL collection or
    slot has a buffer like any other. A buffer never holds more than ``size - 1`` documents between micro-batches, so
    give a hot collection more slots. The state needs Spark's RocksDB store, which this sets for the session.
    """
    if size < 1 or max_age_millis < 0:
        raise ValueError("a batch holds at least one document, and an age is not negative")
    documents.sparkSession.conf.set(*STATE_STORE)
    keyed = documents.select("collection", F.col("slot").cast("int").alias("slot"), "json")
    return keyed.groupBy("collection", "slot").transformWithState(
        _Buffer(size, max_age_millis), outputStructType=BATCH, outputMode="append", timeMode="processingTime"
    )
