"""Plugging a custom input into Spark through the Python data source API."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


@dataclass
class Span(InputPartition):
    """Positions ``start`` (inclusive) to ``end`` (exclusive) of one input partition."""

    partition: int
    start: int
    end: int


@dataclass
class Provider:
    """A custom input: how far each partition goes now, and how to read a span of it.

    ``positions(partition)`` returns the number of records available; ``read(partition, start,
    end)`` yields them as tuples. Reading the same span twice must give the same records, which is
    what lets Spark repeat a failed batch. ``max_records`` bounds a micro-batch per partition;
    None or a number below one means no bound.
    """

    name: str
    schema: str
    partitions: int
    positions: Callable[[int], int]
    read: Callable[[int, int, int], Iterator[tuple]]
    max_records: int | None = None


def register_provider(spark: SparkSession, provider: Provider) -> None:
    """Make the provider usable as ``spark.read.format(name)`` and ``spark.readStream.format(name)``."""

    def spans(start: dict, end: dict) -> list[Span]:
        ranges = ((p, start.get(str(p), 0), end.get(str(p), 0)) for p in range(provider.partitions))
        return [Span(p, low, high) for p, low, high in ranges if high > low]

    def read(span: Span) -> Iterator[tuple]:
        return provider.read(span.partition, span.start, span.end)

    def available() -> dict:
        return {str(p): provider.positions(p) for p in range(provider.partitions)}

    class BatchReader(DataSourceReader):
        def partitions(self):
            return spans({}, available()) or [Span(0, 0, 0)]

        def read(self, partition):
            return read(partition)

    class StreamReader(DataSourceStreamReader):
        def __init__(self):
            self.reached: dict = {}

        def initialOffset(self):
            return {str(p): 0 for p in range(provider.partitions)}

        def latestOffset(self):
            limit = provider.max_records
            for key, count in available().items():
                reached = self.reached.get(key, 0)
                bounded = count if limit is None or limit < 1 else min(count, reached + limit)
                self.reached[key] = max(reached, bounded)
            return dict(self.reached)

        def partitions(self, start, end):
            self.reached = {**self.reached, **{k: max(v, self.reached.get(k, 0)) for k, v in end.items()}}
            return spans(start, end)

        def read(self, partition):
            return read(partition)

        def commit(self, end):
            pass

    class Source(DataSource):
        @classmethod
        def name(cls):
            return provider.name

        def schema(self):
            return provider.schema

        def reader(self, schema):
            return BatchReader()

        def streamReader(self, schema):
            return StreamReader()

    spark.dataSource.register(Source)
