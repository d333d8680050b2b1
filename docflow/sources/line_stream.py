"""Lines of growing or arriving files as a stream, each with a number that never changes.

The stream's offset is a byte position per file, always just after a line. A micro-batch takes bytes up to a bound and
is cut into byte ranges, one input partition each; a range owns the lines that start in it and numbers
them from 0. What precedes a range becomes known in the micro-batch itself: counts per range, a
small table, and the totals of the files so far, which every batch leaves in a ledger. So no line
passes the driver, a replayed batch gives the same numbers, and a restart goes on where the
checkpoint stands.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from docflow.sources.storage import open_storage, read_json, write_json

FORMAT = "numbered_lines"
SCHEMA = "value string, file string, block bigint, place bigint"
SPLIT_BYTES = 32 << 20
_CHUNK = 1 << 20
_PLANNED = "planned.json"


@dataclass
class Range(InputPartition):
    """Bytes ``start`` to ``end`` of a file; ``opens`` tells that a line starts at ``start``."""

    file: str
    start: int
    end: int
    opens: bool


def _newline(source, at: int, size: int) -> int:
    """Place just after the first newline at or after ``at``, or ``size``."""
    while at < size:
        source.seek(at)
        chunk = source.read(min(_CHUNK, size - at))
        found = chunk.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(chunk)
    return size


def _last_newline(source, low: int, size: int) -> int:
    """Place just after the last newline before ``size``, or ``low``."""
    while size > low:
        at = max(low, size - _CHUNK)
        source.seek(at)
        found = source.read(size - at).rfind(b"\n")
        if found >= 0:
            return at + found + 1
        size = at
    return low


def lines_in_range(source, part: Range) -> Iterator[list[bytes]]:
    """Lists of the lines that start inside the range; the last one may end behind it."""
    size = source.size()
    at = part.start if part.opens else _newline(source, part.start - 1, size)
    rest = b""
    source.seek(at)
    # ``at`` is where the line begins whose first bytes are ``rest``.
    while at < part.end:
        chunk = source.read(_CHUNK)
        if not chunk:
            if rest:
                yield [rest]
            return
        *lines, rest = (rest + chunk).split(b"\n") if rest else chunk.split(b"\n")
        taken = []
        for line in lines:
            if at >= part.end:
                break
            taken.append(line)
            at += len(line) + 1
        if taken:
            yield taken


def listed(folder: str, glob: str = "*") -> list[tuple[str, int]]:
    """Files below a folder by age, those of equal age by name, with their sizes."""
    system, top = open_storage(folder)
    found = system.get_file_info(pafs.FileSelector(top, recursive=True))
    named = [f for f in found if f.type == pafs.FileType.File and fnmatch(f.base_name, glob) and f.base_name[0] not in "._"]
    return [(f.path, f.size) for f in sorted(named, key=lambda f: (f.mtime_ns or 0, f.path))]


class _Reader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.progress = options["path"], options["progress"]
        self.glob = options.get("glob", "*")
        self.max_bytes = int(options.get("max_bytes", "0"))
        self.split_bytes = int(options.get("split_bytes", str(SPLIT_BYTES)))
        self.growing = options.get("growing", "false").lower() == "true"
        self.reached: dict | None = None

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        if self.reached is None:
            # What was planned last may be in Spark's log or not: planning it again first is right in both cases.
            planned = read_json(self.progress, _PLANNED) or {"offset": {}, "done": True}
            self.reached = planned["offset"]
            if not planned["done"]:
                return self.reached
        system, _ = open_storage(self.path)
        files = listed(self.path, self.glob)
        left = self.max_bytes if self.max_bytes > 0 else None
        reached = {name: self.reached[name] for name, _ in files if name in self.reached}
        for name, size in files:
            at = reached.get(name, 0)
            if size <= at or (left is not None and left <= 0):
                continue
            stop = size if left is None else min(size, at + left)
            with system.open_input_file(name) as source:
                # A batch ends after a line; the last line of a file that still grows waits for its newline.
                if stop < size:
                    stop = _newline(source, max(at, stop - 1), size)
                if stop >= size and self.growing:
                    stop = _last_newline(source, at, size)
            if stop > at:
                reached[name] = stop
                left = None if left is None else left - (stop - at)
        if reached != self.reached:
            write_json(self.progress, _PLANNED, {"offset": reached, "done": False})
            self.reached = reached
        return self.reached

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for name, stop in end.items():
            first = at = start.get(name, 0)
            if stop < at:
                raise ValueError(f"{name}: the progress folder does not belong to this checkpoint, or the file shrank")
            while at < stop:
                out.append(Range(name, at, min(stop, at + self.split_bytes), at == first))
                at += self.split_bytes
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        system, _ = open_storage(self.path)
        place = 0
        with system.open_input_file(partition.file) as source:
            for lines in lines_in_range(source, partition):
                n = len(lines)
                text = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(text), pa.array([partition.file] * n), pa.array([partition.start] * n), pa.array(range(place, place + n))],
                    names=["value", "file", "block", "place"],
                )
                place += n

    def commit(self, end: dict) -> None:
        if end == self.reached:
            write_json(self.progress, _PLANNED, {"offset": end, "done": True})


class _LineSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options)


def line_stream(
    spark: SparkSession,
    folder: str,
    progress: str,
    glob: str = "*",
    max_bytes: int | None = None,
    growing: bool = False,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Lines of the files below ``folder``, oldest file first: ``value, file, block, place``.

    ``max_bytes`` bounds a micro-batch (it ends with the line that reaches the bound); None or a number below
    one means no bound. With ``growing`` files may be appended to, and a last line counts only once its
    newline is there; without it a file is complete when it appears. Lines end with a newline, a carriage
    return before it is dropped, and bytes that are no UTF-8 become U+FFFD. Names that start with a dot
    or an underscore are not read. ``progress`` is a folder of this stream alone, kept with its
    checkpoint: Spark does not tell a reader where a stopped query stands. The offset holds a number per
    file of the folder; start the query with an interval, not with ``availableNow``, which is
    one batch for a source like this.
    """
    spark.dataSource.register(_LineSource)
    reader = spark.readStream.format(FORMAT).option("path", folder).option("progress", progress).option("glob", glob)
    reader = reader.option("growing", str(growing).lower()).option("split_bytes", str(split_bytes))
    return reader.option("max_bytes", str(max_bytes or 0)).load()


def numbered_batch(batch: DataFrame, batch_id: int, ledger: str) -> DataFrame:
    """``value, file, line_no`` of a micro-batch (inside ``foreachBatch``); leaves the totals in the ``ledger`` folder.

    Numbers start with 1 in each file and count blank lines. The batch is read twice: for the counts
    and for its lines. A batch that is repeated overwrites its own part of the ledger only.
    """
    spark = batch.sparkSession
    counts = batch.groupBy("file", "block").agg(F.count(F.lit(1)).alias("lines"))
    totals = spark.read.schema("file string, total bigint, batch_id bigint")
    system, top = open_storage(f"{ledger}/batch_id=-1")
    if system.get_file_info(f"{top}/_SUCCESS").type == pafs.FileType.NotFound:
        spark.createDataFrame([], "file string, total bigint").write.mode("overwrite").parquet(f"{ledger}/batch_id=-1")
    earlier = totals.parquet(ledger).filter(F.col("batch_id") < batch_id).groupBy("file").agg(F.max("total").alias("known"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    known = F.coalesce("known", F.lit(0))
    starts = counts.join(earlier, "file", "left").select(
        "file", "block", (known + F.coalesce(F.sum("lines").over(before), F.lit(0))).alias("before"), (known + F.sum("lines").over(Window.partitionBy("file"))).alias("total")
    )
    stored = f"{ledger}/batch_id={batch_id}"
    folder = f"{ledger}_starts/batch_id={batch_id}"
    starts.write.mode("overwrite").parquet(folder)
    found = spark.read.schema("file string, block bigint, before bigint, total bigint").parquet(folder)
    found.groupBy("file").agg(F.max("total").alias("total")).write.mode("overwrite").parquet(stored)
    line_no = (F.col("before") + F.col("place") + 1).alias("line_no")
    return batch.join(found.drop("total"), ["file", "block"]).select("value", "file", line_no)
