"""Streams over restarts and failures: line numbers, delivery with receipts, batches that leave by age."""

from __future__ import annotations

import io
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from docflow.sources.line_stream import Range, _last_newline, lines_in_range, line_stream, numbered_batch
from docflow.sources.storage import read_json, write_json
from docflow.streaming import age_flush, delivery_stream
from docflow.streaming.delivery import Retrying
from docflow.streaming.document_log import finish


class _Bytes(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_ranges_own_each_line_once():
    data = b"first\n\nthird \xff line\nfourth" + b"x" * 50 + b"\nlast"
    source = _Bytes(data)
    for width in (1, 2, 3, 7, 20, 500):
        parts = [Range("f", at, min(len(data), at + width), at == 0) for at in range(0, len(data), width)]
        assert [line for p in parts for some in lines_in_range(source, p) for line in some] == data.split(b"\n")
    assert _last_newline(source, 0, len(data)) == len(data) - 4
    assert _last_newline(_Bytes(b"none"), 0, 4) == 0


def test_json_files_are_replaced_whole(tmp_path):
    folder = str(tmp_path / "a" / "b")
    assert read_json(folder, "x.json") is None
    for value in ({"n": 1}, {"n": 2}):
        write_json(folder, "x.json", value)
        assert read_json(folder, "x.json") == value


class _Lines:
    """A stream of numbered lines into folders by batch, which may fail at a batch."""

    def __init__(self, spark, tmp_path, **options):
        self.spark, self.top, self.options = spark, str(tmp_path), options
        self.fails_at = None

    def run(self):
        def write(batch, batch_id):
            numbered = numbered_batch(batch, batch_id, f"{self.top}/ledger")
            numbered.write.mode("overwrite").parquet(f"{self.top}/out/batch={batch_id}")
            if batch_id == self.fails_at:
                raise RuntimeError("lost in the middle")

        arriving = line_stream(self.spark, f"{self.top}/in", f"{self.top}/progress", **self.options)
        writer = arriving.writeStream.foreachBatch(write).option("checkpointLocation", f"{self.top}/state")
        query = writer.trigger(processingTime="0 seconds").start()
        try:
            query.processAllAvailable()
            finish(query)
        finally:
            query.stop()

    def rows(self):
        found = self.spark.read.parquet(f"{self.top}/out")
        return sorted((r.file.rsplit("/", 1)[1], r.line_no, r.value) for r in found.select("file", "line_no", "value").collect())


def test_line_numbers_survive_a_failure(spark, tmp_path):
    lines = {f"f{i}.txt": [f"{i}-{k}" * (k % 5) for k in range(1, 400)] for i in range(3)}
    folder = tmp_path / "in" / "sub"
    folder.mkdir(parents=True)
    for name, text in lines.items():
        (folder / name).write_text("\r\n".join(text))
    (folder / "_skipped.txt").write_text("x\n")
    (folder / "other.csv").write_text("x\n")
    job = _Lines(spark, tmp_path, glob="*.txt", max_bytes=4000, split_bytes=700)
    job.fails_at = 1
    with pytest.raises(StreamingQueryException):
        job.run()
    job.fails_at = None
    job.run()
    # The last line of a complete file counts without a newline, even an empty one at the end does not.
    want = sorted((name, k, line) for name, text in lines.items() for k, line in enumerate(text, 1))
    assert job.rows() == want
    assert spark.read.parquet(str(tmp_path / "out")).select("batch").distinct().count() > 2


def test_growing_file(spark, tmp_path):
    file = tmp_path / "in" / "log"
    file.parent.mkdir()
    file.write_bytes(b"one\ntwo\nthr")
    job = _Lines(spark, tmp_path, growing=True)
    job.run()
    assert job.rows() == [("log", 1, "one"), ("log", 2, "two")]
    with file.open("ab") as out:
        out.write(b"ee\n\xff\n")
    job.run()
    assert job.rows() == [("log", 1, "one"), ("log", 2, "two"), ("log", 3, "three"), ("log", 4, "�")]


def test_progress_of_another_stream_is_refused(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f").write_text("a\nb\n")
    job = _Lines(spark, tmp_path)
    job.run()
    offset = read_json(f"{job.top}/progress", "planned.json")["offset"]
    write_json(f"{job.top}/progress", "planned.json", {"offset": dict.fromkeys(offset, 1), "done": False})
    with pytest.raises(StreamingQueryException, match="does not belong"):
        job.run()


def _send_to(folder, refused=None):
    def send(endpoint, collection, documents):
        if collection == refused:
            raise ValueError("refused")
        with open(f"{folder}/{collection}.txt", "a") as out:
            out.write("".join(d + "\n" for d in documents))

    return send


def _arriving(spark, folder, rows):
    spark.createDataFrame(rows, "collection string, json string").coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema("collection string, json string").option("maxFilesPerTrigger", 1).parquet(folder)


def test_delivery_commits_receipts_and_records_failures(spark, tmp_path):
    box, folder, state = tmp_path / "box", str(tmp_path / "sent"), str(tmp_path / "state")
    box.mkdir()
    stream = _arriving(spark, str(tmp_path / "in"), [("a", f"a{i}") for i in range(7)] + [("b", "b0")])
    delivery_stream.register_delivery(spark, "test_delivery", Retrying(_send_to(box)), folder, 3)
    delivery_stream.start_delivery(stream, "test_delivery", state).awaitTermination()
    receipts = delivery_stream.committed_receipts(spark, folder)
    assert sorted((r.batch_id, r.collection, r.docs) for r in receipts.collect()) == [(0, "a", 1), (0, "a", 3), (0, "a", 3), (0, "b", 1)]
    assert delivery_stream.delivery_totals(spark, folder).first().asDict() == {"ok": 4, "retried": 0, "docs": 8, "failed": 0}

    # A refused request fails its micro-batch: it is written down, no receipt counts, and the offset stays.
    stream = _arriving(spark, str(tmp_path / "in"), [("c", "c0"), ("d", "d0")])
    delivery_stream.register_delivery(spark, "test_delivery", Retrying(_send_to(box, "d")), folder, 3)
    with pytest.raises(StreamingQueryException):
        delivery_stream.start_delivery(stream, "test_delivery", state).awaitTermination()
    failed = delivery_stream.failed_requests(spark, folder)
    assert [(r.collection, r.docs, r.error) for r in failed.filter("batch_id IS NULL").collect()] == [("d", 1, "ValueError: refused")]
    assert [r.batch_id for r in failed.filter("batch_id IS NOT NULL").collect()] == [1]
    assert receipts.count() == 4

    # The restarted stream sends the micro-batch again, and its receipts count once.
    delivery_stream.register_delivery(spark, "test_delivery", Retrying(_send_to(box)), folder, 3)
    delivery_stream.start_delivery(stream, "test_delivery", state).awaitTermination()
    again = delivery_stream.committed_receipts(spark, folder).filter("batch_id = 1")
    assert sorted((r.collection, r.docs) for r in again.collect()) == [("c", 1), ("d", 1)]
    assert delivery_stream.delivery_totals(spark, folder).first().asDict() == {"ok": 6, "retried": 0, "docs": 10, "failed": 1}
    assert (box / "c.txt").read_text() == "c0\nc0\n" and (box / "d.txt").read_text() == "d0\n"
    with pytest.raises(ValueError):
        delivery_stream.register_delivery(spark, "x", Retrying(_send_to(box)), folder, 0)


def test_batches_leave_full_or_old(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    shape = "collection string, slot int, json string"
    rows = [("a", 0, f"a{i}") for i in range(25)] + [("a", 1, "x"), (None, None, "n0"), (None, None, "n1"), ("a", 0, None)]
    spark.createDataFrame(rows, shape).repartition(3).write.parquet(source)
    stream = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(source)
    flushed = age_flush.flush_by_age(stream, size=10, max_age_millis=1500)
    query = flushed.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).start()
    stored = spark.read.schema(age_flush.BATCH)
    end = time.monotonic() + 90
    while query.isActive and time.monotonic() < end:
        time.sleep(0.5)
        if query.lastProgress and stored.parquet(out).agg(F.sum(F.size("docs"))).first()[0] == len(rows):
            break
    query.stop()
    batches = stored.parquet(out).collect()
    assert sorted((b.collection, b.slot, d) for b in batches for d in b.docs if b.collection and d) == sorted(r for r in rows if r[0] and r[2])
    assert sorted(d for b in batches if b.collection is None for d in b.docs) == ["n0", "n1"]
    assert sum(len(b.docs) for b in batches) == len(rows)
    assert all(len(b.docs) == 10 if b.flushed == "full" else 0 < len(b.docs) < 10 for b in batches)
    assert {b.flushed for b in batches} == {"full", "age"}
    with pytest.raises(ValueError):
        age_flush.flush_by_age(stream, size=0)
