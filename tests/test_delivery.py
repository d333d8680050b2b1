from __future__ import annotations

import json
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.functions.timeframes import TimeFrame
from docflow.operators import batches, upsert
from docflow.operators.collections import collection_registry
from docflow.operators.filters import by_id
from docflow.operators.ranking import first_per_group, number_rows
from docflow.plans import jobs
from docflow.session import checkpoint_root, workspace
from docflow.sources import streams
from docflow.streaming import delivery as S
from docflow.streaming.document_log import DocumentLog, finish, start_ingest, write_documents
from docflow.streaming.progress import ProgressReport, counted

VOCABULARY = "alpha beta gamma delta epsilon zeta eta theta iota".split()
FRAME = TimeFrame("e_", "HOURS", 12, "yyMMdd_HH")


class Service:
    """Counts requests and fails as told: a list of errors (or None) per endpoint."""

    def __init__(self, **failures):
        self.failures, self.sent = failures, []

    def __call__(self, endpoint, collection, documents):
        planned = self.failures.get(endpoint, [])
        error = planned.pop(0) if planned else None
        self.sent.append((endpoint, len(documents), error is None))
        if error:
            raise error


def test_retry_of_connection_errors():
    waits = []
    service = Service(default=[ConnectionRefusedError(), ConnectionResetError()])
    assert S.Retrying(service, wait=5, retries=2, sleep=waits.append)("c", ["x"]) == ("default", 2)
    assert waits == [5, 5]
    with pytest.raises(ConnectionError):
        S.Retrying(Service(default=[ConnectionError()] * 2), retries=1, sleep=waits.append)("c", ["x"])


def test_other_errors_are_not_retried():
    service = Service(default=[ValueError("rejected")])
    with pytest.raises(ValueError):
        S.Retrying(service, sleep=lambda _: pytest.fail("waited"))("c", ["x"])
    assert len(service.sent) == 1


def test_innermost_cause_decides():
    try:
        try:
            raise ConnectionResetError
        except ConnectionResetError as cause:
            raise RuntimeError("wrapped") from cause
    except RuntimeError as error:
        assert S.may_retry(error)
    assert not S.may_retry(RuntimeError())


def test_failover_tries_every_endpoint_once():
    waits = []
    service = Service(a=[OSError()], b=[OSError()])
    endpoint, failures = S.Failover(service, ["a", "b", "c"], sleep=waits.append)("c", ["x"])
    assert endpoint == "c" or failures < 3
    assert service.sent[-1][2] and len({e for e, _, _ in service.sent}) == len(service.sent) and not waits


def test_single_endpoint_waits_and_repeats_once():
    waits = []
    service = Service(a=[OSError()])
    assert S.Failover(service, ["a"], sleep=waits.append)("c", ["x"]) == ("a", 1)
    assert waits == [1.0]
    with pytest.raises(OSError):
        S.Failover(Service(a=[OSError(), OSError()]), ["a"], sleep=waits.append)("c", ["x"])
    with pytest.raises(ValueError):
        S.Failover(service, [])


def _documents(spark, n=1000):
    return spark.range(n).select((F.col("id") % 3).cast("string").alias("collection"), F.to_json(F.struct("id")).alias("json"))


def test_batches_hold_one_collection_and_end_with_it(spark):
    def accept(endpoint, collection, documents):
        assert {str(json.loads(d)["id"] % 3) for d in documents} == {collection}

    receipts = S.send_batches(_documents(spark).repartition(2), S.Retrying(accept), 100).collect()
    assert sum(r.docs for r in receipts) == 1000 and max(r.docs for r in receipts) == 100
    single = S.send_batches(_documents(spark, 50), S.Retrying(accept), 1).collect()
    assert len(single) == 50 and {r.docs for r in single} == {1}
    with pytest.raises(ValueError):
        S.send_batches(_documents(spark), S.Retrying(accept), 0)


def test_a_batch_that_cannot_be_sent_fails_the_job(spark):
    def refuse(endpoint, collection, documents):
        raise ValueError("refused")

    with pytest.raises(Exception, match="refused"):
        S.send_batches(_documents(spark), S.Retrying(refuse)).collect()


def test_delivery_report(spark):
    rows = [("c", "a", 10, 0, 5.0), ("c", "a", 20, 1, 15.0), ("d", "b", 1, 0, 1.0)]
    report = {r.endpoint: r for r in S.delivery_report(spark.createDataFrame(rows, S.RECEIPT)).collect()}
    assert (report["a"].requests, report["a"].docs, report["a"].retried) == (2, 30, 1)
    assert report["a"]["millis_p50_p95_p99"] == [5.0, 15.0, 15.0]


def test_row_numbers_of_a_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 10 > 0, "hot").alias("g"), "id")
    for row in number_rows(df, ["g"], ["id"], buckets=16).groupBy("g").agg(
        F.count("*").alias("n"), F.countDistinct("row_no").alias("d"), F.max("row_no").alias("m"), F.min("row_no").alias("low")
    ).collect():
        assert row.n == row.d == row.m and row.low == 1
    planned = batches.batch_plan(df, ["g"], ["id"], 100)
    sizes = batches.batch_sizes(planned, ["g"]).collect()
    assert {r.docs for r in sizes} == {100} and len(sizes) == 50


def test_first_per_group_both_ways(spark):
    df = spark.range(0, 9000, 1, 6).select((F.col("id") % 2).alias("g"), (9000 - F.col("id")).alias("v"))
    for n, salts in ((10, None), (10, 4), (1500, None)):
        kept = first_per_group(df, ["g"], ["v"], n, salts)
        assert {r.g: (r.n, r.top) for r in kept.groupBy("g").agg(F.count("*").alias("n"), F.max("v").alias("top")).collect()} == {
            0: (n, 2 * n), 1: (n, 2 * n - 1)
        }
    plan = streams.shed_load(df, "g", ["v"], 1000)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_current_view_keeps_one_version_per_task(spark):
    log = spark.range(1000).select(F.lit("c").alias("collection"), (F.col("id") % 3).alias("id"), F.col("id").alias("seq"))
    view = upsert.current_view(log, ["collection", "id"], ["seq"])
    assert {(r.id, r.seq) for r in view.collect()} == {(0, 999), (1, 997), (2, 998)}
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def _lines(spark, n=60):
    ts = F.lit(1704067200000) + F.col("id") * 3_600_000
    line = F.to_json(F.struct(ts.alias("ts"), F.struct((F.col("id") % 5).alias("k")).alias("props")))
    return spark.range(n).select(F.col("id").cast("string").alias("id"), line.alias("line"))


def test_document_log_replay_and_alias(spark):
    log = DocumentLog(spark, workspace(spark, "log"))
    documents = jobs.event_log(_lines(spark), "id", "line", FRAME, shards=2).documents
    for batch_id in (0, 1, 0):
        log.append(documents.withColumn("seq", F.lit(batch_id)), batch_id)
    assert log.documents().count() == 120 and log.current().count() == 60
    assert {r.seq for r in log.current().collect()} == {1}
    # 60 hourly events from midnight: five whole half days, where midnight itself opens a frame.
    assert {r.collection for r in log.registry().collect()} == {
        "e_240101_00", "e_240101_12", "e_240102_00", "e_240102_12", "e_240103_00"
    }
    assert log.newest(2).select("collection").distinct().count() == 2
    assert log.newest(0).count() == 60


def test_collections_named_like_numbers(spark):
    frame = TimeFrame("", "DAYS", 1, "yyyyMMdd")
    log = DocumentLog(spark, workspace(spark, "log"))
    log.append(jobs.event_log(_lines(spark), "id", "line", frame).documents, 0)
    assert {r.collection for r in log.documents().select("collection").collect()} == {"20240101", "20240102", "20240103"}
    assert {r.collection for r in log.newest(1, order=("ts",)).collect()} == {"20240103"}


def test_uncommitted_batches_are_not_read(spark):
    log = DocumentLog(spark, workspace(spark, "log"))
    documents = jobs.event_log(_lines(spark), "id", "line", FRAME).documents
    log.append(documents, 0)
    write_documents(documents, f"{log.path}/documents/batch_id=1", mode="overwrite")
    assert log.documents().count() == 60


def test_stream_equals_batch_and_survives_a_restart(spark, tmp_path):
    source = tmp_path / "in"
    rows = _lines(spark, 90)
    text = rows.select(F.to_json(F.struct("id", "line")).alias("value"))
    text.filter("get_json_object(value, '$.id') < 50").repartition(4).write.text(str(source / "a"))

    def run(log, state):
        lines = streams.arriving_lines(spark, str(source / "*"), max_files=1, glob="*.txt")
        parsed = lines.select(F.from_json("value", "id string, line string").alias("r")).select("r.*")
        query = start_ingest(jobs.event_log(parsed, "id", "line", FRAME, shards=3).documents, log, state)
        query.awaitTermination()
        return len([p for p in query.recentProgress if p.numInputRows])

    log, state = DocumentLog(spark, workspace(spark, "log")), str(tmp_path / "state")
    assert run(log, state) == 4
    text.filter("get_json_object(value, '$.id') >= 50").coalesce(1).write.text(str(source / "b"))
    assert run(log, state) == 1
    assert run(log, state) == 0
    expected = jobs.event_log(rows, "id", "line", FRAME, shards=3).documents
    stored = log.documents().select(expected.columns)
    assert stored.exceptAll(expected).count() == 0 and expected.exceptAll(stored).count() == 0


def test_failed_batch_is_repeated_without_duplicates(spark, tmp_path):
    _lines(spark, 30).write.parquet(str(tmp_path / "in"))
    schema = T.StructType().add("id", "string").add("line", "string")
    attempts = []

    def fail_once(batch):
        attempts.append(batch.count())
        if len(attempts) == 1:
            raise RuntimeError("sink is down")
        return batch

    log, state = DocumentLog(spark, workspace(spark, "log")), str(tmp_path / "state")
    for attempt in range(2):
        documents = jobs.event_log(streams.arriving_rows(spark, str(tmp_path / "in"), schema), "id", "line", FRAME).documents
        query = start_ingest(documents, log, state, per_batch=fail_once)
        if attempt == 0:
            with pytest.raises(Exception, match="sink is down"):
                query.awaitTermination()
        else:
            query.awaitTermination()
    assert attempts == [30, 30] and log.documents().count() == 30


def test_interval_stream_and_final_flush(spark, tmp_path):
    _lines(spark, 20).write.parquet(str(tmp_path / "in"))
    schema = T.StructType().add("id", "string").add("line", "string")
    report = ProgressReport()
    spark.streams.addListener(report)
    try:
        rows = counted(streams.arriving_rows(spark, str(tmp_path / "in"), schema), "seen", late=F.col("id") > "5")
        log = DocumentLog(spark, workspace(spark, "log"))
        documents = jobs.event_log(rows, "id", "line", FRAME).documents
        query = start_ingest(documents, log, str(tmp_path / "state"), interval="200 milliseconds")
        finish(query)
        assert not query.isActive and log.documents().count() == 20
        deadline = time.time() + 20
        while time.time() < deadline and not any(e["observed"].get("seen", {}).get("rows") == 20 for e in report.events):
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(report)
    assert any(e["observed"].get("seen", {}).get("rows") == 20 for e in report.events)
    assert max(report.latencies()) > 0


def test_shedding_inside_a_stream(spark, tmp_path):
    _lines(spark, 40).withColumn("source", F.lit("s")).write.parquet(str(tmp_path / "in"))
    schema = T.StructType().add("id", "string").add("line", "string").add("source", "string")
    rows = streams.arriving_rows(spark, str(tmp_path / "in"), schema).withColumn("collection", F.lit("c"))
    log = DocumentLog(spark, workspace(spark, "log"))
    shed = lambda batch: streams.shed_load(batch, "source", ["id"], slots=7)
    start_ingest(rows, log, str(tmp_path / "state"), per_batch=shed).awaitTermination()
    assert log.documents().count() == 7


def test_wide_json_documents_are_found_by_id(spark):
    words = random.Random(5150)
    record = {"id": "wide", **{f"f{i}_s": " ".join(words.choices(VOCABULARY, k=words.randint(1, 1000))) for i in range(200)}}
    lines = spark.createDataFrame([("1", '{"id":"1","text":"foo","number":10}'), ("2", json.dumps(record))], "key string, line string")
    documents = jobs.json_paths_job(lines, "key", "line", "main").documents
    found = json.loads(by_id(documents, "2").first().json)
    assert found == record
    assert json.loads(by_id(documents, "1").first().json) == {"id": "1", "text": "foo", "number": 10}
    flat = jobs.event_log(lines.withColumn("line", F.concat(F.lit('{"ts":1,'), F.expr("substr(line, 2)"))), "key", "line", FRAME).documents
    assert json.loads(by_id(flat, "wide").first().json) == {"ts": 1, **record}


def test_rejected_events(spark):
    lines = spark.createDataFrame(
        [("1", '{"ts":1704067200001}'), ("2", '{"ts":"2024-01-01T13:00:00Z"}'), ("3", "{"), ("4", '{"x":1}'), ("5", "[]"), ("6", "")],
        "id string, line string",
    )
    result = jobs.event_log(lines, "id", "line", FRAME)
    assert {r.id: r.collection for r in result.documents.collect()} == {"1": "e_240101_00", "2": "e_240101_12"}
    assert {r.id: r.error for r in result.rejects.collect()} == {
        "3": "malformed JSON", "4": "no usable timestamp", "5": "not a JSON object"
    }


def test_flagship_plan(spark):
    plan = jobs.event_log(_lines(spark), "id", "line", FRAME, shards=4, tasks=2).documents
    text = plan._jdf.queryExecution().executedPlan().toString()
    # One helper for the record, one for the key, nothing shuffled, gathered or sorted.
    assert text.count("ArrowEvalPython") == 2 and "BatchEvalPython" not in text
    assert "Exchange" not in text and "Sort" not in text


def test_written_collections_are_pruned(spark):
    target = workspace(spark, "docs")
    write_documents(jobs.event_log(_lines(spark), "id", "line", FRAME).documents, target)
    one = spark.read.parquet(target).filter("collection = 'e_240102_00'")
    assert "PartitionFilters: [isnotnull(collection" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 13
    assert collection_registry(spark.read.parquet(target)).count() == 5


def test_workspace_is_below_the_configured_folder(spark):
    assert workspace(spark, "x").startswith(checkpoint_root(spark))
    assert workspace(spark, "x") != workspace(spark, "x")
