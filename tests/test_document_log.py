"""The document log: types that change, generations, lookups, and what a failed compaction leaves."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from docflow.functions.timeframes import TimeFrame
from docflow.operators import flatten
from docflow.plans import jobs
from docflow.sources import json_lines
from docflow.streaming import document_log
from docflow.streaming.document_log import DocumentLog, merged_schema


def _batch(spark, rows, kind="int"):
    return spark.createDataFrame(rows, f"collection string, id string, v {kind}").coalesce(1)


def _current(log, **options):
    return {(r.collection, r.id): r.v for r in log.current(**options).collect()}


def test_types_that_change(spark, tmp_path):
    log = DocumentLog(spark, str(tmp_path))
    log.append(_batch(spark, [("c", "1", 7), ("20240101", "2", 8)]), 0)
    log.append(_batch(spark, [("c", "1", "text")], "string"), 1)
    log.append(_batch(spark, [("c", "3", (1, "x"))], "struct<a int, b string>"), 2)
    log.append(spark.createDataFrame([("c", "4", 2.5)], "collection string, id string, other double"), 3)
    want = {("c", "1"): "text", ("20240101", "2"): "8", ("c", "3"): '{"a":1,"b":"x"}', ("c", "4"): None}
    assert _current(log) == want
    log.compact(buckets=2)
    log.append(_batch(spark, [("c", "5", 2**40)], "bigint"), 4)
    assert _current(log) == want | {("c", "5"): str(2**40)}
    assert {r.id: r.other for r in log.current().collect()}["4"] == 2.5


def test_merged_schema():
    schema = lambda *kinds: T.StructType([T.StructField(f"f{i}", k) for i, k in enumerate(kinds)])
    one = schema(T.IntegerType(), T.LongType(), T.DateType(), T.BooleanType(), T.FloatType())
    two = schema(T.LongType(), T.DoubleType(), T.TimestampType(), T.IntegerType(), T.ShortType(), T.StringType())
    kinds = [f.dataType for f in merged_schema([one, two]).fields]
    assert kinds == [T.LongType(), T.StringType(), T.TimestampType(), T.StringType(), T.DoubleType(), T.StringType()]


def test_generations(spark, tmp_path):
    log = DocumentLog(spark, str(tmp_path))
    with pytest.raises(ValueError, match="nothing is committed"):
        log.documents()
    log.append(_batch(spark, [("a", str(i % 5), i) for i in range(20)]), 0)
    log.append(_batch(spark, [("a", "1", 100), ("b", "1", 101)]), 2)
    assert log.compact(buckets=3) == 1
    after = {("a", "0"): 15, ("a", "1"): 100, ("a", "2"): 17, ("a", "3"): 18, ("a", "4"): 19, ("b", "1"): 101}
    assert _current(log) == after
    assert {r.collection: r.docs for r in log.registry().collect()} == {"a": 5, "b": 1}
    # Batches of the generation are not taken again; one that was missing is.
    log.append(_batch(spark, [("a", "0", -1)]), 0)
    assert _current(log) == after
    log.append(_batch(spark, [("a", "1", 50), ("a", "3", 51), ("c", "9", 52)]), 1)
    assert log.generation()["gaps"] == [1]
    # By the default order the version of batch 2 is newer than that of batch 1.
    assert _current(log) == after | {("a", "3"): 51, ("c", "9"): 52}
    assert log.compact(buckets=3) == 2 and log.generation()["gaps"] == []
    assert _current(log) == after | {("a", "3"): 51, ("c", "9"): 52}
    assert sorted(r.collection for r in log.newest(2).collect()) == ["b", "c"]
    with pytest.raises(ValueError, match="compacted by"):
        log.current(order=("v",))


def test_order_by_a_column(spark, tmp_path):
    log = DocumentLog(spark, str(tmp_path))
    log.append(_batch(spark, [("a", "1", 10), ("a", "2", 20)]), 0)
    log.compact(order=("v",), buckets=1)
    log.append(_batch(spark, [("a", "1", 5), ("a", "2", 30)]), 1)
    assert _current(log, order=("v",)) == {("a", "1"): 10, ("a", "2"): 30}


def test_failed_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    log = DocumentLog(spark, str(tmp_path))
    log.append(_batch(spark, [("a", "1", 1), ("a", "2", 2)]), 0)
    log.compact(buckets=1)
    log.append(_batch(spark, [("a", "1", 3)]), 1)
    reader = log.current()

    def lost(folder, name, value):
        # The generation is written; whoever reads now sees the old one.
        assert _current(DocumentLog(spark, str(tmp_path))) == {("a", "1"): 3, ("a", "2"): 2}
        raise OSError("the driver is lost")

    with monkeypatch.context() as broken:
        broken.setattr(document_log, "write_json", lost)
        with pytest.raises(OSError):
            log.compact(buckets=1)
    assert log.generation()["generation"] == 1
    assert _current(log) == {("a", "1"): 3, ("a", "2"): 2}
    assert log.compact(buckets=1) == 2
    assert _current(log) == {("a", "1"): 3, ("a", "2"): 2}
    # A reader from before keeps its files.
    assert {r.id: r.v for r in reader.collect()} == {"1": 3, "2": 2}


def test_lookup_opens_one_bucket(spark, tmp_path):
    log = DocumentLog(spark, str(tmp_path))
    log.append(_batch(spark, [(c, str(i), i) for c in "ab" for i in range(400)]), 0)
    log.compact(buckets=8)
    log.append(_batch(spark, [("a", "17", -17), ("b", "401", 401)]), 1)
    assert {(r.collection, r.v) for r in log.lookup(["17"]).collect()} == {("a", -17), ("b", 17)}
    assert [r.v for r in log.lookup(["401", "17"], "b").orderBy("v").collect()] == [17, 401]
    assert log.lookup(["nobody"]).count() == 0
    plan = log.lookup(["18"])._jdf.queryExecution().toString()
    filters = [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]]
    assert any("_bucket" in f for f in filters)


def test_documents_and_rejects_from_one_parse(spark, tmp_path):
    lines = spark.createDataFrame(
        [("1", '{"ts":1704103200000,"a":1}'), ("2", '{"ts":'), ("3", '{"ts":"soon"}'), (None, "[1]"), ("5", ""), ("6", None), ("2", '{"id":"own","ts":1704103200000}')],
        "id string, line string",
    )
    job = jobs.event_log(lines, "id", "line", TimeFrame("e_", unit="HOURS", length=12, pattern="yy-MM-dd_HH"), shards=2)
    log = DocumentLog(spark, str(tmp_path / "log"), reject_fields=jobs.REJECT_FIELDS)
    assert log.rejects().collect() == []
    log.append(job.outcomes.filter("error IS NULL OR id IS NULL"), 0)
    log.append(job.outcomes.filter("error IS NOT NULL AND id IS NOT NULL"), 1)
    plain = lambda df, *names: sorted((tuple(r) for r in df.select(*names).collect()), key=str)
    columns = ("collection", "shard", "slot", "id", "ts", "json")
    bad = ("id", "text", "error")
    for _ in range(2):
        assert plain(log.documents(), *columns) == plain(job.documents, *columns)
        assert plain(log.rejects(), *bad) == plain(job.rejects, *bad) and log.rejects().count() == 3
        assert {"text", "error"}.isdisjoint(log.documents().columns)
        assert [tuple(r) for r in log.registry().collect()] == [("e_24-01-01_00", 2)]
        log.compact(buckets=2)
    plan = log.rejects()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "__rejected__" in plan and "Python" not in plan


def test_lines_are_parsed_once(spark, tmp_path):
    lines = spark.createDataFrame([(1, '{"a":1}'), (2, "{"), (3, "[]"), (4, "null"), (5, "")], "n int, value string")
    good, bad = json_lines.parsed_once(json_lines.parse_json_lines(lines), str(tmp_path / "lines"))
    assert [r.n for r in good.collect()] == [1] and good.columns == ["n", "value", "record"]
    assert sorted((r.n, r.error) for r in bad.collect()) == [(2, "malformed JSON"), (3, "not a JSON object")]
    for side in (good, bad):
        assert "parse_json" not in side._jdf.queryExecution().executedPlan().toString()
    flat, _ = json_lines.parsed_once(flatten.flatten_json(lines, "value"), str(tmp_path / "flat"))
    assert [r.flat for r in flat.collect()] == ['{"a":1}']
    none, rejects = json_lines.parsed_once(json_lines.parse_json_lines(lines.limit(0)), str(tmp_path / "none"))
    assert none.collect() == rejects.collect() == []
    with pytest.raises(ValueError):
        json_lines.parsed_once(bad.withColumn("outcome", bad.n), str(tmp_path / "x"))
