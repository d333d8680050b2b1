from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docflow.sources import delimited as D
from docflow.sources import files as S
from docflow.sources import json_lines as J
from docflow.sources.provider import Provider, register_provider


def _file(path, text):
    path.write_bytes(text.encode())
    return str(path)


def test_listing(spark, tmp_path):
    _file(tmp_path / "a.csv", "x")
    _file(tmp_path / "b.log", "y")
    (tmp_path / "sub").mkdir()
    _file(tmp_path / "sub" / "c.csv", "z")
    assert [r.file_uri.rsplit("/", 1)[1] for r in S.list_files(spark, str(tmp_path), "*.csv").collect()] == ["a.csv"]
    assert S.list_files(spark, str(tmp_path)).count() == 2


def test_listing_enters_no_folder_whatever_its_name(spark, tmp_path):
    for name in ("a", "k=1", "k=2", "k=2/x=3"):
        (tmp_path / name).mkdir()
        _file(tmp_path / name / "f.csv", name)
    _file(tmp_path / "top file 1.csv", "t")
    names = lambda path: sorted(r.file_uri.split(tmp_path.name)[1] for r in S.list_files(spark, path).collect())
    assert names(str(tmp_path)) == ["/top file 1.csv"]
    assert names(f"{tmp_path}/k=*") == ["/k=1/f.csv", "/k=2/f.csv"] and names(f"file://{tmp_path}/k=2/") == ["/k=2/f.csv"]


def test_line_numbers_across_file_splits(spark, tmp_path):
    for name, n in (("one.log", 5000), ("two.log", 3), ("three.log", 1)):
        _file(tmp_path / name, "".join("\n" if i % 7 == 0 else f"{name} {i} {'x' * (i % 50)}\n" for i in range(1, n + 1)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        lines = S.read_lines(spark, str(tmp_path))
        assert lines.select("file", "block").distinct().count() > 10
        rows = S.non_blank(S.with_line_numbers(lines)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == sum(1 for n in (5000, 3, 1) for i in range(1, n + 1) if i % 7)
    for row in rows:
        name, number = row.value.split(" ")[:2]
        assert row.file.endswith(name) and row.line_no == int(number)


def test_line_number_plan_has_no_global_window(spark, tmp_path):
    _file(tmp_path / "a.log", "x\n")
    plan = S.with_line_numbers(S.read_lines(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "row_number" not in plan


def test_ids_of_lines(spark, tmp_path):
    _file(tmp_path / "a.log", 'first\n\n  \nlast')
    numbered = S.with_line_numbers(S.read_lines(spark, str(tmp_path)))
    raw = sorted((r.id.rsplit("/", 1)[1], r["_raw_content_"]) for r in S.raw_documents(numbered).collect())
    assert raw == [("a.log:1", "first"), ("a.log:3", "  "), ("a.log:4", "last")]
    given = numbered.withColumn("id", F.when(F.col("line_no") == 1, 42))
    ids = {r.line_no: r.id.rsplit("/", 1)[-1] for r in S.with_line_ids(given).collect()}
    assert ids == {1: "42", 2: "a.log-2", 3: "a.log-3", 4: "a.log-4"}


BOOKS = (
    "id,cat,name,price\n"
    "  0553573403,book,A Game,7.99  \n"
    "\n"
    "080508049X,book,\"Quoted, comma\",6.99\n"
    "too,few\n"
    "a,b,,\n"
    ",,,\n"
    "ünï,book,Früh,1\n"
)


def test_plain_csv(spark, tmp_path):
    path = _file(tmp_path / "books.csv", BOOKS)
    parsed = D.parse_delimited(spark, path)
    rows = {r.doc_id: r.row for r in D.delimited_documents(parsed).collect()}
    assert set(rows) == {"0553573403", "ünï"}
    assert rows["0553573403"] == {"id": "0553573403", "cat": "book", "name": "A Game", "price": "7.99"}
    assert sorted(r.line for r in D.delimited_rejects(parsed).collect()) == sorted(
        ['080508049X,book,"Quoted, comma",6.99', "too,few", "a,b,,", ",,,"]
    )
    counts = D.delimited_counts(parsed).first()
    assert (counts.num_records, counts.num_skipped) == (2, 4)


def test_headers_differ_per_file_and_quotes_stay(spark, tmp_path):
    _file(tmp_path / "a.csv", 'name,id\nx,1\n"y",2\n')
    _file(tmp_path / "b.csv", "key,name\n7,z\n")
    rows = sorted((r.doc_id, r.row["name"]) for r in D.delimited_documents(D.parse_delimited(spark, str(tmp_path))).collect())
    assert rows == [("1", "x"), ("2", '"y"'), ("7", "z")]


def test_known_header_is_skipped_without_a_second_scan(spark, tmp_path):
    _file(tmp_path / "a.csv", BOOKS)
    _file(tmp_path / "b.csv", 'id,cat,name,price\n7,"q",id,\\2\n')
    slow = D.parse_delimited(spark, str(tmp_path))
    fast = D.parse_delimited(spark, str(tmp_path), fields=["id", "cat", "name", "price"])
    columns = ["doc_id", "row"]

    def rows(parsed):
        return sorted((r.doc_id, sorted(r.row.items())) for r in D.delimited_documents(parsed).select(columns).collect())

    assert rows(slow) == rows(fast) and len(rows(fast)) == 3
    assert sorted(r.line for r in D.delimited_rejects(slow).collect()) == sorted(r.line for r in D.delimited_rejects(fast).collect())
    assert "Join" not in fast._jdf.queryExecution().executedPlan().toString()


def test_other_delimiters(spark, tmp_path):
    path = _file(tmp_path / "p.txt", "1|a.b|c\n2|d|\n")
    parsed = D.parse_delimited(spark, path, "|", header=False, fields=["n", "x", "y"])
    assert [(r.doc_id, r.row["x"]) for r in D.delimited_documents(parsed).collect()] == [("1", "a.b")]
    with pytest.raises(ValueError):
        D.parse_delimited(spark, path, header=False)


def test_quoted_csv(spark, tmp_path):
    path = _file(tmp_path / "q.csv", 'id,name\n1,"a, b"\n')
    row = D.read_quoted_csv(spark, path, ["id", "name"]).first()
    assert (row.id, row.name, row["_corrupt"]) == ("1", "a, b", None)


def test_json_lines(spark):
    texts = ['{"a":1,"a":2}', "null", "", "[1]", "5", '{"a"', '  {"b":{}}', '"{"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string")
    parsed = J.parse_json_lines(df)
    assert {r.n: r.error for r in J.rejected(parsed).collect()} == {
        3: J.NOT_AN_OBJECT, 4: J.NOT_AN_OBJECT, 5: J.MALFORMED, 7: J.NOT_AN_OBJECT
    }
    good = J.accepted(parsed).select("n", F.try_variant_get("record", "$.a", "int").alias("a")).collect()
    assert {r.n: r.a for r in good} == {0: 2, 6: None}


def test_provider_as_batch_and_stream(spark, tmp_path):
    def read(partition, start, end):
        return ((f"{partition}-{i}", i) for i in range(start, end))

    provider = Provider("numbers", "id string, n int", 3, lambda partition: 10 + partition, read, max_records=4)
    register_provider(spark, provider)
    assert spark.read.format("numbers").load().count() == 33
    query = (
        spark.readStream.format("numbers").load().writeStream.format("memory").queryName("numbers_out")
        .option("checkpointLocation", str(tmp_path / "state")).start()
    )
    try:
        query.processAllAvailable()
        progress = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    finally:
        query.stop()
    out = spark.table("numbers_out")
    assert out.count() == out.distinct().count() == 33
    assert max(progress) <= 12
