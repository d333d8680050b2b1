from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from docflow.operators import blocks as B
from docflow.operators import filters as K
from docflow.operators import flatten as N
from docflow.operators import json_paths as P
from docflow.operators import mappers as M
from docflow.operators import typing as Y

DOC0 = {
    "a0": 1.5, "a1": "x", "a2": 7, "a3": ["p", "q"],
    "a4": {
        "a40": "z", "a41": 3, "a42": ["m", "n"],
        "a43": [
            {"a430": "s", "a430a": [["1", "2"], ["3"]]},
            {"a431": "t", "a431a": {"a431aX": "u", "a431aY": "v"}},
            {"a432": "w"},
        ],
    },
}
DOC1 = {"name": "n", "phone": 13034445555, "orgs": [{"name": "o", "zip": 90210}, {"name": "p", "zip": "X1"}]}
DOC2 = {"_id": "i", "found": True, "enrichment": {"host": {"ip_dst": {}, "ip_src": {"known": {"t": "h"}}}}}


def _leaves(spark, *records, delimiter="."):
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    df = spark.createDataFrame([(f"doc{i}", t) for i, t in enumerate(texts)], "id string, value string")
    flat = N.flatten_json(df, "value", delimiter)
    found = {}
    for r in N.to_leaves(N.flat_documents(flat, "id"), "id").select("id", "path", F.to_json("value").alias("v")).collect():
        assert r.path not in found.setdefault(r.id, {})
        found[r.id][r.path] = json.loads(r.v)
    return found, {r.id: r.error for r in N.flat_rejects(flat).collect()}


def test_flatten_rules(spark):
    found, errors = _leaves(spark, DOC0, DOC1, DOC2)
    assert not errors
    assert found["doc0"] == {
        "a0": 1.5, "a1": "x", "a2": 7, "a3": ["p", "q"], "a4.a40": "z", "a4.a41": 3, "a4.a42": ["m", "n"],
        "a4.a43.0.a430": "s", "a4.a43.0.a430a.0": ["1", "2"], "a4.a43.0.a430a.1": ["3"], "a4.a43.1.a431": "t",
        "a4.a43.1.a431a.a431aX": "u", "a4.a43.1.a431a.a431aY": "v", "a4.a43.2.a432": "w",
    }
    assert found["doc1"]["orgs.0.zip"] == 90210 and found["doc1"]["orgs.1.zip"] == "X1"
    assert found["doc2"] == {"_id": "i", "found": True, "enrichment.host.ip_src.known.t": "h"}


def test_flatten_edge_cases(spark):
    found, errors = _leaves(
        spark, '{"a":null,"b":[],"c":{},"d":[null,1],"e":"é"}', '{"id":"own","x":1}', '{"k":1,"k":2}', "null", "",
        '{"a":[{"x":1},2]}', '{"a":[[1],2]}', '{"a":[{"x":1},null]}', '{"a":[[1],null]}', "[1]", "{oops", '{"a":NaN}',
    )
    assert found["doc0"] == {"d": [None, 1], "e": "é"}
    assert found["own"] == {"x": 1} and found["doc2"] == {"k": 2} and found["doc8"] == {"a.0": [1]}
    assert errors == {
        "doc5": N.MIXED_LIST, "doc6": N.MIXED_LIST, "doc7": N.MIXED_LIST, "doc9": N.NOT_AN_OBJECT,
        "doc10": N.MALFORMED, "doc11": N.MALFORMED,
    }


def test_flatten_has_no_depth_limit(spark):
    depth = 300
    text = '{"a":' * depth + "1" + "}" * depth
    found, _ = _leaves(spark, text, delimiter="/")
    assert found["doc0"] == {"/".join("a" * depth): 1}


def test_typed_flatten_equals_untyped(spark):
    schema = "a0 double, a1 string, a2 bigint, a3 array<string>, a4 struct<a40:string,a41:bigint,a42:array<string>,a43:array<struct<a430:string,a430a:array<array<string>>,a431:string,a431a:struct<a431aX:string,a431aY:string>,a432:string>>>"
    df = spark.createDataFrame([("doc0", json.dumps(DOC0))], "id string, value string")
    typed = df.select("id", F.from_json("value", schema).alias("r")).select("id", "r.*")
    flat = N.flatten_typed(typed, "id")
    found = {r.path: json.loads(r.v) for r in flat.select(F.explode("fields").alias("path", "v")).select("path", F.to_json("v").alias("v")).collect()}
    assert found == _leaves(spark, DOC0)[0]["doc0"]
    assert "Python" not in flat._jdf.queryExecution().executedPlan().toString()


def _blocks(spark, *records):
    df = spark.createDataFrame([(f"doc{i}", json.dumps(r)) for i, r in enumerate(records)], "id string, value string")
    parsed = B.parse_blocks(df, "id", "value")
    rows = B.block_documents(parsed).withColumn("fields", F.to_json("fields")).collect()
    return {r.doc_id: (r.parent_id, r.depth, r.ordinal, json.loads(r.fields)) for r in rows}, B.block_rejects(parsed)


def test_block_ids(spark):
    found, _ = _blocks(spark, DOC0, DOC1, DOC2)
    assert set(found) == {
        "doc0", "doc0.a4", "doc0.a4.a43.0", "doc0.a4.a43.1", "doc0.a4.a43.2", "doc0.a4.a43.0.a430a.0",
        "doc0.a4.a43.0.a430a.1", "doc0.a4.a43.1.a431a", "doc1", "doc1.orgs.0", "doc1.orgs.1", "doc2",
        "doc2.enrichment", "doc2.enrichment.host", "doc2.enrichment.host.ip_dst", "doc2.enrichment.host.ip_src",
        "doc2.enrichment.host.ip_src.known",
    }
    assert found["doc2.enrichment.host.ip_dst"] == ("doc2.enrichment.host", 3, 0, {})
    assert found["doc0.a4.a43.0.a430a.1"] == ("doc0.a4.a43.0", 3, 1, {"doc0.a4.a43.0.a430a.1": ["3"]})
    assert found["doc0.a4"][3] == {"a40": "z", "a41": 3, "a42": ["m", "n"]}


def test_block_own_ids_and_rejects(spark):
    found, rejects = _blocks(spark, {"id": "root", "c": {"id": 7, "d": {"x": 1}}}, {"l": [{"a": 1}, 2]})
    assert found == {"root": (None, 0, 0, {}), "7": ("root", 1, 0, {}), "7.d": ("7", 2, 0, {"x": 1})}
    assert [(r.id, r.error) for r in rejects.collect()] == [("doc1", N.MIXED_LIST)]


def test_blocks_of_one_split_are_parsed_in_many_tasks(spark):
    df = spark.createDataFrame([(f"doc{i}", json.dumps({"k": i})) for i in range(64)], "id string, value string")
    parsed = B.parse_blocks(df.coalesce(1), "id", "value")
    assert "Exchange hashpartitioning(id" in parsed._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.doc_id for r in B.block_documents(parsed).collect()) == sorted(f"doc{i}" for i in range(64))


def test_fetch_blocks_limits_each_parent(spark):
    parents = spark.range(3)
    children = spark.range(500).select((F.col("id") % 2).alias("parent"), F.col("id").alias("no"))
    fetched = B.fetch_blocks(parents, children, "id", "parent", ["no"], limit=100)
    rows = {r.id: [c.no for c in r.children] for r in fetched.collect()}
    assert rows == {0: list(range(0, 200, 2)), 1: list(range(1, 200, 2)), 2: []}
    assert "WindowGroupLimit" in fetched._jdf.queryExecution().executedPlan().toString()


def _map(spark, record, mappings, split="/"):
    df = spark.createDataFrame([(json.dumps(record),)], "j string").select(F.parse_json("j").alias("r"))
    rows = P.map_paths(df, "r", mappings, split).select("part_no", F.to_json("fields").alias("f")).collect()
    return [json.loads(r.f) for r in sorted(rows, key=lambda r: r.part_no)]


EXAMS = {"first": "J", "last": "D", "exams": [{"subject": "M", "marks": 90}, {"subject": "B", "marks": 86, "more": {"by": ["x", "y"]}}]}


def test_path_mapping(spark):
    assert _map(spark, EXAMS, ("first:/first", "s:/exams/subject", "/exams/marks"), "/exams") == [
        {"first": "J", "s": "M", "marks": 90}, {"first": "J", "s": "B", "marks": 86}
    ]
    assert _map(spark, EXAMS, ("s:/exams/subject", "none:/nowhere")) == [{"s": ["M", "B"]}]
    assert _map(spark, EXAMS, ("$FQN:/**",), "/exams")[1] == {
        "first": "J", "last": "D", "exams.subject": "B", "exams.marks": 86, "exams.more.by": ["x", "y"]
    }
    assert _map(spark, EXAMS, ()) == _map(spark, EXAMS, ("$FQN:/**",))
    assert _map(spark, EXAMS, ("/**",), "/exams")[1]["by"] == ["x", "y"]
    assert _map(spark, EXAMS, ("all:/exams/**",), "/exams")[0] == {"all": [90, "M"]}
    assert _map(spark, EXAMS, ("/*",)) == [{"first": "J", "last": "D"}]
    assert _map(spark, EXAMS, ("n:/first", "n:/last", "$FQN:/exams/*"), "/exams")[0] == {
        "n": ["J", "D"], "exams.subject": "M", "exams.marks": 90
    }
    for bad in ("x", "t:a/b", "t:/a/**/b", "/"):
        with pytest.raises(ValueError):
            P.Mapping.parse(bad)


def test_exact_paths_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("{}",)], "j string").select(F.parse_json("j").alias("r"))
    assert "Python" not in P.map_paths(df, "r", ("a:/b/c",), "/x")._jdf.queryExecution().executedPlan().toString()


def test_dynamic_fields(spark):
    df = spark.createDataFrame(
        [("k", "foo", 10, datetime(2015, 12, 1), 5, 1.5, 2.5, True, [1], Decimal("1.0"), "a b", "a\tb", "", None, date(2020, 1, 1))],
        "key string, text string, number int, timestamp timestamp, big bigint, dbl double, flt float, flag boolean, arr array<int>, "
        "dec decimal(3,1), two string, tab string, empty string, nothing string, day date",
    ).withColumn("nested", F.struct("text")).withColumn("id", F.lit("not this one"))
    row = M.dynamic_fields(df, "key", {"dec": "_c", "arr": "_is"}).first().asDict()
    assert row["id"] == "k" and row["text_s"] == "foo" and row["number_i"] == 10 and row["timestamp_tdt"] is not None
    assert (row["big_l"], row["dbl_d"], row["flt_f"], row["flag_b"]) == (5, 1.5, 2.5, True)
    assert row["two_t"] == "a b" and row["two_s"] is None and row["tab_s"] == "a\tb" and row["empty_s"] == ""
    assert row["nothing_s"] is None and row["dec_c"] == Decimal("1.0") and row["day_tdt"] is not None
    assert not [name for name in row if name.startswith(("arr", "nested"))]
    present = {r.field for r in M.to_fields(M.dynamic_fields(df, "key")).collect()}
    assert "nothing_s" not in present and "two_s" not in present and "two_t" in present
    with pytest.raises(ValueError):
        M.dynamic_fields(spark.createDataFrame([("a", "b", "c")], "k string, x string, `x_s` string"), "k", {"x": "_s_s", "x_s": "_s"})


def test_map_documents_and_guessing(spark):
    df = spark.createDataFrame([("d", {"id": "own", "a": "1", "n": None}), ("e", {"a": "2"})], "k string, m map<string,string>")
    assert {r.id: r.fields for r in M.map_fields(df, "k", "m").collect()} == {"own": {"a": "1"}, "e": {"a": "2"}}
    wide = spark.createDataFrame([("d", 1, [2])], "k string, a int, b array<int>")
    assert M.guessed_fields(wide, "k").columns == ["id", "a"]
    assert M.as_documents(wide) is wide


def test_envelopes(spark):
    df = spark.createDataFrame([("d", 1, None, "x")], "k string, a int, b double, c string")
    assert json.loads(M.envelope_json(M.envelopes(df, "k")).first().json) == {
        "id": "d", "fields": [{"name": "a", "value": 1}, {"name": "b", "value": ""}, {"name": "c", "value": "x"}]
    }
    maps = spark.createDataFrame([("d", {"p": "q", "r": None})], "k string, m map<string,string>")
    fields = json.loads(M.envelope_json(M.envelopes(maps, "k", "m")).first().json)["fields"]
    assert sorted(f["name"] + f["value"] for f in fields) == ["pq", "r"]


def test_json_text(spark):
    df = spark.createDataFrame([(1, None, "raw text")], "a int, b string, p string")
    assert M.to_json_text(df, columns=["a", "b"]).first().json == '{"a":1}'
    assert M.to_json_text(df, "p").first().json == "raw text"


def test_type_guessing(spark):
    df = spark.createDataFrame(
        [
            ("true", "1", "1", "2015-12-01", "007", "9223372036854775808", "2015-12-01T01:02:03.004+0000", "1", None),
            ("FALSE", "-2", "2.5", "2015-12-01 10:11", "x", "1", "2015-12-01 01:02:03,004", "true", None),
        ],
        "flag string, whole string, num string, day string, code string, huge string, stamp string, odd string, none string",
    )
    types = Y.guess_types(df)
    assert types == {
        "flag": "boolean", "whole": "long", "num": "double", "day": "date", "code": "string", "huge": "double", "stamp": "date",
        "odd": "string", "none": "string",
    }
    row = Y.cast_guessed(df, types).orderBy("whole").first()
    assert row.flag is False and row.whole == -2 and row.num == 2.5 and row.code == "x"
    values = {"1": "long", "t": "string", "yes": "string", "1e3": "double", "": "string", "2015-13-01": "string", ".5": "double"}
    guessed = spark.createDataFrame([(v,) for v in values], "v string").select("v", Y.guess_value(F.col("v")).alias("g"))
    assert {r.v: r.g for r in guessed.collect()} == values


def test_every_date_format_reads_its_own_output(spark):
    stamp = F.lit("2015-12-01 01:02:03.004").cast("timestamp")
    for date_format in Y.DATE_FORMATS:
        row = spark.range(1).select(F.date_format(stamp, date_format).alias("t")).select("t", Y.as_date(F.col("t")).alias("d")).first()
        assert row.d is not None, row.t


def test_blank_fields_names_and_ids(spark):
    df = spark.createDataFrame([("", "  ", "x")], "`a b` string, c string, `d.e-f` string")
    cleaned = M.clean_names(M.drop_blank(df))
    assert cleaned.columns == ["a_b", "c", "d.e-f"] and tuple(cleaned.first()) == (None, None, "x")
    assert M.drop_blank(df, ["c"], trim=False).first().c == "  "
    with pytest.raises(ValueError):
        M.clean_names(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))
    ids = spark.createDataFrame([(None, 1), ("x", 2), (None, 1)], "id string, n int")
    made = [r.id for r in M.with_missing_ids(ids, "id", ["n"]).collect()]
    assert made[0] == made[2] and made[1] == "x" and len(made[0]) == 36
    assert len({r.id for r in M.with_missing_ids(ids).collect()}) == 3


def test_row_filters(spark):
    df = spark.createDataFrame([(1, "Spark jobs"), (2, "sparkling"), (3, "a CLOUD-burst"), (4, None)], "id int, t string")
    assert [r.id for r in K.track_keywords(df, "t", ["spark", "cloud"]).orderBy("id").collect()] == [1, 3]
    assert K.track_keywords(df, "t", []).count() == 4
    assert [r.id for r in K.sample(df, "id", 1, 2).orderBy("id").collect()] == [2, 4]
    assert K.sample(df, "t", 0, 5).count() == 0 and K.sample(spark.range(1000), F.col("id").cast("string"), 1, 4).count() in range(200, 300)
    with pytest.raises(ValueError):
        K.sample(df, "id", 3, 2)
    assert K.by_id(df, "2").first().t == "sparkling"
    assert M.with_ids_and_payload(df, "id", "t").count() == 3 and M.keep_mapped(df, "t").count() == 3
