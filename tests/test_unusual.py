"""Inputs that once were cut, lost or failed the job."""

from __future__ import annotations

import json
import time

import numpy as np
import pyarrow as pa

from docflow.functions.hashing import murmur3_of_batch
from docflow.operators import blocks as B
from docflow.operators import flatten as N
from docflow.operators import routing as R
from docflow.sources import delimited as D
from docflow.sources import json_lines as J
from docflow.streaming.document_log import DocumentLog


def test_control_characters_stay_in_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\x01y\n2,\x00z\x01\x01\n", newline="\n")
    cells = {}
    for fields in (None, ["id", "name"]):
        cells[bool(fields)] = sorted(r.cells for r in D.parse_delimited(spark, str(tmp_path), fields=fields).collect())
    assert cells[True] == cells[False]
    assert ["1", "x\x01y"] in cells[True]


def test_unusual_json(spark):
    long_number = "7" * 5000
    lines = ['{"a":"\\ud800"}', '\t{"b":1}', "   ", '{"n":' + long_number + "}", '{"a":' * 300 + "1" + "}" * 300, "{", '{"c":2}']
    deep = "[" * 30_000 + "]" * 30_000
    df = spark.createDataFrame(list(enumerate([*lines, '{"d":' + deep + "}"])), "id int, value string")
    flat = {r.id: r for r in N.flatten_json(df, "value").collect()}
    assert [i for i, r in flat.items() if r.error] == [2, 5, 7]
    assert flat[2].error == flat[5].error == N.MALFORMED and flat[7].error == N.TOO_DEEP
    assert flat[0].flat == '{"a":"\\ud800"}' and flat[3].flat == '{"n":' + long_number + "}"
    parsed = {r.id: r.error for r in J.parse_json_lines(df, "value").select("id", "error").collect()}
    assert parsed[1] is None and parsed[2] == parsed[5] == J.MALFORMED and parsed[7] == J.TOO_DEEP
    nodes = {r.id: r for r in B.parse_blocks(df, "id", "value").collect()}
    assert nodes[0].error is None and nodes[7].error == N.TOO_DEEP


def test_one_long_key_costs_little():
    keys = [f"key {i}" for i in range(10_000)] + ["x" * 2_000_000, "y" * 1_000_001]
    started = time.perf_counter()
    together = murmur3_of_batch(pa.array(keys))
    assert time.perf_counter() - started < 3
    alone = [int(murmur3_of_batch(pa.array([k]))[0]) for k in (keys[5], *keys[-2:])]
    assert [int(together[5]), *map(int, together[-2:])] == alone
    assert together.dtype == np.uint32


def test_batches_of_different_columns_and_repeated_commits(spark, tmp_path):
    log = DocumentLog(spark, str(tmp_path / "log"))
    log.append(spark.createDataFrame([("c", "1", "x")], "collection string, id string, a_s string"), 0)
    second = spark.createDataFrame([("c", "2", "y", 5), ("c", "1", "z", 6)], "collection string, id string, b_s string, n_i int")
    log.append(second, 1)
    log.append(second.limit(0), 1)
    rows = {r.id: r for r in log.current().collect()}
    assert (rows["2"].b_s, rows["2"].n_i, rows["2"].a_s) == ("y", 5, None)
    assert rows["1"].b_s == "z" and log.documents().count() == 3


def test_many_ranges(spark):
    ranges = R.equal_ranges([f"s{i}" for i in range(12_000)])
    df = spark.range(500).selectExpr("cast(id as string) AS id")
    assert len(R.layout_table(spark, ranges).columns) == 4
    owners = {r.id: (r.owner, r.shard) for r in R.with_shard(R.with_owner(df, "id", ranges), "id", 12_000).collect()}
    assert all(owner == f"s{shard}" for owner, shard in owners.values())


def test_long_numbers_keep_their_digits():
    decode, encode = N.json_codec()
    text = json.dumps({"n": [1]}).replace("1", "9" * 6000).replace(" ", "")
    assert encode(decode(text)) == text
