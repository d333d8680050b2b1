from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.functions.timeframes import TimeFrame, as_timestamp
from docflow.operators import collections as C


def _names(spark, frame: TimeFrame, *stamps: str) -> list[str | None]:
    df = spark.createDataFrame(list(enumerate(stamps)), "n int, ts string")
    named = df.select("n", frame.collection(F.to_timestamp("ts")).alias("c"))
    return [r.c for r in named.orderBy("n").collect()]


def test_frames_are_closed_on_the_right(spark):
    frame = TimeFrame("test_", "MINUTES", 5, "yyyy-MM-dd-HH-mm")
    assert _names(
        spark, frame, "2015-12-01 01:09:59.999", "2015-12-01 01:10:00.000", "2015-12-01 01:10:00.001", "2015-12-01 00:00:00"
    ) == ["test_2015-12-01-01-05", "test_2015-12-01-01-05", "test_2015-12-01-01-10", "test_2015-12-01-00-00"]
    left = TimeFrame("test_", "MINUTES", 5, "yyyy-MM-dd-HH-mm", closed="left")
    assert _names(spark, left, "2015-12-01 01:10:00.000") == ["test_2015-12-01-01-10"]


def test_half_days_and_short_last_frame(spark):
    half = TimeFrame("e_", "HOURS", 12, "yy-MM-dd_HH")
    assert _names(spark, half, "2024-03-01 12:00:00", "2024-03-01 12:00:01") == ["e_24-03-01_00", "e_24-03-01_12"]
    seven = TimeFrame("e_", "HOURS", 7, "HH")
    assert _names(spark, seven, "2024-03-01 23:59:00", "2024-03-02 00:30:00") == ["e_21", "e_00"]
    assert _names(spark, TimeFrame("e_", "HOURS", 48, "dd"), "2024-03-02 23:00:00") == ["e_02"]


def test_microseconds_are_cut_to_milliseconds(spark):
    frame = TimeFrame("", "SECONDS", 1, "HH:mm:ss")
    assert _names(spark, frame, "2024-01-01 00:00:05.000999") == ["00:00:04"]


def test_local_zone_and_short_day(spark):
    # 2024-03-10 had 23 hours in New York: 02:00 did not exist, local midnight was 05:00 UTC.
    frame = TimeFrame("", "HOURS", 1, "yyyyMMddHH", zone="America/New_York")
    assert _names(spark, frame, "2024-03-10 04:59:59", "2024-03-10 05:00:01", "2024-03-10 07:30:00") == [
        "2024030923", "2024031000", "2024031003"
    ]


def test_frames_of_several_days(spark):
    frame = TimeFrame("w_", "DAYS", 7, "yyyyMMdd", start_date="2024-01-03")
    assert _names(
        spark, frame, "2023-12-31 10:00:00", "2024-01-03 00:00:00", "2024-01-10 00:00:00", "2024-01-10 00:00:01"
    ) == ["w_20240103", "w_20240103", "w_20240103", "w_20240110"]
    df = spark.createDataFrame([(None,)], "ts timestamp")
    assert df.select(frame.collection(F.col("ts")).alias("c")).first().c is None


def test_invalid_frames():
    for options in (
        {"unit": "WEEKS"}, {"unit": "DAYS", "length": 2}, {"length": 0}, {"closed": "both"}, {"unit": "MICROSECONDS"}
    ):
        with pytest.raises(ValueError):
            TimeFrame("x", **options)


def test_name_order():
    assert TimeFrame("x", pattern="yy-MM-dd_HH").sorts_by_time()
    assert not TimeFrame("x", pattern="dd-MM-yy").sorts_by_time()
    assert not TimeFrame("x", pattern="yyyy-M-d").sorts_by_time()


def test_time_values(spark):
    df = spark.createDataFrame(
        [("2024-01-02T03:04:05Z", 1704164645000, 17, "02/01/2024")], "iso string, ms bigint, small int, custom string"
    )
    row = df.select(
        F.unix_millis(as_timestamp(F.col("iso"), T.StringType())).alias("iso"),
        F.unix_millis(as_timestamp(F.col("ms"), T.LongType())).alias("ms"),
        as_timestamp(F.col("small"), T.IntegerType()).alias("small"),
        F.unix_millis(as_timestamp(F.col("custom"), T.StringType(), ("dd/MM/yyyy",))).alias("custom"),
    ).first()
    assert (row.iso, row.ms, row.small, row.custom) == (1704164645000, 1704164645000, None, 1704153600000)


def test_rejects_and_strict_mode(spark):
    df = spark.createDataFrame([(1, "2024-01-01 05:00:00"), (2, None), (3, "later")], "id int, ts string")
    assigned = C.time_frame_collection(df, "ts", TimeFrame("e_", "HOURS", 12, "yyMMddHH"))
    assert [r.collection for r in C.routed(assigned).collect()] == ["e_24010100"]
    assert {r.id: r.error for r in C.unroutable(assigned).collect()} == {2: C.NO_TIMESTAMP, 3: C.BAD_TIMESTAMP}
    with pytest.raises(Exception, match="timestamp"):
        C.fail_on_unroutable(assigned).collect()


def test_alias_ignores_late_old_collections(spark):
    df = spark.createDataFrame([(f"c{i:02}", i) for i in (5, 1, 9, 3, 7, 9, 0)], "collection string, n int")
    assert {r.collection for r in C.newest_collections(df, 3).collect()} == {"c05", "c07", "c09"}
    assert C.newest_collections(df, 0).count() == 6
    assert C.through_alias(df, 3).count() == 4
    assert C.through_alias(df, 0).count() == 7


def test_frame_plan_stays_in_the_jvm(spark):
    df = spark.range(5).select(F.timestamp_millis("id").alias("ts"))
    frame = TimeFrame("e_", "HOURS", 12, "yyMMddHH")
    plan = df.select(frame.collection(F.col("ts")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_partition_pruning_through_the_alias(spark, tmp_path):
    target = str(tmp_path / "docs")
    spark.range(100).select("id", F.concat(F.lit("c"), F.col("id") % 10).alias("collection")).write.partitionBy("collection").parquet(target)
    registry = spark.range(10).select(F.concat(F.lit("c"), "id").alias("collection"))
    plan = C.through_alias(spark.read.parquet(target), 2, registry)
    assert {r.collection for r in plan.collect()} == {"c8", "c9"}
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [collection" in text and "Join" not in text
