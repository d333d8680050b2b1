from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docflow.functions.hashing import murmur3
from docflow.operators import routing as R

# Published vectors of the hash.
VECTORS = {"": 0x0, "test": 0xBA6BD213, "hello": 0x248BFA47, "Hello, world!": 0xC0363E43, "doc0": 0x83B0A212, "é日本": 0xE96ED14F}


def test_hash_vectors(spark):
    df = spark.createDataFrame(list(VECTORS.items()), "k string, v bigint")
    for row in df.select("v", murmur3("k").alias("h")).collect():
        assert row.h % (1 << 32) == row.v


def _reference_hash(data: bytes) -> int:
    """Byte-wise hash, as published, to compare the vectorised one with."""
    mask, h = 0xFFFFFFFF, 0

    def mix(k):
        k = (k * 0xCC9E2D51) & mask
        k = ((k << 15) | (k >> 17)) & mask
        return (k * 0x1B873593) & mask

    whole = len(data) // 4 * 4
    for i in range(0, whole, 4):
        h ^= mix(int.from_bytes(data[i : i + 4], "little"))
        h = ((h << 13) | (h >> 19)) & mask
        h = (h * 5 + 0xE6546B64) & mask
    if data[whole:]:
        h ^= mix(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    h = ((h ^ (h >> 16)) * 0x85EBCA6B) & mask
    h = ((h ^ (h >> 13)) * 0xC2B2AE35) & mask
    return h ^ (h >> 16)


def test_hash_of_every_length_and_null(spark):
    keys = [("日é" * n)[:n] + "x" * (n % 5) for n in range(60)] + [None, ""]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").repartition(3).select("k", murmur3("k").alias("h")).collect()
    assert len(rows) == len(keys)
    for row in rows:
        if row.k is None:
            assert row.h is None
        else:
            assert row.h % (1 << 32) == _reference_hash(row.k.encode())


@pytest.mark.parametrize("shards, tasks", [(3, 9), (1, 3), (3, 6), (5, 5)])
def test_slots_belong_to_their_shard(spark, shards, tasks):
    ids = spark.range(1000).select(F.concat(F.lit("doc"), "id").alias("id"))
    placed = R.with_shard(ids, "id", shards, R.tasks_per_shard(tasks, shards)).collect()
    assert len(placed) == 1000
    assert all((r.slot - r.shard) % shards == 0 and 0 <= r.slot < tasks for r in placed)
    assert {r.slot for r in placed} == set(range(tasks))


def test_slot_i_is_partition_i(spark):
    ids = spark.range(500).select(F.col("id").cast("string").alias("id"))
    placed = R.place_by_slot(R.with_shard(ids, "id", 2, 3), 6)
    assert placed.rdd.getNumPartitions() == 6
    assert placed.filter(F.spark_partition_id() != F.col("slot")).count() == 0


def test_hot_id_uses_all_writers(spark):
    events = spark.range(1000).select(F.lit("hot").alias("id"), "id").toDF("id", "ts")
    placed = R.with_shard(events, "id", 4, 5, tie=F.col("ts"))
    assert placed.select("shard").distinct().count() == 1
    assert sorted(r["count"] for r in placed.groupBy("slot").count().collect()) == [200] * 5


def test_missing_id_goes_to_the_first_shard(spark):
    df = spark.createDataFrame([(None,)], "id string")
    assert R.with_shard(df, "id", 4, 2).select("shard", "slot").first() == (0, 0)
    assert R.with_owner(df, "id", R.equal_ranges(["a", "b"])).first().owner == "a"


def test_equal_ranges_agree_with_the_formula(spark):
    ids = spark.range(2000).select(F.col("id").cast("string").alias("id"))
    for n in (1, 3, 7):
        both = R.with_owner(R.with_shard(ids, "id", n), "id", R.equal_ranges([str(i) for i in range(n)]))
        assert both.filter(F.col("owner") != F.col("shard").cast("string")).count() == 0


def test_layout_checks():
    with pytest.raises(ValueError):
        R.tasks_per_shard(8, 3)
    with pytest.raises(ValueError):
        R.tasks_per_shard(0, 0)
    with pytest.raises(ValueError):
        R.check_layout([])
    with pytest.raises(ValueError):
        R.check_layout([R.ShardRange("a", R.INT_MIN, 0), R.ShardRange("b", 2, R.INT_MAX)])
    with pytest.raises(ValueError):
        R.check_layout([R.ShardRange("a", R.INT_MIN, 0)])
    assert R.check_layout(R.equal_ranges(list("abcdef")))


def test_owner_lookup_is_an_equality_join(spark):
    plan = R.with_owner(spark.range(10).withColumn("k", F.col("id").cast("string")), "k", R.equal_ranges(list("abc")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "_top" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_even_placement(spark):
    assert R.place_evenly(spark.range(100), 5).rdd.getNumPartitions() == 5


def test_hot_ids_get_writers_of_their_own(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, "warm").when(F.col("id") % 50 != 2, F.concat(F.lit("u"), F.col("id") % 7001)).alias("key"),
        F.when(F.col("id") % 4 > 0, F.col("id")).alias("tie"),
        F.lit(1).alias("_first_seen"),
    ).repartition(8)
    hot = R.hot_ids(rows, "key", 4, 3, share=0.05)
    assert [h.id for h in hot] == ["hot", "warm"] and all(h.first >= 3 for h in hot) and hot[0].writers > hot[1].writers
    exact = {r["key"]: r["count"] for r in rows.filter("key IN ('hot', 'warm')").groupBy("key").count().collect()}
    assert all(exact[h.id] <= h.docs <= exact[h.id] + 0.025 * 60_000 for h in hot)
    placed = R.with_shard_by_heat(rows, "key", 4, 3, F.col("tie"), hot)
    assert placed.count() == 60_000 and placed.filter("slot % 4 <> shard").isEmpty()
    same = placed.select("key", "shard").distinct().exceptAll(R.with_shard(rows, "key", 4).select("key", "shard").distinct())
    assert same.isEmpty()
    slots = {r.key: r.slots for r in placed.groupBy("key").agg(F.countDistinct("slot").alias("slots")).collect()}
    assert all(n == 1 for key, n in slots.items() if key not in ("hot", "warm")) and slots["hot"] == hot[0].writers
    assert R.hot_ids(rows.filter("key = 'none'"), "key", 4, 3) == []
    assert R.hot_ids(rows.filter("key IS NULL"), "key", 4, 3) == []
    only = R.hot_ids(rows.filter("key = 'hot'"), "key", 4, 3, share=0.05)
    assert [(h.id, h.docs) for h in only] == [("hot", 20_000)] and only[0].writers <= 40
    assert R.with_shard_by_heat(rows, "key", 4, 3, F.col("tie"), []).filter("slot >= 12").isEmpty()
    with pytest.raises(ValueError):
        R.hot_ids(rows, "key", 4, share=0.0)
