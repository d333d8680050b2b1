"""Hash routing to shards and slots."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions.hashing import murmur3
from docflow.operators import routing as R
from registry import Registry
from registry.common import events, murmur3_sql, table

area = Registry()


def _shard(h: str, n: int) -> str:
    return f"coalesce((({h} + 2147483648) * {n}) // 4294967296, 0)"


@area.add(f"SELECT c_custkey, h AS hash, {_shard('h', 5)} AS shard FROM ({murmur3_sql('customer', 'c_name', 'c_custkey')})")
def shard_hash_range(spark, sf_dir):
    df = R.with_shard(table(spark, sf_dir, "customer"), "c_name", 5)
    return df.select("c_custkey", "hash", "shard")


@area.add(f"SELECT page_id, h AS hash FROM ({murmur3_sql('pages', 'url', 'page_id')})")
def hash_urls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", murmur3("url").alias("hash"))


@area.add(f"SELECT conv_id, turn, h AS hash FROM ({murmur3_sql('conversations', 'text', 'conv_id, turn')})")
def hash_whole_texts(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", murmur3("text").alias("hash"))


_IDS = murmur3_sql("events", "event_id::VARCHAR", "event_id")
_SALT = "((h % 4294967296 + 4294967296) % 4294967296 // 256) % 3"


@area.add(f"SELECT event_id, {_shard('h', 3)} AS shard, {_shard('h', 3)} + 3 * ({_SALT}) AS slot FROM ({_IDS})")
def shard_slot_spread(spark, sf_dir):
    df = R.with_shard(events(spark, sf_dir), F.col("event_id"), 3, R.tasks_per_shard(9, 3))
    return df.select("event_id", "shard", "slot")


@area.add(f"""
    SELECT shard, slot, count(*) AS docs
    FROM (SELECT {_shard('h', 3)} AS shard, {_shard('h', 3)} + 3 * ({_SALT}) AS slot FROM ({_IDS}))
    GROUP BY 1, 2
""")
def shard_skew(spark, sf_dir):
    return R.shard_report(R.with_shard(events(spark, sf_dir), F.col("event_id"), 3, 3))


@area.add("""
    SELECT user_id, count(DISTINCT (epoch_us(ts) // 1000) % 9)::INTEGER AS slots, true AS one_shard FROM events GROUP BY user_id
""")
def hot_id_spread(spark, sf_dir):
    # All events of a user share one hash and shard; the time spreads them over all its writers.
    placed = R.with_shard(events(spark, sf_dir), F.col("user_id"), 4, 9, tie=F.unix_millis("ts"))
    return (
        placed.groupBy("user_id")
        .agg(F.countDistinct("slot").alias("slots"), (F.countDistinct("shard") == 1).alias("one_shard"))
        .select("user_id", F.col("slots").cast("int").alias("slots"), "one_shard")
    )


_HEATED = "SELECT *, CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE user_id::VARCHAR END AS id FROM events"


@area.add(f"""
    SELECT event_id, {_shard('h', 4)} AS shard, event_id % 3 = 0 AS own_writers, true AS fits, true AS even
    FROM ({murmur3_sql(f"({_HEATED})", 'id', 'event_id')})
""")
def hot_ids_found(spark, sf_dir):
    # One id, not declared anywhere, holds a third of the events: it gets writers of its own, within its shard.
    named = events(spark, sf_dir).withColumn("id", F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("user_id").cast("string")))
    placed = R.with_shard_by_heat(named, "id", 4, 3, F.col("event_id"), R.hot_ids(named, "id", 4, 3, share=0.1))
    # No writer of the hot id gets twice what the other twelve get on average.
    own = F.col("slot") >= 12
    sizes = R.shard_report(placed, ("slot",)).agg((F.max(F.when(own, F.col("docs"))) < 2 * F.sum(F.when(~own, F.col("docs"))) / 12).alias("even"))
    told = placed.select("event_id", "shard", own.alias("own_writers"), (F.col("slot") % 4 == F.col("shard")).alias("fits"))
    return told.withColumn("even", F.lit(sizes.first()["even"]))


_LAYOUT = [
    R.ShardRange("small", R.INT_MIN, -2_000_000_000),
    R.ShardRange("large", -1_999_999_999, 999_999_999),
    R.ShardRange("rest", 1_000_000_000, R.INT_MAX),
]


@area.add(f"""
    WITH layout(owner, low, high) AS (VALUES
      ('small', -2147483648, -2000000000), ('large', -1999999999, 999999999), ('rest', 1000000000, 2147483647))
    SELECT c_custkey, owner FROM ({murmur3_sql('customer', 'c_name', 'c_custkey')}) JOIN layout ON h BETWEEN low AND high
""")
def shard_range_join(spark, sf_dir):
    return R.with_owner(table(spark, sf_dir, "customer"), "c_name", _LAYOUT).select("c_custkey", "owner")


@area.add(f"""
    SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE {_shard('h', 7)} END AS shard
    FROM ({murmur3_sql('part', 'p_partkey::VARCHAR', 'p_partkey')})
""")
def shard_null_id(spark, sf_dir):
    key = F.when(F.col("p_partkey") % 4 != 0, F.col("p_partkey"))
    return R.with_shard(table(spark, sf_dir, "part"), key, 7).select("p_partkey", "shard")


@area.add(f"""
    SELECT slot, count(*) AS docs, 0 AS misplaced
    FROM (SELECT {_shard('h', 3)} + 3 * ({_SALT}) AS slot FROM ({_IDS})) GROUP BY 1
""")
def slot_placement(spark, sf_dir):
    placed = R.place_by_slot(R.with_shard(events(spark, sf_dir), F.col("event_id"), 3, 3), 9)
    located = placed.select("slot", F.spark_partition_id().alias("place"))
    return located.groupBy("slot").agg(
        F.count(F.lit(1)).alias("docs"), F.count_if(F.col("place") != F.col("slot")).alias("misplaced")
    )


@area.add("SELECT count(*) AS docs, 8 AS tasks, true AS even FROM lineitem")
def even_placement(spark, sf_dir):
    dealt = R.place_evenly(table(spark, sf_dir, "lineitem").select("l_orderkey"), 8)
    sizes = dealt.groupBy(F.spark_partition_id().alias("place")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.sum("n").alias("docs"),
        F.count(F.lit(1)).alias("tasks"),
        (F.max("n") - F.min("n") < 0.01 * F.sum("n") + 8).alias("even"),
    )
