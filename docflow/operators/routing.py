"""Routing documents to shards and to the writer tasks of a shard."""

from __future__ import annotations

import bisect
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions.hashing import murmur3, shard_of_hash, spread_of_hash

INT_MIN, INT_MAX = -(1 << 31), (1 << 31) - 1


def tasks_per_shard(total_tasks: int, shards: int) -> int:
    """Writer tasks of each shard; the total must be a multiple of the number of shards."""
    if shards < 1:
        raise ValueError("a layout needs at least one shard")
    if total_tasks < shards or total_tasks % shards:
        raise ValueError(f"{total_tasks} tasks cannot be shared evenly by {shards} shards")
    return total_tasks // shards


def with_shard(
    df: DataFrame, key: str | Column, shards: int, tasks: int = 1, tie: Column | None = None
) -> DataFrame:
    """Add ``hash``, ``shard`` and ``slot``; ``tasks`` writers serve each shard.

    The slot of a shard's writers is the shard plus a multiple of the number of shards, hence
    ``slot % shards == shard``. A document without an id goes to the first shard. ``tie`` keeps
    copies of one hot id from all landing in the same slot.
    """
    hashed = df.withColumn("hash", murmur3(key))
    shard = shard_of_hash(F.col("hash"), shards)
    spread = spread_of_hash(F.col("hash"), tasks, tie)
    return hashed.withColumn("shard", shard).withColumn("slot", F.col("shard") + spread * F.lit(shards))


@dataclass(frozen=True)
class HotId:
    """An id with at least a given share of the documents, and the writers that serve it alone."""

    id: str
    docs: int
    shard: int
    first: int
    writers: int


def hot_ids(df: DataFrame, key: str | Column, shards: int, tasks: int = 1, share: float = 0.01) -> list[HotId]:
    """The ids that hold at least ``share`` of all documents, with writers in proportion to their documents.

    One scan with a mergeable sketch of the most frequent items: a task and the driver hold a number of
    ids that follows from ``share``, not from the data. The sketch may count an id too high by up to half of
    ``share``, never too low, so that no hot id is missed; ids from half of ``share`` on may be named too.
    Documents without an id take no part.
    """
    if not 0.0001 <= share <= 1:
        raise ValueError("a hot id holds between a ten-thousandth and all of the documents")
    column = F.col(key) if isinstance(key, str) else key
    ids = df.select(column.cast("string").alias("id")).filter(F.col("id").isNotNull())
    # The sketch's error is at most 3.5 parts of the items it tracks.
    kept, tracked = math.ceil(2 / share), math.ceil(7 / share)
    told = ids.agg(F.count(F.lit(1)).alias("total"), F.expr(f"approx_top_k(id, {kept}, {tracked})").alias("top")).first()
    wanted = [(r["item"], r["count"]) for r in told["top"] or [] if r["count"] >= share * told["total"]]
    if not wanted:
        return []
    named = df.sparkSession.createDataFrame(wanted, "id string, docs bigint")
    rows = named.select("id", "docs", shard_of_hash(murmur3("id"), shards).alias("shard")).collect()
    cold = told["total"] - sum(r["docs"] for r in rows)
    # As many documents as a writer of the other ids gets; a share bounds the writers if there are none.
    load = max(cold / (shards * tasks), share * told["total"] / 2, 1)
    found, used = [], [tasks] * shards
    for r in sorted(rows, key=lambda r: (-r["docs"], r["id"])):
        writers = math.ceil(r["docs"] / load)
        found.append(HotId(r["id"], r["docs"], r["shard"], used[r["shard"]], writers))
        used[r["shard"]] += writers
    return found


def with_shard_by_heat(
    df: DataFrame, key: str | Column, shards: int, tasks: int, tie: Column, hot: list[HotId]
) -> DataFrame:
    """``with_shard`` where all documents of an id share a slot, but for hot ids, which have slots of their own.

    ``tie`` spreads the documents of a hot id over its slots; a NULL tie goes to the first of them. ``slot % shards == shard``
    holds for all slots. The table of hot ids has at most two divided by their share rows.
    """
    own = [(h.id, h.first, h.writers) for h in hot]
    table = df.sparkSession.createDataFrame(own, "_hot string, _first int, _writers int")
    column = F.col(key) if isinstance(key, str) else key
    placed = with_shard(df.withColumn("_id", column.cast("string")), column, shards, tasks)
    joined = placed.join(table, F.col("_id") == F.col("_hot"), "left")
    spread = F.col("_first") + F.coalesce(F.pmod(F.xxhash64(tie), F.col("_writers")).cast("int"), F.lit(0))
    slot = F.when(F.col("_hot").isNotNull(), F.col("shard") + spread * F.lit(shards)).otherwise(F.col("slot"))
    return joined.withColumn("slot", slot).drop("_id", "_hot", "_first", "_writers")


def place_by_slot(df: DataFrame, slots: int) -> DataFrame:
    """Send slot i to partition i, so that one task owns one hash range."""
    return df.repartitionById(slots, F.col("slot"))


def place_evenly(df: DataFrame, tasks: int) -> DataFrame:
    """Deal rows out evenly, regardless of content."""
    return df.repartition(tasks)


@dataclass(frozen=True)
class ShardRange:
    """A shard and the inclusive range of signed 32-bit hashes it owns."""

    shard: str
    low: int
    high: int


def check_layout(ranges: list[ShardRange]) -> list[ShardRange]:
    """The ranges in order, if together they cover every hash exactly once."""
    if not ranges:
        raise ValueError("the layout has no shards; implicit routing is not supported")
    ordered = sorted(ranges, key=lambda r: r.low)
    expected = INT_MIN
    for r in ordered:
        if r.low != expected or r.high < r.low:
            raise ValueError(f"range of shard {r.shard!r} leaves a gap or overlaps at {expected}")
        expected = r.high + 1
    if expected != INT_MAX + 1:
        raise ValueError(f"hashes from {expected} on belong to no shard")
    return ordered


def equal_ranges(names: list[str]) -> list[ShardRange]:
    """Equal, contiguous ranges for the named shards."""
    n = len(names)
    starts = [INT_MIN + -(-(i << 32) // n) for i in range(n)] + [INT_MAX + 1]
    return [ShardRange(name, starts[i], starts[i + 1] - 1) for i, name in enumerate(names)]


def layout_table(spark: SparkSession, ranges: list[ShardRange]) -> DataFrame:
    """The layout as a lookup table: a row for each (leading bits of the hash, range it meets)."""
    ordered = check_layout(ranges)
    lows = [r.low for r in ordered]
    rows = []
    rest = 32 - leading_bits(ordered)
    for top in range(INT_MIN >> rest, (INT_MAX >> rest) + 1):
        first, last = top << rest, (top << rest) + (1 << rest) - 1
        for r in ordered[bisect.bisect_right(lows, first) - 1 : bisect.bisect_right(lows, last)]:
            rows.append((top, r.low, r.high, r.shard))
    return spark.createDataFrame(rows, "top int, low int, high int, owner string")


def leading_bits(ranges: list[ShardRange]) -> int:
    """Bits of the hash to join on: four times as many values as ranges, 256 at least."""
    return min(32, max(8, len(ranges).bit_length() + 2))


def with_owner(df: DataFrame, key: str | Column, ranges: list[ShardRange]) -> DataFrame:
    """Add ``owner``, the shard whose range holds the hash of ``key``; no key means the first shard.

    An equality join on the leading bits of the hash, whose number grows with the layout; the range
    test only decides among the few ranges that share them. Spark broadcasts the table while it
    is small, and the many join keys of a large one spread a shuffle.
    """
    ordered = check_layout(ranges)
    hashed = df.withColumn("_hash", murmur3(key)).withColumn("_top", F.shiftright("_hash", 32 - leading_bits(ordered)))
    table = layout_table(df.sparkSession, ordered)
    fits = (F.col("_top") == F.col("top")) & F.col("_hash").between(F.col("low"), F.col("high"))
    joined = hashed.join(table, fits, "left")
    return joined.withColumn("owner", F.coalesce("owner", F.lit(ordered[0].shard))).drop(
        "_hash", "_top", "top", "low", "high"
    )


def shard_report(df: DataFrame, by: tuple[str, ...] = ("shard", "slot")) -> DataFrame:
    """Documents of each shard (and slot), to show skew."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("docs"))
