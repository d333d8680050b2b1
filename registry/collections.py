"""Assigning documents to collections by time, and the rolling alias over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions.timeframes import TimeFrame, as_timestamp
from docflow.operators import collections as C
from registry import Registry
from registry.common import COLLECTION_SQL, TWELVE_HOURS, events, frame_sql, table

area = Registry()


@area.add(f"SELECT event_id, {COLLECTION_SQL} AS collection FROM events")
def collection_per_12h(spark, sf_dir):
    df = events(spark, sf_dir)
    return C.routed(C.time_frame_collection(df, "ts", TWELVE_HOURS)).select("event_id", "collection")


_FIVE = frame_sql("t_", 300_000, "%Y-%m-%d-%H-%M", "moment")
_FIVE_LEFT = frame_sql("t_", 300_000, "%Y-%m-%d-%H-%M", "moment", ahead="")


@area.add(f"""
    SELECT event_id, {_FIVE} AS collection, {_FIVE_LEFT} AS left_closed
    FROM (SELECT event_id, date_trunc('minute', ts) AS moment FROM events)
    UNION ALL
    SELECT event_id, {_FIVE}, {_FIVE_LEFT} FROM (SELECT event_id, date_trunc('day', ts) AS moment FROM events)
""")
def collection_5min_boundary(spark, sf_dir):
    # Whole minutes and midnights: one in five of the former lies exactly on a boundary.
    df = events(spark, sf_dir)
    minutes = df.select("event_id", F.date_trunc("MINUTE", "ts").alias("moment"))
    days = df.select("event_id", F.date_trunc("DAY", "ts").alias("moment"))
    options = dict(base="t_", unit="MINUTES", length=5, pattern="yyyy-MM-dd-HH-mm")
    right, left = TimeFrame(**options), TimeFrame(**options, closed="left")
    return minutes.union(days).select(
        "event_id",
        right.collection(F.col("moment")).alias("collection"),
        left.collection(F.col("moment")).alias("left_closed"),
    )


_WEEKLY = frame_sql("orders_", 7 * 86_400_000, "%Y-%m-%d", "o_orderdate", "TIMESTAMP '1996-01-01'")


@area.add(f"SELECT o_orderkey, {_WEEKLY} AS collection FROM orders")
def collection_multiday(spark, sf_dir):
    frame = TimeFrame("orders_", "DAYS", 7, "yyyy-MM-dd", start_date="1996-01-01")
    named = C.routed(C.time_frame_collection(table(spark, sf_dir, "orders"), "o_orderdate", frame))
    return named.select("o_orderkey", "collection")


@area.add("""
    WITH shipped AS (
      SELECT l_orderkey, l_linenumber,
        (l_shipdate + to_minutes(l_orderkey % 1440)) AT TIME ZONE 'UTC' AS moment FROM lineitem
    ), dated AS (
      SELECT *, epoch_ms(date_trunc('day', moment AT TIME ZONE 'America/New_York') AT TIME ZONE 'America/New_York') AS day
      FROM shipped
    ), framed AS (
      SELECT *, day + greatest(0, ((epoch_us(moment) // 1000) - day - 1) // 25200000) * 25200000 AS start FROM dated
    )
    SELECT 'ny_' || strftime(to_timestamp(start / 1000) AT TIME ZONE 'America/New_York', '%Y%m%d%H') AS collection,
      count(*) AS docs
    FROM framed GROUP BY 1
""")
def collection_local_zone(spark, sf_dir):
    # Seven-hour frames restart at each local midnight, on days of 23, 24 and 25 hours.
    frame = TimeFrame("ny_", "HOURS", 7, "yyyyMMddHH", zone="America/New_York")
    shipped = table(spark, sf_dir, "lineitem").select(
        F.timestamp_add("MINUTE", F.col("l_orderkey") % 1440, F.col("l_shipdate").cast("timestamp")).alias("moment")
    )
    return C.collection_registry(shipped.select(frame.collection(F.col("moment")).alias("collection")))


@area.add("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'finished' ELSE 'main' END AS collection FROM orders
""")
def collection_fixed(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    given = F.when(F.col("o_orderstatus") == "F", "finished")
    return C.fixed_collection(df, given, "main").select("o_orderkey", "collection")


@area.add("""
    SELECT event_id, epoch_us(ts) // 1000 AS from_text, epoch_us(ts) // 1000 AS from_epoch, epoch_ms(date_trunc('day', ts)) AS from_date,
      true AS int_unreadable
    FROM events
""")
def timestamp_coercion(spark, sf_dir):
    df = events(spark, sf_dir).select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("text"),
        F.unix_millis("ts").alias("epoch"),
        F.to_date("ts").alias("date"),
        (F.col("event_id") % 1000).cast("int").alias("number"),
    )
    read = {c: as_timestamp(F.col(c), df.schema[c].dataType) for c in ("text", "epoch", "date", "number")}
    return df.select(
        "event_id",
        F.unix_millis(read["text"]).alias("from_text"),
        F.unix_millis(read["epoch"]).alias("from_epoch"),
        F.unix_millis(read["date"]).alias("from_date"),
        read["number"].isNull().alias("int_unreadable"),
    )


@area.add("""
    SELECT CASE WHEN event_id % 5 = 0 THEN 'no timestamp' ELSE 'unreadable timestamp' END AS error, count(*) AS docs
    FROM events WHERE event_id % 5 = 0 OR event_id % 7 = 0 GROUP BY 1
""")
def timestamp_rejects(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    broken = F.when(F.col("event_id") % 5 == 0, F.lit(None)).when(F.col("event_id") % 7 == 0, "soon").otherwise(text)
    df = events(spark, sf_dir).select("event_id", broken.alias("ts"))
    rejects = C.unroutable(C.time_frame_collection(df, "ts", TWELVE_HOURS))
    return rejects.groupBy("error").agg(F.count(F.lit(1)).alias("docs"))


@area.add(f"SELECT DISTINCT {COLLECTION_SQL} AS collection FROM events ORDER BY 1 DESC LIMIT 5")
def rolling_alias(spark, sf_dir):
    named = C.routed(C.time_frame_collection(events(spark, sf_dir), "ts", TWELVE_HOURS))
    return C.newest_collections(named, 5)


@area.add(f"""
    WITH named AS (SELECT event_id, {COLLECTION_SQL} AS collection FROM events),
    alias AS (SELECT DISTINCT collection FROM named ORDER BY 1 DESC LIMIT 5)
    SELECT event_id, collection FROM named WHERE collection IN (SELECT collection FROM alias)
""")
def rolling_alias_read(spark, sf_dir):
    named = C.routed(C.time_frame_collection(events(spark, sf_dir), "ts", TWELVE_HOURS))
    return C.through_alias(named.select("event_id", "collection"), 5)
