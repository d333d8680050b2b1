"""Streams whose state survives a restart: stable line ids, delivery with receipts, batches flushed by age."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from docflow.session import configure, workspace
from docflow.sources import files, line_stream, streams
from docflow.streaming import age_flush, delivery, delivery_stream, document_log
from registry import Registry
from registry.common import events, write_numbered
from registry.receiver import Receiver

area = Registry()


@area.add("""
    SELECT event_type || '-' || row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS id, event_id FROM events
""")
def stream_line_ids(spark, sf_dir):
    # Half of the files arrive, the stream stops, the others arrive, and it starts again.
    configure(spark)
    text = events(spark, sf_dir).select("event_type", "event_id", F.col("event_id").cast("string").alias("line"))
    folder, log = workspace(spark, "lines"), document_log.DocumentLog(spark, workspace(spark, "line-log"))
    state = {name: workspace(spark, f"line-{name}") for name in ("progress", "ledger", "checkpoint")}

    def append(batch, batch_id):
        numbered = line_stream.numbered_batch(batch, batch_id, state["ledger"])
        log.append(files.with_line_ids(numbered).withColumn("collection", F.lit("lines")), batch_id)

    for rows in (text.filter("event_type < 'p'"), text.filter("event_type >= 'p'")):
        placed = rows.repartition("event_type").sortWithinPartitions("event_type", "event_id")
        placed.select("line", "event_type").write.mode("append").partitionBy("event_type").text(folder)
        size = sum(size for _, size in line_stream.listed(folder, "*.txt"))
        arriving = line_stream.line_stream(spark, folder, state["progress"], glob="*.txt", max_bytes=size // 3)
        writer = arriving.writeStream.foreachBatch(append).option("checkpointLocation", state["checkpoint"])
        query = writer.trigger(processingTime="0 seconds").start()
        # A restarted source first plans again what it had planned.
        query.processAllAvailable()
        document_log.finish(query)
    line = F.regexp_replace("id", r"^.*event_type=([^/]+)/.*-(\d+)$", "$1-$2")
    return log.documents().select(line.alias("id"), F.col("value").cast("bigint").alias("event_id"))


def _arriving_events(spark, sf_dir, parts: int):
    """Events as documents to send, arriving in files."""
    source = events(spark, sf_dir).select("event_id", F.col("event_type").alias("collection"), F.to_json(F.struct("event_id", "user_id")).alias("json"))
    folder = workspace(configure(spark), "arriving")
    source.repartition(parts, "event_id").sortWithinPartitions("collection", "event_id").write.parquet(folder)
    return streams.arriving_rows(spark, folder, source.schema, max_files=2)


@area.add("SELECT event_id, user_id, event_type AS collection, true AS bounded, 3 AS batches FROM events")
def stream_bounded_batches(spark, sf_dir):
    # Six files arrive at once; a micro-batch takes two of them, so the others wait in their folder.
    out, state = workspace(configure(spark), "bounded"), workspace(spark, "bounded-state")

    def keep(batch, batch_id):
        batch.withColumn("file", F.input_file_name()).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = _arriving_events(spark, sf_dir, 6).writeStream.foreachBatch(keep).option("checkpointLocation", state)
    writer.trigger(availableNow=True).start().awaitTermination()
    taken = spark.read.parquet(out)
    sizes = taken.groupBy("batch").agg(F.countDistinct("file").alias("files"))
    batches = sizes.count()
    seen = taken.join(sizes, "batch").withColumn("user_id", F.get_json_object("json", "$.user_id").cast("bigint"))
    return seen.select("event_id", "user_id", "collection", (F.col("files") <= 2).alias("bounded"), F.lit(batches).alias("batches"))


@area.add("""
    SELECT event_id, user_id, event_type AS collection, false AS at_failed, true AS bounded,
      count(*) OVER () AS receipted, 0 AS failed, true AS each_receipted
    FROM events
""")
def stream_delivery(spark, sf_dir):
    # Three endpoints, one of them down; every request leaves a receipt that is committed with its micro-batch.
    box = Receiver(workspace(configure(spark), "received"), down=("a",))
    folder = workspace(spark, "delivery")
    delivery_stream.register_delivery(spark, "stream_delivery", delivery.Failover(box, ["a", "b", "c"], wait=0.0), folder, 50)
    query = delivery_stream.start_delivery(_arriving_events(spark, sf_dir, 6), "stream_delivery", workspace(spark, "delivery-state"))
    query.awaitTermination()
    totals = delivery_stream.delivery_totals(spark, folder).first()
    arrived = box.arrived(spark, "event_id bigint, user_id bigint")
    requests = arrived.agg(F.countDistinct("request")).first()[0]
    return arrived.select(
        "event_id",
        "user_id",
        "collection",
        (F.col("endpoint") == "a").alias("at_failed"),
        (F.col("size") <= 50).alias("bounded"),
        F.lit(totals["docs"]).alias("receipted"),
        F.lit(totals["failed"]).alias("failed"),
        F.lit(totals["ok"] == requests).alias("each_receipted"),
    )


@area.add("""
    SELECT event_type AS collection, event_id % 4 AS slot, event_id, true AS full_or_old FROM events
""")
def stream_age_flush(spark, sf_dir):
    # Two of six files arrive at a time; what does not fill a batch leaves when it is old.
    wanted = events(spark, sf_dir).count()
    slotted = _arriving_events(spark, sf_dir, 6).withColumn("slot", F.col("event_id") % 4)
    out = workspace(spark, "flushed")
    flushed = age_flush.flush_by_age(slotted, size=64, max_age_millis=1000)
    writer = flushed.writeStream.format("parquet").option("path", out).option("checkpointLocation", workspace(spark, "flush-state"))
    query = writer.trigger(processingTime="0 seconds").start()
    stored = spark.read.schema(age_flush.BATCH)
    try:
        while query.isActive:
            time.sleep(0.5)
            done = query.lastProgress and stored.parquet(out).agg(F.sum(F.size("docs"))).first()[0] or 0
            if done >= wanted:
                break
    finally:
        query.stop()
    if query.exception():
        raise query.exception()
    size = F.size("docs")
    right = F.when(F.col("flushed") == "full", size == 64).otherwise((F.col("flushed") == "age") & (size < 64) & (size > 0))
    rows = stored.parquet(out).select("collection", "slot", right.alias("full_or_old"), F.explode("docs").alias("doc"))
    return rows.select("collection", "slot", F.get_json_object("doc", "$.event_id").cast("bigint").alias("event_id"), "full_or_old")
