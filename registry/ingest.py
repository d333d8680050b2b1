"""Text sources, sinks, delivery, metrics, complete jobs and streams.

Input files are written from the tables by Spark first, into the folder the session names.
"""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from docflow.functions.variants import as_text
from docflow.operators import batches, blocks, upsert
from docflow.operators import collections as C
from docflow.operators.ranking import number_rows
from docflow.operators.routing import INT_MAX, INT_MIN, ShardRange, equal_ranges, shard_report, with_shard
from docflow.plans import jobs
from docflow.session import configure, workspace
from docflow.sources import delimited, files, json_lines, streams
from docflow.streaming import delivery, document_log, latency
from docflow.streaming.progress import counted
from registry import Registry
from registry import log_lines as lines
from registry.common import COLLECTION_SQL, TWELVE_HOURS, events, murmur3_sql, table, write_lines, write_numbered
from registry.json_records import _BLOCKS_SQL, _FULL_NAMES, order_records
from registry.receiver import Receiver
from registry.routing import _shard

area = Registry()


# --- files -----------------------------------------------------------------------------------


@area.add("""
    SELECT event_type, 1::BIGINT AS files, sum(octet_length(encode(event_id || ' ' || coalesce(props, ''))) + 1)::BIGINT AS length
    FROM events GROUP BY event_type
""")
def file_listing(spark, sf_dir):
    # One file of lines for each type, beside files that the pattern leaves out and below folders that are not entered.
    line = F.concat_ws(" ", F.col("event_id").cast("string"), F.coalesce("props", F.lit("")))
    text = events(spark, sf_dir).select("event_type", "event_id", line.alias("line"))
    folder = write_numbered(spark, text, "event_type", "event_id", "listed")
    text.groupBy("event_type").agg(F.count("*").cast("string").alias("line")).write.mode("append").partitionBy("event_type").json(folder)
    text.select("event_type", F.lit("deeper").alias("sub"), "line").write.mode("append").partitionBy("event_type", "sub").text(folder)
    found = files.list_files(spark, f"{folder}/*", "*.txt")
    kind = F.regexp_extract("file_uri", r"event_type=([^/]+)/[^/]+$", 1)
    return found.groupBy(kind.alias("event_type")).agg(F.count("*").alias("files"), F.sum("length").alias("length"))


# --- lines -----------------------------------------------------------------------------------


def _order_lines(spark, sf_dir) -> str:
    """Order keys in ascending order within each file, every tenth line blank."""
    text = F.when(F.col("o_orderkey") % 10 == 0, "").otherwise(F.concat(F.lit("order "), F.col("o_orderkey")))
    placed = table(spark, sf_dir, "orders").repartition(6, "o_custkey").sortWithinPartitions("o_orderkey")
    return write_lines(spark, placed.select(text.alias("line")), "order-lines")


@area.add("""
    SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS line_no FROM orders
""")
def line_numbers(spark, sf_dir):
    text = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", F.col("o_orderkey").cast("string").alias("line"))
    folder = write_numbered(spark, text, "o_orderpriority", "o_orderkey", "order-numbers")
    numbered = files.with_line_numbers(files.read_lines(spark, folder))
    group = F.url_decode(F.regexp_extract("file", "o_orderpriority=([^/]+)", 1))
    return numbered.select(group.alias("o_orderpriority"), F.col("value").cast("bigint").alias("o_orderkey"), "line_no")


@area.add("SELECT 0 AS out_of_order, count(*) AS lines FROM orders WHERE o_orderkey % 10 <> 0")
def line_order(spark, sf_dir):
    # A key must not be smaller than its neighbour's: compare line n with the last text before it.
    numbered = files.with_line_numbers(files.read_lines(spark, _order_lines(spark, sf_dir)))
    keyed = files.non_blank(numbered).select(
        "file", "line_no", F.element_at(F.split("value", " "), -1).cast("bigint").alias("key")
    )
    follower = keyed.select("file", (F.col("line_no") - 1).alias("line_no"), F.col("key").alias("next_key"))
    pairs = keyed.join(follower, ["file", "line_no"], "left")
    return pairs.agg(
        F.count_if(F.col("next_key") <= F.col("key")).alias("out_of_order"), F.count(F.lit(1)).alias("lines")
    )


@area.add("""
    SELECT 'order ' || o_orderkey AS _raw_content_, true AS numbered FROM orders WHERE o_orderkey % 10 <> 0
""")
def raw_lines(spark, sf_dir):
    numbered = files.with_line_numbers(files.read_lines(spark, _order_lines(spark, sf_dir)))
    return files.raw_documents(numbered).select("_raw_content_", F.col("id").rlike(r"\.txt:\d+$").alias("numbered"))


@area.add("""
    SELECT event_id, CASE WHEN event_id % 4 > 0 THEN event_id::VARCHAR ELSE 'file-line' END AS id FROM events
""")
def line_ids(spark, sf_dir):
    # Records carry their own id, of any type, or get one from file and line.
    own = F.when(F.col("event_id") % 4 > 0, F.col("event_id")).alias("id")
    text = events(spark, sf_dir).select(F.to_json(F.struct(own, F.col("event_id").alias("n"))).alias("line"))
    folder = write_lines(spark, text.repartition(3), "json-lines")
    numbered = files.with_line_numbers(files.read_lines(spark, folder))
    records = json_lines.accepted(json_lines.parse_json_lines(numbered))
    read = records.select(
        "file", "line_no", F.variant_get("record", "$.n", "bigint").alias("event_id"),
        F.try_variant_get("record", "$.id", "string").alias("id"),
    )
    made = files.with_line_ids(read)
    generated = F.col("id") == F.concat_ws("-", "file", "line_no")
    return made.select("event_id", F.when(generated, "file-line").otherwise(F.col("id")).alias("id"))


@area.add("SELECT 'tweet-' || conv_id || turn AS id, role FROM conversations")
def status_ids(spark, sf_dir):
    df = table(spark, sf_dir, "conversations").select(F.concat("conv_id", "turn").alias("n"), "role")
    return streams.with_status_id(df, "n").select("id", "role")


@area.add("""
    SELECT event_type, event_id, greatest(count(*) OVER (PARTITION BY event_type) - 1000, 0) AS shed
    FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 1000
""")
def shed_per_source(spark, sf_dir):
    df = events(spark, sf_dir)
    kept = streams.shed_load(df, "event_type", ["ts", "event_id"], slots=1000).select("event_type", "event_id")
    return kept.join(streams.shed_counts(df, "event_type", 1000), "event_type")


# --- delimited files ---------------------------------------------------------------------------

_BAD = "c_custkey % 11 = 0 OR c_custkey % 13 = 0 OR c_custkey % 17 = 0"


def _customer_files(spark, sf_dir) -> str:
    """Files with a header each; some lines are blank, too long, or end in empty cells."""
    good = F.concat_ws(",", F.col("c_name"), F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey"))
    line = (
        F.when(F.col("c_custkey") % 11 == 0, F.concat(good, F.lit(",extra")))
        .when(F.col("c_custkey") % 13 == 0, F.lit("   "))
        .when(F.col("c_custkey") % 17 == 0, F.concat("c_name", F.lit(","), "c_custkey", F.lit(",,")))
        .otherwise(F.concat(F.lit("  "), good))
    )
    placed = table(spark, sf_dir, "customer").repartition(4, "c_nationkey").select(line.alias("line"))
    return write_lines(spark, placed, "customers", header="name,id,segment,nation")


@area.add(f"""
    SELECT c_custkey::VARCHAR AS doc_id, c_custkey::VARCHAR AS id, c_name AS name, c_mktsegment AS segment,
      c_nationkey::VARCHAR AS nation
    FROM customer WHERE NOT ({_BAD})
""")
def csv_rows(spark, sf_dir):
    parsed = delimited.parse_delimited(spark, _customer_files(spark, sf_dir))
    rows = delimited.delimited_documents(parsed)
    return rows.select("doc_id", *(F.col("row")[c].alias(c) for c in ("id", "name", "segment", "nation")))


@area.add(f"SELECT c_custkey::VARCHAR AS doc_id, c_name AS name FROM customer WHERE NOT ({_BAD})")
def csv_known_header(spark, sf_dir):
    fields = ["name", "id", "segment", "nation"]
    parsed = delimited.parse_delimited(spark, _customer_files(spark, sf_dir), fields=fields)
    return delimited.delimited_documents(parsed).select("doc_id", F.col("row")["name"].alias("name"))


@area.add("""
    SELECT CASE WHEN c_custkey % 11 = 0 THEN c_name || ',' || c_custkey || ',' || c_mktsegment || ',' || c_nationkey || ',extra'
      ELSE c_name || ',' || c_custkey || ',,' END AS line
    FROM customer WHERE c_custkey % 11 = 0 OR (c_custkey % 17 = 0 AND c_custkey % 13 <> 0)
""")
def csv_skipped(spark, sf_dir):
    parsed = delimited.parse_delimited(spark, _customer_files(spark, sf_dir))
    return delimited.delimited_rejects(parsed).select("line")


@area.add(f"""
    SELECT count(*) FILTER (NOT ({_BAD})) AS num_records,
      count(*) FILTER (c_custkey % 11 = 0 OR (c_custkey % 17 = 0 AND c_custkey % 13 <> 0)) AS num_skipped
    FROM customer
""")
def csv_file_counts(spark, sf_dir):
    counts = delimited.delimited_counts(delimited.parse_delimited(spark, _customer_files(spark, sf_dir)))
    return counts.agg(F.sum("num_records").alias("num_records"), F.sum("num_skipped").alias("num_skipped"))


@area.add("SELECT s_suppkey::VARCHAR AS doc_id, s_name AS name FROM supplier")
def csv_without_header(spark, sf_dir):
    text = table(spark, sf_dir, "supplier").select(F.concat_ws("|", "s_suppkey", "s_name").alias("line"))
    folder = write_lines(spark, text, "suppliers")
    parsed = delimited.parse_delimited(spark, folder, delimiter="|", header=False, fields=["key", "name"])
    return delimited.delimited_documents(parsed).select("doc_id", F.col("row")["name"].alias("name"))


@area.add("SELECT p_partkey::VARCHAR AS id, p_name || ', ' || p_type AS label FROM part")
def csv_quoted(spark, sf_dir):
    label = F.concat(F.lit('"'), "p_name", F.lit(", "), "p_type", F.lit('"'))
    text = table(spark, sf_dir, "part").select(F.concat_ws(",", "p_partkey", label).alias("line"))
    folder = write_lines(spark, text, "parts", header="id,label")
    return delimited.read_quoted_csv(spark, folder, ["id", "label"]).drop("_corrupt")


# --- sinks -----------------------------------------------------------------------------------


def _versions(spark, sf_dir):
    """Events as versions of one document per user and collection."""
    named = C.routed(C.time_frame_collection(events(spark, sf_dir), "ts", TWELVE_HOURS))
    return named.select("collection", F.col("user_id").cast("string").alias("id"), "event_id", "ts", "event_type")


_LATEST = f"""
    SELECT collection, id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type
    FROM (SELECT {COLLECTION_SQL} AS collection, user_id::VARCHAR AS id, * FROM events) GROUP BY 1, 2
"""


@area.add(_LATEST)
def upsert_latest(spark, sf_dir):
    view = upsert.current_view(_versions(spark, sf_dir), ["collection", "id"], ["ts", "event_id"])
    return view.drop("ts")


@area.add(_LATEST)
def upsert_compacted(spark, sf_dir):
    target = workspace(configure(spark), "compacted")
    upsert.compact(_versions(spark, sf_dir), ["collection", "id"], ["ts", "event_id"], target)
    return spark.read.parquet(target).select("collection", "id", "event_id", "event_type")


@area.add(_LATEST)
def log_replay(spark, sf_dir):
    # Two batches, the first one delivered twice: the current view shows every version once.
    log = document_log.DocumentLog(configure(spark), workspace(spark, "log"))
    versions = _versions(spark, sf_dir)
    for batch_id, remainder in ((0, 0), (1, 1), (0, 0)):
        log.append(versions.filter(F.col("event_id") % 2 == remainder), batch_id)
    return log.current(order=("ts", "event_id")).select("collection", "id", "event_id", "event_type")


@area.add(f"""
    WITH named AS (SELECT {COLLECTION_SQL} AS collection, user_id FROM events),
    alias AS (SELECT DISTINCT collection FROM named ORDER BY 1 DESC LIMIT 5)
    SELECT collection, count(DISTINCT user_id) AS docs FROM named WHERE collection IN (SELECT collection FROM alias) GROUP BY 1
""")
def log_newest(spark, sf_dir):
    log = document_log.DocumentLog(configure(spark), workspace(spark, "log"))
    log.append(_versions(spark, sf_dir), 0)
    return C.collection_registry(log.newest(5, order=("ts", "event_id")))


def _versions_in_order(spark, sf_dir, log, compacted_after: tuple[int, ...], buckets: int = 1):
    """Four batches of versions, each in the order of its events; every other batch calls a field by another type."""
    for batch_id in range(4):
        part = _versions(spark, sf_dir).filter(F.col("event_id") % 4 == batch_id).withColumn("rank", F.col("event_id").cast("int"))
        if batch_id % 2:
            part = part.withColumn("rank", F.col("event_id").cast("string")).drop("ts")
        log.append(part.orderBy("event_id"), batch_id)
        if batch_id in compacted_after:
            log.compact(buckets=buckets)


_LAST_WRITTEN = f"""
    SELECT collection, id, event_id, event_id::VARCHAR AS rank FROM (
      SELECT collection, id, event_id FROM (SELECT {COLLECTION_SQL} AS collection, user_id::VARCHAR AS id, * FROM events)
      QUALIFY row_number() OVER (PARTITION BY collection, id ORDER BY event_id % 4 DESC, event_id DESC) = 1)
"""


@area.add(_LAST_WRITTEN)
def log_last_write_wins(spark, sf_dir):
    # The default order: the later batch wins, and within a batch the later document. Two generations lie between.
    log = document_log.DocumentLog(configure(spark), workspace(spark, "log"))
    _versions_in_order(spark, sf_dir, log, compacted_after=(0, 2))
    return log.current().select("collection", "id", "event_id", F.col("rank").cast("string").alias("rank"))


@area.add(f"SELECT * FROM ({_LAST_WRITTEN}) WHERE id IN (SELECT user_id::VARCHAR FROM events WHERE event_id < 5)")
def log_lookup(spark, sf_dir):
    # The current documents of five users, fetched from their buckets.
    log = document_log.DocumentLog(configure(spark), workspace(spark, "log"))
    _versions_in_order(spark, sf_dir, log, compacted_after=(1,), buckets=3)
    users = [str(r.user_id) for r in events(spark, sf_dir).filter("event_id < 5").select("user_id").distinct().collect()]
    return log.lookup(users).select("collection", "id", "event_id", F.col("rank").cast("string").alias("rank"))


_IDS = murmur3_sql("events", "event_id::VARCHAR", "event_id, ts")


@area.add(f"SELECT {COLLECTION_SQL} AS collection, {_shard('h', 3)} AS shard, count(*) AS docs FROM ({_IDS}) GROUP BY 1, 2")
def partitioned_write(spark, sf_dir):
    named = C.routed(C.time_frame_collection(events(spark, sf_dir), "ts", TWELVE_HOURS))
    target = workspace(spark, "documents")
    document_log.write_documents(with_shard(named, F.col("event_id"), 3, 2), target)
    return shard_report(spark.read.parquet(target), ("collection", "shard"))


@area.add("""
    WITH numbered AS (SELECT event_type, (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 100 AS batch_no FROM events)
    SELECT event_type, batch_no, count(*) AS docs FROM numbered GROUP BY 1, 2
""")
def batch_plan(spark, sf_dir):
    planned = batches.batch_plan(events(spark, sf_dir).select("event_type", "event_id"), ["event_type"], ["event_id"])
    return batches.batch_sizes(planned, ["event_type"])


@area.add("SELECT event_type, count(*) AS n, count(*) AS numbers, 1 AS low, count(*) AS high FROM events GROUP BY 1")
def row_numbers(spark, sf_dir):
    numbered = number_rows(events(spark, sf_dir).select("event_type", "event_id"), ["event_type"], ["event_id"])
    return numbered.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("row_no").alias("numbers"),
        F.min("row_no").alias("low"), F.max("row_no").alias("high"),
    )


def _to_send(spark, sf_dir):
    text = F.to_json(F.struct("event_id", "user_id"))
    return events(spark, sf_dir).select(F.col("event_type").alias("collection"), text.alias("json"))


def _receipts(spark, documents, deliver, batch_size=delivery.BATCH_SIZE):
    """Send once and keep the receipts: reading them again must not send again."""
    target = workspace(spark, "receipts")
    delivery.send_batches(documents, deliver, batch_size).write.parquet(target)
    return spark.read.parquet(target)


@area.add("""
    SELECT event_type AS collection, count(*) AS docs, count(*) AS arrived, sum(event_id)::BIGINT AS ids, sum(user_id)::BIGINT AS users,
           true AS each_retried, true AS bounded, true AS timed
    FROM events GROUP BY 1
""")
def delivery_receipts(spark, sf_dir):
    # The connection is lost once per batch; receipts are held against the documents that arrived.
    box = Receiver(workspace(configure(spark), "received"), flaky=True)
    receipts = _receipts(spark, _to_send(spark, sf_dir), delivery.Retrying(box, wait=0.0))
    sent = receipts.groupBy("collection").agg(
        F.sum("docs").alias("docs"), (F.min("retried") == 1).alias("each_retried"),
        (F.max("docs") <= delivery.BATCH_SIZE).alias("bounded"), (F.min("millis") > 0).alias("timed"),
    )
    arrived = box.arrived(spark, "event_id bigint, user_id bigint").groupBy("collection").agg(
        F.count(F.lit(1)).alias("arrived"), F.sum("event_id").alias("ids"), F.sum("user_id").alias("users")
    )
    return sent.join(arrived, "collection")


@area.add("""
    SELECT event_id, user_id, event_type AS collection, false AS at_failed, true AS bounded FROM events
""")
def delivery_failover(spark, sf_dir):
    # Endpoint a is down: every document arrives at another one, once, in a batch of its collection.
    box = Receiver(workspace(configure(spark), "received"), down=("a",))
    receipts = _receipts(spark, _to_send(spark, sf_dir), delivery.Failover(box, ["a", "b", "c"]), 20)
    told = delivery.delivery_report(receipts).select("endpoint", (F.col("docs") <= 20 * F.col("requests")).alias("bounded"))
    arrived = box.arrived(spark, "event_id bigint, user_id bigint").join(told, "endpoint", "left")
    return arrived.select("event_id", "user_id", "collection", (F.col("endpoint") == "a").alias("at_failed"), "bounded")


@area.add("""
    SELECT event_id, user_id, event_type AS collection, 1 AS in_request, count(*) OVER () AS requests, count(*) OVER () AS receipts FROM events
""")
def delivery_one_by_one(spark, sf_dir):
    # Every document has a request of its own.
    box = Receiver(workspace(configure(spark), "received"))
    receipts = _receipts(spark, _to_send(spark, sf_dir), delivery.Retrying(box), batch_size=1)
    arrived = box.arrived(spark, "event_id bigint, user_id bigint")
    requests = arrived.agg(F.countDistinct("request")).first()[0]
    return arrived.select(
        "event_id", "user_id", "collection", F.col("size").alias("in_request"),
        F.lit(requests).alias("requests"), F.lit(receipts.count()).alias("receipts"),
    )


# --- metrics -----------------------------------------------------------------------------------


@area.add(f"SELECT {COLLECTION_SQL} AS collection, count(*) AS docs FROM events GROUP BY 1")
def docs_per_collection(spark, sf_dir):
    named = C.routed(C.time_frame_collection(events(spark, sf_dir), "ts", TWELVE_HOURS))
    return C.collection_registry(named)


@area.add("""
    SELECT 'received' AS metric, count(*) AS n FROM events UNION ALL
    SELECT 'lines_read', count(*) FROM events WHERE event_id % 10 <> 3 UNION ALL
    SELECT 'lines_output', count(*) FROM events WHERE event_id % 10 > 4 UNION ALL
    SELECT 'rejected', count(*) FROM events WHERE event_id % 10 IN (0, 1, 4)
""")
def ingest_metrics(spark, sf_dir):
    # The numbers are a by-product of writing the documents; nothing is counted in a second pass.
    from registry.json_records import _broken

    received, read, parsed = Observation("received"), Observation("read"), Observation("parsed")
    lines_in = counted(_broken(spark, sf_dir), received)
    non_blank = counted(files.non_blank(lines_in), read)
    records = counted(
        json_lines.parse_json_lines(non_blank), parsed,
        good=F.col("error").isNull(), bad=F.col("error").isNotNull(),
    )
    records.select("event_id", "error").write.parquet(workspace(spark, "records"))
    values = [
        ("received", received.get["rows"]), ("lines_read", read.get["rows"]),
        ("lines_output", parsed.get["good"]), ("rejected", parsed.get["bad"]),
    ]
    return spark.createDataFrame(values, "metric string, n bigint")


_MILLIS = "((event_id * 7919) % 10007 + (event_id % 13) * (event_id % 97) * 100) / 16.0"


@area.add(f"""
    SELECT endpoint, quantile, any_value(n) AS n,
      CASE WHEN min(millis) < 1e-6 THEN -2147483648 ELSE ceil(ln(min(millis)) / ln(1.01 / 0.99)) END::INTEGER AS bucket, true AS near
    FROM (
      SELECT endpoint, millis, row_number() OVER (PARTITION BY endpoint ORDER BY millis) AS place, count(*) OVER (PARTITION BY endpoint) AS n
      FROM (SELECT event_type AS endpoint, ({_MILLIS})::DOUBLE AS millis FROM events)
    ), (SELECT unnest([0.5, 0.95, 0.99]::DOUBLE[]) AS quantile)
    WHERE place >= quantile * n GROUP BY endpoint, quantile
""")
def latency_quantiles(spark, sf_dir):
    # A latency for each event, sketched per endpoint and minute in four batches, one of them sent twice, and merged on reading.
    path = workspace(configure(spark), "latencies")
    timed = events(spark, sf_dir).select(F.col("event_type").alias("endpoint"), "event_id", "ts", F.expr(_MILLIS).cast("double").alias("millis"))
    for batch_id in (0, 1, 2, 1, 3):
        latency.append_sketches(latency.latency_sketches(timed.filter(F.col("event_id") % 4 == batch_id), ["endpoint"], "ts"), path, batch_id)
    merged = latency.merged_quantiles(latency.stored_sketches(spark, path), ["endpoint"], [0.5, 0.95, 0.99])
    exact = timed.groupBy("endpoint").agg(*(F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY millis)").alias(f"q{q}") for q in (0.5, 0.95, 0.99)))
    told = exact.select("endpoint", F.inline(F.array(*(F.struct(F.lit(q).alias("quantile"), F.col(f"`q{q}`").alias("exact")) for q in (0.5, 0.95, 0.99)))))
    near = F.abs(F.col("value") - F.col("exact")) <= F.col("exact") * (latency.ERROR + 1e-9)
    return merged.join(told, ["endpoint", "quantile"]).select("endpoint", "quantile", "n", "bucket", near.alias("near"))


# --- jobs --------------------------------------------------------------------------------------


def event_lines(spark, sf_dir):
    """Events as JSON lines with an epoch-millisecond ``ts`` and nested ``props``."""
    props = F.from_json("props", "k bigint").alias("props")
    record = F.struct(F.unix_millis("ts").alias("ts"), "user_id", "event_type", props)
    return events(spark, sf_dir).select(F.col("event_id").cast("string").alias("id"), F.to_json(record).alias("line"))


def ingest_events(spark, sf_dir, shards: int = 3, tasks: int = 2) -> jobs.Ingest:
    return jobs.event_log(event_lines(spark, sf_dir), "id", "line", TWELVE_HOURS, shards=shards, tasks=tasks)


_EVENT_JSON = """'{"ts":' || (epoch_us(ts) // 1000) || ',"user_id":' || user_id || ',"event_type":"' || event_type
    || '","props.k":' || (props::JSON->>'k') || '}'"""


@area.add(f"""
    SELECT {COLLECTION_SQL} AS collection, {_shard('h', 3)} AS shard,
      {_shard('h', 3)} + 3 * (((h % 4294967296 + 4294967296) % 4294967296 // 256 + (epoch_us(ts) // 1000) % 2) % 2) AS slot,
      event_id::VARCHAR AS id, epoch_us(ts) // 1000 AS ts, {_EVENT_JSON} AS json
    FROM ({murmur3_sql('events', 'event_id::VARCHAR', 'event_id, ts, user_id, event_type, props')})
""")
def event_collections(spark, sf_dir):
    return ingest_events(spark, sf_dir).documents


@area.add(f"SELECT {COLLECTION_SQL} AS collection, {_shard('h', 3)} AS shard, count(*) AS docs FROM ({_IDS}) GROUP BY 1, 2")
def event_collection_counts(spark, sf_dir):
    return shard_report(ingest_events(spark, sf_dir).documents, ("collection", "shard"))


@area.add(f"SELECT {COLLECTION_SQL} AS collection, {_shard('h', 3)} AS shard, count(*) AS docs FROM ({_IDS}) GROUP BY 1, 2")
def event_ingest_written(spark, sf_dir):
    # The whole job: parse, flatten, assign, route, write by collection, and count what is stored.
    target = workspace(configure(spark), "events")
    document_log.write_documents(ingest_events(spark, sf_dir).documents, target)
    return shard_report(spark.read.parquet(target), ("collection", "shard"))


@area.add("SELECT event_id::VARCHAR AS id, 'no usable timestamp' AS error FROM events WHERE event_id % 9 = 0")
def event_rejects(spark, sf_dir):
    line = F.when(F.col("id").cast("bigint") % 9 == 0, F.lit('{"ts":"soon"}')).otherwise(F.col("line"))
    broken = event_lines(spark, sf_dir).withColumn("line", line)
    return jobs.event_log(broken, "id", "line", TWELVE_HOURS).rejects.drop("text")


_OWNERS = "CASE WHEN h < -715827882 THEN 's0' WHEN h < 715827883 THEN 's1' ELSE 's2' END"


@area.add(f"""
    SELECT c_custkey::VARCHAR AS id, 'customers' AS collection, {_OWNERS} AS owner, c_name AS name
    FROM ({murmur3_sql('customer', 'c_custkey::VARCHAR', 'c_custkey, c_name')}) WHERE NOT ({_BAD})
""")
def csv_documents(spark, sf_dir):
    layout = equal_ranges(["s0", "s1", "s2"])
    documents = jobs.csv_folder(spark, _customer_files(spark, sf_dir), "customers", layout).documents
    return documents.select("id", "collection", "owner", F.col("fields")["name"].alias("name"))




@area.add(f"""
    SELECT id, 'statuses' AS collection, {_OWNERS} AS owner, lang AS lang_s, source AS source_s, n_chars AS n_chars_l
    FROM ({murmur3_sql("(SELECT 'tweet-' || doc_id AS id, * FROM documents WHERE doc_id % 2 = 0)", 'id', 'id, lang, source, n_chars')})
""")
def status_documents(spark, sf_dir):
    layout = equal_ranges(["s0", "s1", "s2"])
    df = table(spark, sf_dir, "documents")
    documents = jobs.status_stream(df, "doc_id", "text", "statuses", layout, one_in=2).documents
    return documents.select("id", "collection", "owner", "lang_s", "source_s", "n_chars_l")


@area.add(r"""
    SELECT 'tweet-' || doc_id AS id, CASE WHEN contains(text, ' ') THEN text END AS text_t FROM documents
    WHERE regexp_matches(text, '(?i)(?:^|[^\pL\pN\pM_])(?:spark|hadoop|license)(?:$|[^\pL\pN\pM_])')
""")
def tracked_statuses(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", "text")
    layout = [ShardRange("only", INT_MIN, INT_MAX)]
    keywords = ["spark", "hadoop", "license"]
    return jobs.status_stream(df, "doc_id", "text", "statuses", layout, keywords).documents.select("id", "text_t")


@area.add(" UNION ALL ".join(
    f"SELECT o_orderkey::VARCHAR AS id, '{name}' AS path, {value} AS value FROM orders" for name, value in _FULL_NAMES.items()
))
def field_path_documents(spark, sf_dir):
    mappings = ("color_s:/priority", "$FQN:/**")
    documents = jobs.json_paths_job(order_records(spark, sf_dir), "o_orderkey", "record", "orders", mappings).documents
    return jobs.flat_fields(documents).select("id", "path", as_text(F.col("value")).alias("value"))


def web_envelopes(spark, sf_dir):
    """One envelope for each event's web server line, also for lines without a request or a size."""
    text = events(spark, sf_dir).select("event_type", "event_id", F.expr(lines.line_of(lines.WEB_COMMON)).alias("line"))
    numbered = files.with_line_numbers(files.read_lines(spark, write_numbered(spark, text, "event_type", "event_id", "access")))
    return jobs.log_envelopes(numbered, "COMMONAPACHELOG").documents


_ENVELOPE_FIELDS = " || ',' || ".join(
    f"""'{{"name":"{name}","value":"' || coalesce({value}, '') || '"}}'""" for name, value in lines.fields_of(lines.WEB_COMMON).items()
)


@area.add(f"""
    SELECT event_type || '-' || row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS id, '[' || {_ENVELOPE_FIELDS} || ']' AS fields
    FROM events
""")
def log_envelopes(spark, sf_dir):
    # Files are named by their event type; the number of a line follows from its event.
    line = F.regexp_replace("id", r"^.*event_type=([^/]+)/.*-(\d+)$", "$1-$2")
    return web_envelopes(spark, sf_dir).select(line.alias("id"), F.to_json("fields").alias("fields"))


@area.add(_BLOCKS_SQL)
def block_documents(spark, sf_dir):
    documents = jobs.nested_blocks(order_records(spark, sf_dir), "o_orderkey", "record", "orders").documents
    return documents.withColumn("fields", F.to_json("fields")).drop("collection")


@area.add("""
    SELECT o_orderkey::VARCHAR AS root_id, 5 AS children FROM orders
""")
def block_children(spark, sf_dir):
    # A parent with its direct children, fetched back from the stored block.
    documents = jobs.nested_blocks(order_records(spark, sf_dir), "o_orderkey", "record", "orders").documents
    parents = documents.filter("depth = 0").select("root_id")
    children = documents.filter("depth = 1").select("parent_id", "doc_id")
    fetched = blocks.fetch_blocks(parents, children, "root_id", "parent_id", ["doc_id"], limit=100)
    return fetched.select("root_id", F.size("children").alias("children"))


# --- streams -----------------------------------------------------------------------------------


@area.add(f"SELECT {COLLECTION_SQL} AS collection, {_shard('h', 3)} AS shard, count(*) AS docs FROM ({_IDS}) GROUP BY 1, 2")
def stream_event_log(spark, sf_dir):
    # The same job on arriving files: write JSON lines, ingest them two files at a time.
    folder = write_lines(spark, event_lines(spark, sf_dir).select(F.to_json(F.struct("id", F.col("line"))).alias("l")).repartition(5), "arriving")
    arriving = streams.arriving_lines(spark, folder, max_files=2, glob="*.txt")
    record = F.from_json("value", "id string, line string")
    documents = jobs.event_log(arriving.select(record.alias("r")).select("r.*"), "id", "line", TWELVE_HOURS, shards=3).documents
    log = document_log.DocumentLog(spark, workspace(spark, "stream-log"))
    document_log.start_ingest(documents, log, workspace(spark, "stream-state")).awaitTermination()
    return shard_report(log.documents(), ("collection", "shard"))


_BROKEN_LINE = "CASE event_id % 9 WHEN 0 THEN '{\"ts\":\"soon\"}' WHEN 4 THEN '{\"ts\":' END"


@area.add(f"""
    SELECT event_id::VARCHAR AS id, event_id % 9 NOT IN (0, 4) AS stored,
      CASE WHEN event_id % 9 NOT IN (0, 4) THEN {COLLECTION_SQL} END AS collection,
      CASE WHEN event_id % 9 NOT IN (0, 4) THEN {_shard('h', 3)} END AS shard,
      CASE WHEN event_id % 9 NOT IN (0, 4) THEN {_EVENT_JSON} END AS json,
      {_BROKEN_LINE} AS text, CASE event_id % 9 WHEN 0 THEN 'no usable timestamp' WHEN 4 THEN 'malformed JSON' END AS error
    FROM ({murmur3_sql('events', 'event_id::VARCHAR', 'event_id, ts, user_id, event_type, props')})
""")
def stream_event_outcomes(spark, sf_dir):
    # Good and bad lines of a stream from one parse and one write: documents and rejects are both read from the log.
    kind = F.col("id").cast("bigint") % 9
    line = F.when(kind == 0, F.lit('{"ts":"soon"}')).when(kind == 4, F.lit('{"ts":')).otherwise(F.col("line"))
    text = event_lines(spark, sf_dir).withColumn("line", line).select(F.to_json(F.struct("id", "line")))
    folder = write_lines(spark, text.repartition(4), "arriving")
    arriving = streams.arriving_lines(spark, folder, max_files=2, glob="*.txt")
    record = F.from_json("value", "id string, line string")
    job = jobs.event_log(arriving.select(record.alias("r")).select("r.*"), "id", "line", TWELVE_HOURS, shards=3)
    log = document_log.DocumentLog(spark, workspace(spark, "outcome-log"), reject_fields=jobs.REJECT_FIELDS)
    document_log.start_ingest(job.outcomes, log, workspace(spark, "stream-state")).awaitTermination()
    log.compact()
    nothing = F.lit(None).cast("string")
    stored = log.current().select("id", F.lit(True).alias("stored"), "collection", "shard", "json", nothing.alias("text"), nothing.alias("error"))
    rejected = log.rejects().select(
        "id", F.lit(False).alias("stored"), nothing.alias("collection"), F.lit(None).cast("int").alias("shard"), nothing.alias("json"), "text", "error"
    )
    return stored.unionByName(rejected)


@area.add(_LATEST)
def stream_upserts(spark, sf_dir):
    folder = workspace(configure(spark), "versions")
    source = _versions(spark, sf_dir)
    source.repartition(4, "event_id").write.parquet(folder)
    arriving = streams.arriving_rows(spark, folder, source.schema, max_files=1)
    log = document_log.DocumentLog(spark, workspace(spark, "stream-log"))
    document_log.start_ingest(arriving, log, workspace(spark, "stream-state")).awaitTermination()
    return log.current(order=("ts", "event_id")).select("collection", "id", "event_id", "event_type")


