"""The six ingest jobs. Each returns its documents and, where records can be bad, its rejects.

All of them work on batch and on streaming input. Documents and rejects are separate queries over
the same input. Where both are wanted, ``event_log`` gives its ``outcomes`` for one write to a document log,
which returns either side, and ``json_lines.parsed_once`` does the same for parsed lines.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions.grok import Grok
from docflow.functions.timeframes import TimeFrame
from docflow.functions.variants import as_object
from docflow.operators import blocks, flatten, json_paths, mappers
from docflow.operators.collections import fixed_collection
from docflow.operators.filters import sample, track_keywords
from docflow.operators.logs import grok_extract, grok_unmatched
from docflow.operators.routing import ShardRange, with_owner, with_shard
from docflow.sources import delimited
from docflow.sources.files import raw_documents
from docflow.sources.json_lines import parse_json_lines, rejected
from docflow.sources.streams import with_status_id
from docflow.streaming.document_log import REJECTED


class Ingest(NamedTuple):
    documents: DataFrame
    rejects: DataFrame | None
    #: Documents and rejects in one DataFrame, from one parse: append it to a log.
    outcomes: DataFrame | None = None


#: Columns of the outcomes that only rejects use.
REJECT_FIELDS = ("text", "error")


def record_time(text: Column) -> Column:
    """The time of a record: a number is epoch milliseconds, anything else ISO text."""
    digits = text.rlike(r"^-?\d+$")
    return F.when(digits, F.timestamp_millis(text.try_cast("bigint"))).otherwise(text.try_cast("timestamp"))


def event_log(
    lines: DataFrame, id_col: str, text: str, frame: TimeFrame, ts_field: str = "ts", shards: int = 1, tasks: int = 1
) -> Ingest:
    """JSON event lines to one collection per time frame, routed by the hash of the id.

    Documents are ``collection, shard, slot, id, ts, json``; the event time doubles as the tie
    that spreads the events of one hot id over the writers of its shard. ``outcomes`` holds those columns
    and ``text, error``: a line without a document has the collection ``REJECTED`` and the id it came with.
    """
    named = lines.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    flat = flatten.flatten_json(named, "text", pick=(ts_field,))
    ts = record_time(F.get("picked", F.lit(0)))
    found = flatten.flat_documents(flat, "id").withColumn("ts", ts).filter(F.col("ts").isNotNull())
    assigned = found.withColumn("collection", frame.collection(F.col("ts")))
    placed = with_shard(assigned, "id", shards, tasks, F.unix_millis("ts"))
    documents = placed.select(
        "collection", "shard", "slot", "id", F.unix_millis("ts").alias("ts"), F.col("flat").alias("json")
    )
    error = F.coalesce("error", F.when(ts.isNull(), F.lit("no usable timestamp")))
    rejects = flat.select("id", "text", error.alias("error")).filter(F.col("error").isNotNull())
    judged = flat.withColumn("ts", ts).withColumn("error", error)
    good = F.col("error").isNull()
    given = F.col("id").cast("string")
    keyed = judged.withColumn("id", F.when(good, F.coalesce("own_id", given)).otherwise(given))
    told = with_shard(keyed, "id", shards, tasks, F.unix_millis("ts"))
    outcomes = told.select(
        F.when(good, frame.collection(F.col("ts"))).otherwise(REJECTED).alias("collection"),
        F.when(good, F.col("shard")).alias("shard"),
        F.when(good, F.col("slot")).alias("slot"),
        "id",
        F.when(good, F.unix_millis("ts")).alias("ts"),
        F.when(good, F.col("flat")).alias("json"),
        F.when(~good, F.col("text")).alias("text"),
        "error",
    )
    return Ingest(documents, rejects, outcomes)


def csv_folder(
    spark: SparkSession,
    path: str,
    collection: str,
    layout: list[ShardRange],
    glob: str | None = None,
    **csv_options,
) -> Ingest:
    """Delimited files to documents of one collection, placed by the collection's shard layout."""
    parsed = delimited.parse_delimited(spark, path, glob=glob, **csv_options)
    rows = mappers.map_fields(delimited.delimited_documents(parsed), "doc_id", "row")
    assigned = fixed_collection(rows, collection, collection)
    return Ingest(with_owner(assigned, "id", layout), delimited.delimited_rejects(parsed))


def status_stream(
    statuses: DataFrame,
    id_col: str,
    text: str,
    collection: str,
    layout: list[ShardRange],
    keywords: list[str] | None = None,
    one_in: int = 1,
    overrides: dict[str, str] | None = None,
) -> Ingest:
    """Status records to typed documents; keywords are tracked if given, else one in n is kept."""
    if keywords:
        chosen = track_keywords(statuses, text, keywords)
    else:
        chosen = sample(statuses, id_col, 1, one_in)
    named = with_status_id(chosen, id_col)
    documents = mappers.dynamic_fields(named.drop(id_col), "id", overrides)
    return Ingest(with_owner(fixed_collection(documents, collection, collection), "id", layout), None)


def json_paths_job(
    lines: DataFrame,
    id_col: str,
    text: str,
    collection: str,
    mappings: tuple[str, ...] = json_paths.ALL_FIELDS,
    split: str = "/",
) -> Ingest:
    """JSON lines to documents made of the mapped paths, serialised one by one."""
    parsed = parse_json_lines(lines.select(F.col(id_col).cast("string").alias("id"), F.col(text).alias("value")))
    good = parsed.filter(F.col("error").isNull()).select("id", "record")
    mapped = json_paths.map_paths(good, "record", mappings, split)
    assigned = fixed_collection(mapped, collection, collection)
    return Ingest(assigned.select("collection", "id", "part_no", F.to_json("fields").alias("json")), rejected(parsed))


def log_envelopes(numbered: DataFrame, pattern: Grok | str | None = None) -> Ingest:
    """Numbered log lines to envelopes: the pattern's fields, or the raw line without a pattern."""
    if pattern is None:
        return Ingest(mappers.envelopes(raw_documents(numbered), "id", ["_raw_content_"]), None)
    known = set(numbered.columns)
    parsed = grok_extract(numbered, "value", pattern)
    named = parsed.withColumn("id", F.concat_ws("-", "file", F.col("line_no").cast("string")))
    fields = [c for c in parsed.columns if c not in known]
    return Ingest(mappers.envelopes(named, "id", fields), grok_unmatched(numbered, "value", pattern))


def nested_blocks(lines: DataFrame, id_col: str, text: str, collection: str) -> Ingest:
    """JSON lines to parent/child blocks of one collection."""
    parsed = blocks.parse_blocks(lines, id_col, text)
    documents = fixed_collection(blocks.block_documents(parsed), collection, collection)
    return Ingest(documents, blocks.block_rejects(parsed))


def flat_fields(documents: DataFrame) -> DataFrame:
    """Long form of the ``json`` of ingested documents: ``collection, id, path, value``."""
    fields = as_object(F.parse_json("json"))
    return documents.select("collection", "id", F.explode(fields).alias("path", "value"))
