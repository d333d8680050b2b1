"""Assigning documents to collections, and reading through a rolling alias."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.timeframes import TimeFrame, as_timestamp

NO_TIMESTAMP = "no timestamp"
BAD_TIMESTAMP = "unreadable timestamp"


def fixed_collection(df: DataFrame, collection: str | Column | None, default: str) -> DataFrame:
    """One collection for all documents, or ``default`` where none is given."""
    chosen = collection if isinstance(collection, Column) else F.lit(collection).cast("string")
    return df.withColumn("collection", F.coalesce(chosen, F.lit(default)))


def time_frame_collection(
    df: DataFrame, ts_col: str, frame: TimeFrame, formats: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``collection`` from the document's time, and ``error`` where it has none."""
    ts = as_timestamp(F.col(ts_col), df.schema[ts_col].dataType, formats)
    named = df.withColumn("_ts", ts).withColumn("collection", frame.collection(F.col("_ts")))
    error = F.when(F.col(ts_col).isNull(), NO_TIMESTAMP).when(F.col("_ts").isNull(), BAD_TIMESTAMP)
    return named.withColumn("error", error).drop("_ts")


def routed(assigned: DataFrame) -> DataFrame:
    """Documents that have a collection."""
    return assigned.filter(F.col("error").isNull()).drop("error")


def unroutable(assigned: DataFrame) -> DataFrame:
    """Documents whose time is missing or unreadable, with the reason."""
    return assigned.filter(F.col("error").isNotNull()).drop("collection")


def fail_on_unroutable(assigned: DataFrame) -> DataFrame:
    """Strict mode: the job fails on the first document without a usable time."""
    checked = F.when(F.col("error").isNotNull(), F.raise_error(F.col("error"))).otherwise(F.col("collection"))
    return assigned.withColumn("collection", checked.cast("string")).drop("error")


def collection_registry(df: DataFrame) -> DataFrame:
    """Every collection once, with its number of documents; counted before the shuffle."""
    return df.groupBy("collection").agg(F.count(F.lit(1)).alias("docs"))


def newest_collections(collections: DataFrame, n: int) -> DataFrame:
    """Members of a rolling alias: the ``n`` greatest names, or all for ``n`` below one."""
    names = collections.select("collection").distinct()
    return names if n <= 0 else names.orderBy(F.desc("collection")).limit(n)


def through_alias(df: DataFrame, n: int, collections: DataFrame | None = None) -> DataFrame:
    """Documents of the ``n`` newest collections.

    Without ``collections`` the names come from the documents themselves, and Spark broadcasts
    them if they are few. With ``collections``, a small table that lists them (the registry of a
    sink), the ``n`` names are looked up at once and become a filter, so that of documents stored
    by collection only the files of those collections are opened.
    """
    if n <= 0:
        return df
    if collections is None:
        return df.join(newest_collections(df, n), "collection", "left_semi")
    names = [row.collection for row in newest_collections(collections, n).collect()]
    return df.filter(F.col("collection").isin(names))
