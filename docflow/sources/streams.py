"""Streaming inputs. The same operators run on them as on batch DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.operators.ranking import first_per_group

# Fixed value: id prefix of status records.
STATUS_PREFIX = "tweet-"


def arriving_lines(spark: SparkSession, folder: str, max_files: int | None = None, glob: str | None = None) -> DataFrame:
    """Lines of files as they arrive in a folder, oldest file first: ``value, file``.

    ``max_files`` bounds how much one micro-batch may hold in flight; None (or a number below
    one) means no bound. Bytes appended to a file already read are not seen: write new files.
    """
    return _arriving(spark, max_files, glob).text(folder).select("value", F.col("_metadata.file_path").alias("file"))


def arriving_rows(
    spark: SparkSession, folder: str, schema: T.StructType, max_files: int | None = None, glob: str | None = None
) -> DataFrame:
    """Parquet rows of files as they arrive in a folder."""
    return _arriving(spark, max_files, glob).schema(schema).parquet(folder)


def _arriving(spark: SparkSession, max_files: int | None, glob: str | None):
    reader = spark.readStream.option("latestFirst", "false")
    if max_files is not None and max_files > 0:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader if glob is None else reader.option("pathGlobFilter", glob)


def with_status_id(df: DataFrame, id_col: str, prefix: str = STATUS_PREFIX) -> DataFrame:
    """Set ``id`` to the prefixed status number."""
    return df.withColumn("id", F.concat(F.lit(prefix), F.col(id_col).cast("string")))


def shed_load(df: DataFrame, source: str, arrival: list[str | Column], slots: int) -> DataFrame:
    """Keep the first ``slots`` records of each source by arrival and drop the rest.

    For one micro-batch (inside ``foreachBatch``) or a batch DataFrame. Blocking instead of
    shedding needs no operator: Spark pulls its input.
    """
    return first_per_group(df, [source], arrival, slots)


def shed_counts(df: DataFrame, source: str, slots: int) -> DataFrame:
    """How many records ``shed_load`` drops of each source: ``source, shed``."""
    return df.groupBy(source).agg(F.greatest(F.count(F.lit(1)) - slots, F.lit(0)).alias("shed"))
