"""Ranking within groups that may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, keys: list[str], order: list[str | Column], n: int, salts: int | None = None) -> DataFrame:
    """The first ``n`` rows of each group in ``order``, exactly.

    Ranking and filtering this way lets Spark keep only the first ``n`` rows of a group in each
    task before the shuffle, so a hot group arrives already cut down (up to the session's
    ``spark.sql.optimizer.windowGroupLimitThreshold``). With ``salts`` groups are ranked twice, first
    in so many parts made of input partitions, and no task sees more than ``salts * n`` rows of
    one group at the end. Which part a row falls into does not affect the result.
    """
    if salts:
        salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        df = _first(salted, [*keys, "_salt"], order, n).drop("_salt")
    return _first(df, keys, order, n)


def _first(df: DataFrame, keys: list[str], order: list[str | Column], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def number_rows(df: DataFrame, keys: list[str], order: list[str], name: str = "row_no", buckets: int = 1024) -> DataFrame:
    """Number the rows of each group 1, 2, 3... without sorting a whole group in one task.

    Meant for few groups that may be huge. Rows are ordered by bucket first, where the bucket is a
    hash of the ``order`` columns, and by ``order`` within a bucket; the columns must tell all rows
    of a group apart. Counts per bucket, a table of at most groups x buckets rows, turn into
    starting numbers. Ranking and join both go by bucket and group, so the rows are shuffled and
    sorted once, and a hot group spreads over all tasks. The input is read twice.
    """
    # A struct key compares equal to itself even where a group column is NULL.
    spread = df.withColumn("_group", F.struct(*keys)).withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    place = ["_bucket", "_group"]
    earlier = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        spread.groupBy(*place)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*place, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*place).orderBy(*order)
    return (
        spread.withColumn("_inside", F.row_number().over(inside))
        .join(starts, place)
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop(*place, "_before", "_inside")
    )
