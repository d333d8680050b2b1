"""Latencies over time as mergeable sketches in a table.

A value is counted in a bucket whose bounds grow by a fixed ratio, so that any quantile is known within a
relative error chosen beforehand, whatever the number of values. A sketch is one row per bucket in use; sketches merge
by adding counts, which Spark does like any sum. A micro-batch appends a folder of its own and replaces it when
it is repeated. Nothing is kept on the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ERROR = 0.01
# Values below this are counted together, as zero.
LEAST = 1e-6
_ZERO = -(1 << 31)


def _ratio(error: float) -> float:
    if not 0.0001 <= error <= 0.5:
        raise ValueError("the relative error lies between a ten-thousandth and a half")
    return (1 + error) / (1 - error)


def bucket_of(value: Column, error: float = ERROR) -> Column:
    """Number of the bucket of a value; the numbers rise with the values. Of values below ``LEAST`` it is the lowest INT."""
    return F.when(value < LEAST, _ZERO).otherwise(F.ceil(F.ln(value) / math.log(_ratio(error))).cast("int"))


def value_of(bucket: Column, error: float = ERROR) -> Column:
    """The value that stands for a bucket: no value in it is further away than ``error``, as a part of itself."""
    ratio = _ratio(error)
    return F.when(bucket == _ZERO, 0.0).otherwise(F.pow(F.lit(ratio), bucket) * (2 / (1 + ratio)))


def latency_sketches(
    values: DataFrame, by: list[str], at: str | Column, value: str = "millis", every: str = "1 minute", error: float = ERROR
) -> DataFrame:
    """``by``, ``since``, ``bucket``, ``n`` of each span of time, counted in the tasks before any shuffle.

    A NULL, NaN or infinite value and a value without a time take no part. A group of any size is as many rows
    as it has buckets: about 115 for values that differ by a factor of ten, at an error of a hundredth.
    """
    measured = F.col(value).cast("double")
    since = F.window(F.col(at) if isinstance(at, str) else at, every)["start"].alias("since")
    usable = measured.isNotNull() & ~F.isnan(measured) & (F.abs(measured) < float("inf"))
    found = values.filter(usable).select(*by, since, bucket_of(measured, error).alias("bucket"))
    return found.groupBy(*by, "since", "bucket").agg(F.count(F.lit(1)).alias("n"))


def append_sketches(sketches: DataFrame, path: str, batch_id: int) -> None:
    """Store the sketches of a batch; a repeated batch takes the place of its first attempt."""
    sketches.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    """All stored sketches; several rows of one bucket add up."""
    return spark.read.parquet(path).drop("batch_id")


def merged_quantiles(sketches: DataFrame, by: list[str], quantiles: list[float], error: float = ERROR) -> DataFrame:
    """``by``, ``quantile``, ``n``, ``bucket``, ``value``: the smallest value that at least this part of all does not exceed.

    ``by`` may leave out columns of the sketches, such as ``since``, or be empty. Windows run over the merged buckets of a
    group, not over its values.
    """
    if any(not 0 <= q <= 1 for q in quantiles):
        raise ValueError("a quantile lies between 0 and 1")
    merged = sketches.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by)
    summed = merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("total", F.sum("n").over(group))
    asked = summed.withColumn("quantile", F.explode(F.array(*(F.lit(float(q)) for q in quantiles))))
    reached = asked.filter((F.col("upto") >= F.col("quantile") * F.col("total")))
    found = reached.groupBy(*by, "quantile").agg(F.max("total").alias("n"), F.min("bucket").alias("bucket"))
    return found.withColumn("value", value_of(F.col("bucket"), error))
