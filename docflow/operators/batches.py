"""Batches of bounded size per collection and slot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.operators.ranking import number_rows

# Fixed value: documents in a full batch.
BATCH_SIZE = 100


def batch_plan(df: DataFrame, groups: list[str], order: list[str], size: int = BATCH_SIZE) -> DataFrame:
    """Add ``batch_no``: every ``size`` documents of a group form a batch, numbered from 0.

    The columns of ``order`` must tell the documents of a group apart. All batches of a group are
    full except the last.
    """
    if size < 1:
        raise ValueError("a batch holds at least one document")
    numbered = number_rows(df, groups, order, "_row")
    return numbered.withColumn("batch_no", F.call_function("div", F.col("_row") - 1, F.lit(size))).drop("_row")


def batch_sizes(planned: DataFrame, groups: list[str]) -> DataFrame:
    return planned.groupBy(*groups, "batch_no").agg(F.count(F.lit(1)).alias("docs"))
