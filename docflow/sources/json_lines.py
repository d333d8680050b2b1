"""JSON text to VARIANT records, with malformed lines set aside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MALFORMED = "malformed JSON"
NOT_AN_OBJECT = "not a JSON object"
TOO_DEEP = "malformed JSON or nested too deeply"
PARSER_LEVELS = 900


def parse_json_lines(lines: DataFrame, text: str = "value", record: str = "record") -> DataFrame:
    """Add ``record`` (VARIANT) and ``error``; empty lines and a literal ``null`` yield no row.

    A repeated key keeps its last value (see ``session.configure``).
    """
    body = F.ltrim(F.col(text), F.lit(" \t\r\n"))
    # The parser takes about a thousand levels; brackets beyond that may be depth or not.
    brackets = F.length(F.regexp_replace(F.col(text), r"[^\[{]", ""))
    parsed = (
        lines.filter(F.length(text) > 0)
        .withColumn(record, F.try_parse_json(F.col(text)))
        .filter(F.col(record).isNull() | ~F.is_variant_null(F.col(record)))
    )
    # Text that parses and opens with a brace is an object; no need to take the value apart.
    error = (
        F.when(F.col(record).isNull(), F.when(brackets > PARSER_LEVELS, TOO_DEEP).otherwise(MALFORMED))
        .when(~body.startswith("{"), NOT_AN_OBJECT)
        .otherwise(F.lit(None).cast("string"))
    )
    return parsed.withColumn("error", error)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).drop("error")


def rejected(parsed: DataFrame, record: str = "record") -> DataFrame:
    return parsed.filter(F.col("error").isNotNull()).drop(record)


def parsed_once(parsed: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected lines of a parse that runs once.

    The lines are written with their outcome as the partition, and each side is read back from its own
    files. Any DataFrame with an ``error`` will do, such as one of ``flatten_json``.
    """
    if "outcome" in parsed.columns:
        raise ValueError("a column is called outcome already")
    told = parsed.withColumn("outcome", F.when(F.col("error").isNull(), "accepted").otherwise("rejected"))
    told.write.partitionBy("outcome").parquet(path)
    stored = parsed.sparkSession.read.schema(told.schema).parquet(path)
    good, bad = (stored.filter(F.col("outcome") == side).drop("outcome") for side in ("accepted", "rejected"))
    return good.drop("error"), bad
