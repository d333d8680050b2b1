"""Guessing the type of text fields: boolean, long, double, date, else string."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.functions.let import first_match, let, named

# The date formats that are tried, in this order.
DATE_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSZ",
    "yyyy-MM-dd'T'HH:mm:ss,SSSZ",
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss,SSS",
    "yyyy-MM-dd'T'HH:mm:ssZ",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mmZ",
    "yyyy-MM-dd'T'HH:mm",
    "yyyy-MM-dd HH:mm:ss.SSSZ",
    "yyyy-MM-dd HH:mm:ss,SSSZ",
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss,SSS",
    "yyyy-MM-dd HH:mm:ssZ",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mmZ",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
)

_NUMBER = r"^-?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def _is_boolean(text: Column) -> Column:
    return F.lower(text).isin("true", "false")


def _as_long(text: Column) -> Column:
    return F.when(text.rlike(r"^-?\d+$"), text.try_cast("bigint"))


def _as_double(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def _shape(date_format: str) -> str:
    """How a date of this format looks once each digit is written as 0 and an offset as Z."""
    return re.sub(r"[yMdHmsS]", "0", date_format).replace("'", "")


def as_date(text: Column) -> Column:
    """The text read by the date format of its shape; NULL if there is none.

    Every format has a shape of its own, so one parse decides: trying them in turn would raise
    and catch an error for each that fails.
    """
    zeros = F.regexp_replace(F.regexp_replace(text, "[0-9]", "0"), "(?<=:00|:00[.,]000)[+-]0000$", "Z")

    def by_shape(shape: Column) -> Column:
        return first_match(
            (shape == _shape(date_format), F.try_to_timestamp(text, F.lit(date_format))) for date_format in DATE_FORMATS
        )

    return let(zeros, by_shape)


def guess_value(text: Column) -> Column:
    """Type name of a single value; NULL for NULL."""
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(_is_boolean(text), "boolean")
        .when(_as_long(text).isNotNull(), "long")
        .when(_as_double(text).isNotNull(), "double")
        .when(as_date(text).isNotNull(), "date")
        .otherwise("string")
    )


def guess_types(df: DataFrame, columns: list[str] | None = None) -> dict[str, str]:
    """Type of each text column, from one pass over the data that returns a single row.

    A column gets the narrowest type all its values fit; longs and doubles together make a
    double, any other mixture (and a column without values) a string.
    """
    chosen = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    summary = df.select(*(guess_value(named(c)).alias(c) for c in chosen)).agg(
        *(F.collect_set(named(c)).alias(c) for c in chosen)
    )
    found = summary.first()
    return {c: _common(set(found[c])) for c in chosen}


def _common(kinds: set[str]) -> str:
    if len(kinds) == 1:
        return next(iter(kinds))
    return "double" if kinds == {"long", "double"} else "string"


def cast_guessed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns to their guessed types."""
    casts = {
        "boolean": lambda c: F.lower(c) == "true",
        "long": _as_long,
        "double": _as_double,
        "date": as_date,
        "string": lambda c: c,
    }
    return df.withColumns({c: casts[kind](named(c)) for c, kind in types.items()})
