"""Taking VARIANT values apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_object(value: Column) -> Column:
    """Entries of a JSON object as MAP<STRING, VARIANT>; NULL for anything else."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def as_list(value: Column) -> Column:
    """Elements of a JSON array as ARRAY<VARIANT>; NULL for anything else."""
    return F.try_variant_get(value, "$", "array<variant>")


def as_text(value: Column) -> Column:
    """A scalar as its text; a list or an object as JSON."""
    return F.try_variant_get(value, "$", "string")


def is_null(value: Column) -> Column:
    """NULL itself or the JSON ``null``."""
    return value.isNull() | F.is_variant_null(value)
