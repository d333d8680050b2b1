"""Typed rows and maps to documents: projections decided from the schema, no UDF."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.functions.let import named

# Field name suffix of each value type, and of text that holds a blank.
SUFFIXES = {
    T.StringType: "_s",
    T.LongType: "_l",
    T.IntegerType: "_i",
    T.DoubleType: "_d",
    T.FloatType: "_f",
    T.BooleanType: "_b",
    T.TimestampType: "_tdt",
    T.TimestampNTZType: "_tdt",
    T.DateType: "_tdt",
}
TEXT_SUFFIX = "_t"


def _suffix(data_type: T.DataType) -> str | None:
    return SUFFIXES.get(type(data_type))


def _value(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.TimestampNTZType, T.DateType)):
        return named(field.name).cast("timestamp")
    return named(field.name)


def dynamic_fields(df: DataFrame, id_col: str, overrides: dict[str, str] | None = None) -> DataFrame:
    """Rows to documents whose field names carry a suffix for the value type.

    A string lands in ``name_s``, or in ``name_t`` when it holds a blank, decided per value.
    ``overrides`` fixes the suffix of a field, of any type but arrays. Arrays and types without a
    suffix are left out; so is a source column ``id``, since the document id takes its place.
    A NULL stays NULL and is absent once the document is serialised.
    """
    overrides = overrides or {}
    columns: list[Column] = [F.col(id_col).cast("string").alias("id")]
    names = ["id"]

    def add(column: Column, name: str):
        columns.append(column.alias(name))
        names.append(name)

    for field in df.schema.fields:
        if field.name in ("id", id_col) or isinstance(field.dataType, T.ArrayType):
            continue
        if field.name in overrides:
            add(_value(field), field.name + overrides[field.name])
        elif isinstance(field.dataType, T.StringType):
            has_blank = F.instr(named(field.name), " ") > 0
            add(F.when(~has_blank, named(field.name)), field.name + SUFFIXES[T.StringType])
            add(F.when(has_blank, named(field.name)), field.name + TEXT_SUFFIX)
        elif _suffix(field.dataType):
            add(_value(field), field.name + _suffix(field.dataType))
    _check_distinct(names)
    return df.select(*columns)


def guessed_fields(df: DataFrame, id_col: str) -> DataFrame:
    """Rows to documents with unchanged field names, for a destination that guesses the types.

    Arrays are left out here too.
    """
    kept = [
        named(f.name) for f in df.schema.fields if f.name not in ("id", id_col) and not isinstance(f.dataType, T.ArrayType)
    ]
    return df.select(F.col(id_col).cast("string").alias("id"), *kept)


def map_fields(df: DataFrame, id_col: str, map_col: str) -> DataFrame:
    """Maps to documents, entries unchanged: ``id, fields``. An ``id`` entry replaces the id."""
    own = F.col(map_col)["id"].cast("string")
    return df.select(
        F.coalesce(own, F.col(id_col).cast("string")).alias("id"),
        F.map_filter(map_col, lambda k, v: (k != "id") & v.isNotNull()).alias("fields"),
    )


def as_documents(df: DataFrame) -> DataFrame:
    """Rows that are documents already pass through."""
    return df


def keep_mapped(df: DataFrame, document: str) -> DataFrame:
    """A mapper vetoes a record by returning NULL: such rows are not indexed."""
    return df.filter(F.col(document).isNotNull())


def to_fields(documents: DataFrame, id_col: str = "id") -> DataFrame:
    """Long form of wide documents, ``id, field, value`` as text; NULL fields are absent."""
    entries = [
        F.struct(F.lit(c).alias("field"), named(c).cast("string").alias("value"))
        for c in documents.columns
        if c != id_col
    ]
    present = F.filter(F.array(*entries), lambda e: e["value"].isNotNull())
    return documents.select(F.col(id_col).alias("id"), F.inline(present))


def to_json_text(df: DataFrame, payload: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Add ``json``: a string payload untouched, anything else serialised; NULLs are left out."""
    if payload is not None:
        is_text = isinstance(df.schema[payload].dataType, T.StringType)
        return df.withColumn("json", F.col(payload) if is_text else F.to_json(payload))
    return df.withColumn("json", F.to_json(F.struct(*map(named, columns or df.columns))))


def envelopes(df: DataFrame, id_col: str, fields: list[str] | str | None = None) -> DataFrame:
    """Rows to ``id`` and ``fields``, a list of name/value pairs for an indexing service.

    ``fields`` lists columns (values keep their type as VARIANT) or names one MAP column. A
    missing value becomes an empty string: here NULL fields are kept.
    """
    if isinstance(fields, str):
        pairs = F.transform(
            F.map_entries(fields),
            lambda e: F.struct(e["key"].alias("name"), _or_empty(e["value"].cast("variant")).alias("value")),
        )
    else:
        chosen = fields if fields is not None else [c for c in df.columns if c != id_col]
        pairs = F.array(
            *(F.struct(F.lit(c).alias("name"), _or_empty(_variant(df.schema[c])).alias("value")) for c in chosen)
        )
    return df.select(F.col(id_col).cast("string").alias("id"), pairs.alias("fields"))


def _variant(field: T.StructField) -> Column:
    column = named(field.name)
    if isinstance(field.dataType, (T.StructType, T.MapType, T.ArrayType)):
        return F.to_variant_object(column)
    return column.cast("variant")


def _or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit("").cast("variant"))


def envelope_json(enveloped: DataFrame) -> DataFrame:
    """Envelopes as the JSON text ``{"id": ..., "fields": [{"name": ..., "value": ...}]}``."""
    return enveloped.select("id", F.to_json(F.struct("id", "fields")).alias("json"))


def drop_blank(df: DataFrame, columns: list[str] | None = None, trim: bool = True) -> DataFrame:
    """Set empty strings to NULL, which makes the field absent; with ``trim`` also all-blank ones."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    chosen = [c for c in (columns or df.columns) if c in text]
    return df.withColumns({c: F.when(F.length(F.trim(named(c)) if trim else named(c)) > 0, named(c)) for c in chosen})


def clean_names(df: DataFrame) -> DataFrame:
    """Replace every character of a field name but letters, digits, ``_``, ``-`` and ``.`` by ``_``."""
    names = [re.sub(r"[^A-Za-z0-9_\-.]", "_", c) for c in df.columns]
    _check_distinct(names)
    return df.toDF(*names)


def with_missing_ids(df: DataFrame, id_col: str = "id", content: list[str] | None = None) -> DataFrame:
    """Give documents without an id a UUID.

    With ``content`` the UUID is derived from those columns, so that a replayed record gets the
    same id; without, it is random and new on every attempt of a task.
    """
    if content is None:
        generated = F.uuid()
    else:
        parts = [F.coalesce(F.concat(F.lit("+"), named(c).cast("string")), F.lit("-")) for c in content]
        digest = F.sha2(F.concat_ws("\u001f", *parts), 256)
        sizes, at, pieces = (8, 4, 4, 4, 12), 1, []
        for size in sizes:
            pieces.append(F.substring(digest, at, size))
            at += size
        generated = F.concat_ws("-", *pieces)
    existing = F.col(id_col).cast("string") if id_col in df.columns else F.lit(None).cast("string")
    return df.withColumn(id_col, F.coalesce(existing, generated))


def with_ids_and_payload(df: DataFrame, id_col: str, payload: str) -> DataFrame:
    """Drop records without an id or without a payload."""
    return df.filter(F.col(id_col).isNotNull() & F.col(payload).isNotNull())


def _check_distinct(names: list[str]):
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"two fields would share the names {twice}")
