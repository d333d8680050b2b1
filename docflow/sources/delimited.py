"""Delimited text: plain splitting (no quoting) with bad rows set aside, or quoted CSV."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.sources.files import read_lines

# Line ends are trimmed of control characters and blanks, i.e. everything up to U+0020.
_BLANKS = "".join(map(chr, range(0x21)))


def split_plain(line: Column, delimiter: str) -> Column:
    """Cells of a line: no quoting, and empty cells at the end of the line do not count."""
    quoted = re.escape(delimiter)
    if len(delimiter) == 1:
        kept = F.rtrim(line, F.lit(delimiter))
    else:
        kept = F.regexp_replace(line, rf"(?:{quoted})+\z", "")
    none = F.array().cast("array<string>")
    return F.when((F.length(kept) == 0) & (F.length(line) > 0), none).otherwise(F.split(kept, quoted))


def parse_delimited(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str = ",",
    header: bool = True,
    fields: list[str] | None = None,
    id_field: str = "id",
    glob: str | None = None,
) -> DataFrame:
    """All data rows of the files: ``file, line, names, cells, id_index, accepted``.

    With ``header`` the first line of each file names its columns, so files may differ; without,
    ``fields`` does and the first column is the id. Given both, the header lines are skipped and
    ``fields`` is believed: prefer this for large inputs, as it saves a scan that looks for the
    headers. Blank lines are left out.
    ``accepted`` is false where the number of cells differs from the number of names.
    """
    if not header and not fields:
        raise ValueError("files without a header line need fields")
    if header and fields:
        lines = _lines_below_header(spark, path, glob)
    else:
        lines = read_lines(spark, path, glob)
    lines = lines.withColumn("line", F.btrim("value", F.lit(_BLANKS)))
    if header and not fields:
        # Grouping by a number first keeps the sort of this aggregation off the long file names.
        heads = lines.filter("block = 0").groupBy(F.xxhash64("file"), "file").agg(
            F.min_by("line", "position").alias("_head"), F.min("position").alias("_head_at")
        )
        names = split_plain(F.col("_head"), delimiter)
        heads = heads.select("file", "_head_at", names.alias("names"))
        # One row per file on the right: Spark broadcasts it when its measured size allows, and
        # otherwise splits a file that dominates the data as a skewed join key.
        rows = lines.join(heads, "file", "left").filter(
            (F.col("block") != 0) | (F.col("position") != F.col("_head_at"))
        )
        at = F.array_position("names", F.lit(id_field)).cast("int")
        id_index = F.when(at > 0, at).otherwise(F.lit(1))
    else:
        rows = lines.withColumn("names", F.array(*map(F.lit, fields)))
        id_index = F.lit(fields.index(id_field) + 1 if header and id_field in fields else 1)
    # A generator keeps the filter on ``accepted`` from splitting each line a second time.
    cells = F.explode(F.array(split_plain(F.col("line"), delimiter)))
    rows = rows.filter(F.length("line") > 0).select("file", "line", "names", id_index.alias("id_index"), cells.alias("cells"))
    return rows.withColumn("accepted", F.size("cells") == F.size("names"))


def _lines_below_header(spark: SparkSession, path: str | list[str], glob: str | None) -> DataFrame:
    """All lines but the first of each file, as one column.

    A line that holds the separator has too many cells; the reader then hands over the whole line.
    """
    reader = spark.read if glob is None else spark.read.option("pathGlobFilter", glob)
    lines = reader.schema("value string, _line string").csv(
        path, header=True, enforceSchema=True, sep="\u0001", quote="\u0000", escape="\u0000",
        mode="PERMISSIVE", columnNameOfCorruptRecord="_line",
    )
    return lines.select(F.coalesce("_line", "value", F.lit("")).alias("value"), F.col("_metadata.file_path").alias("file"))


def delimited_documents(parsed: DataFrame) -> DataFrame:
    """Accepted rows as ``doc_id`` and a header-to-text map."""
    return parsed.filter("accepted").select(
        "file",
        F.get(F.col("cells"), F.col("id_index") - 1).alias("doc_id"),
        F.map_from_arrays("names", "cells").alias("row"),
    )


def delimited_rejects(parsed: DataFrame) -> DataFrame:
    """Rows whose number of cells does not match, with their text."""
    return parsed.filter(~F.col("accepted")).select("file", "line")


def delimited_counts(parsed: DataFrame) -> DataFrame:
    """Records and skipped rows of each file."""
    return parsed.groupBy("file").agg(
        F.count_if("accepted").alias("num_records"),
        F.count_if(~F.col("accepted")).alias("num_skipped"),
    )


def read_quoted_csv(spark: SparkSession, path: str | list[str], columns: list[str], delimiter: str = ",") -> DataFrame:
    """CSV with quoting, all columns text; malformed rows are kept in ``_corrupt``."""
    schema = ", ".join(f"`{c}` STRING" for c in [*columns, "_corrupt"])
    return spark.read.csv(
        path,
        schema=schema,
        sep=delimiter,
        header=True,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord="_corrupt",
        enforceSchema=True,
    )
