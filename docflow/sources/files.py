"""File listing and numbered lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docflow.session import pin_file_splits


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files directly below ``path`` whose name matches ``glob``: ``file_uri, length, modified``.

    Folders give no rows, whatever their names; ``path`` may be a pattern of folders. The content
    column is never selected, so no file is read.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    depth = system.makeQualified(folder).depth()
    # Names such as a=1 would make a lookup that is not recursive enter the folder, or fail on several.
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    below = F.regexp_replace("path", "^[^/:]+:(//[^/]*)?", "")
    return listing.filter(F.regexp_count(below, F.lit("/")) == depth + 1).select(
        F.col("path").alias("file_uri"), F.col("length"), F.col("modificationTime").alias("modified")
    )


def read_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Lines of text files with their origin: ``value, file, block, position``.

    ``block`` is where the scan of this part of the file starts; ``position`` grows with the line
    order inside one block. Both are needed only by the functions below.
    """
    pin_file_splits(spark)
    reader = spark.read if glob is None else spark.read.option("pathGlobFilter", glob)
    return reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
    )


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """Replace ``block, position`` by the 1-based ``line_no`` within the file, blank lines counted.

    No file is sorted or gathered: lines are counted per block, the small table of counts becomes
    a running total per file, and each line adds its offset within its block. A file of many
    terabytes is handled by as many tasks as it has blocks.
    """
    counts = lines.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("_lines"), F.min("position").alias("_first")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "file", "block", "_first", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before")
    )
    line_no = F.col("_before") + F.col("position") - F.col("_first") + 1
    # Both sides scan the same files; a block missing from the counts would mean that the files
    # changed in between, and must stop the job rather than lose lines.
    checked = F.when(F.col("_before").isNull(), F.raise_error(F.lit("input files changed during the scan")))
    return lines.join(offsets, ["file", "block"], "left").select(
        *[c for c in lines.columns if c not in ("block", "position")],
        F.coalesce(checked.cast("bigint"), line_no).alias("line_no"),
    )


def non_blank(lines: DataFrame, text: str = "value") -> DataFrame:
    """Drop empty lines; a line of blanks is kept, as it is for a tailed log."""
    return lines.filter(F.length(text) > 0)


def with_line_ids(records: DataFrame, id_col: str = "id") -> DataFrame:
    """Give records without an id the id ``file-line``; other ids are kept, as text."""
    generated = F.concat_ws("-", F.col("file"), F.col("line_no").cast("string"))
    existing: Column = F.col(id_col).cast("string") if id_col in records.columns else F.lit(None).cast("string")
    return records.withColumn(id_col, F.coalesce(existing, generated))


def raw_documents(numbered: DataFrame) -> DataFrame:
    """Unparsed lines as documents: ``id`` is ``file:line`` and the text is ``_raw_content_``."""
    return non_blank(numbered).select(
        F.concat_ws(":", F.col("file"), F.col("line_no").cast("string")).alias("id"),
        F.col("value").alias("_raw_content_"),
    )
