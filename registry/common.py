"""Inputs and SQL fragments several areas share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions.timeframes import TimeFrame
from docflow.session import configure, workspace

TWELVE_HOURS = TimeFrame("events_", unit="HOURS", length=12, pattern="yy-MM-dd_HH")


def ms_sql(ts: str) -> str:
    """Whole milliseconds of a timestamp (``epoch_ms`` would round)."""
    return f"(epoch_us({ts}) // 1000)"


def frame_sql(base: str, frame_ms: int, pattern: str, ts: str = "ts", start: str | None = None, ahead: str = "- 1") -> str:
    """SQL text of a collection name (``ahead`` is ``- 1`` for right-closed frames)."""
    origin = ms_sql(start if start else f"date_trunc('day', {ts})")
    count = f"greatest(0, ({ms_sql(ts)} - {origin} {ahead}) // {frame_ms})"
    return f"'{base}' || strftime(make_timestamp(({origin} + {count} * {frame_ms}) * 1000), '{pattern}')"


COLLECTION_SQL = frame_sql("events_", 43_200_000, "%y-%m-%d_%H")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as an instant; the files hold it without a zone, meaning UTC."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def write_lines(spark: SparkSession, lines: DataFrame, name: str, header: str | None = None) -> str:
    """Write a one-column DataFrame as text files in the shared folder, each with the header line."""
    folder = workspace(spark, name)
    if header is None:
        lines.write.text(folder)
    else:
        # One column and a separator that never occurs: lines come out exactly as they are.
        named = lines.withColumnRenamed(lines.columns[0], header)
        named.write.csv(folder, header=True, sep="\u0001", quote="\u0000", emptyValue="", nullValue="")
    return folder


def write_numbered(spark: SparkSession, rows: DataFrame, group: str, order: str, name: str) -> str:
    """Write ``line`` as one text file per ``group``, in ``order``, so that SQL knows the number of each line."""
    folder = workspace(spark, name)
    placed = rows.repartition(group).sortWithinPartitions(group, order)
    placed.select("line", group).write.partitionBy(group).text(folder)
    return folder


def murmur3_sql(source: str, key: str, keep: str) -> str:
    """SELECT of ``keep`` and ``h``, the signed 32-bit Murmur3 of the text ``key``."""
    word = "'0x' || substr(x, i*8+7, 2) || substr(x, i*8+5, 2) || substr(x, i*8+3, 2) || substr(x, i*8+1, 2)"
    two32 = "4294967296::HUGEINT"

    def rotate(e: str, bits: int) -> str:
        return f"((({e}) * {1 << bits}) % {two32} + ({e}) // {1 << (32 - bits)})"

    def shift_xor(e: str, bits: int) -> str:
        return f"xor({e}, {e} // {1 << bits})"

    mix1 = f"(k * {0xCC9E2D51}::HUGEINT) % {two32}"
    return f"""
      WITH keyed AS (SELECT {keep}, hex(encode({key})) AS x, octet_length(encode({key})) AS n FROM {source}),
      padded AS (SELECT * REPLACE (x || repeat('00', 4) AS x) FROM keyed),
      words AS (SELECT *, list_transform(range((n + 3) // 4), lambda i: ({word})::HUGEINT) AS w0 FROM padded),
      m1 AS (SELECT * REPLACE (list_transform(w0, lambda k: {mix1}) AS w0) FROM words),
      m2 AS (SELECT * REPLACE (list_transform(w0, lambda k: {rotate('k', 15)}) AS w0) FROM m1),
      m3 AS (SELECT * REPLACE (list_transform(w0, lambda k: (k * {0x1B873593}::HUGEINT) % {two32}) AS w0) FROM m2),
      body AS (SELECT *, list_reduce(list_concat([0::HUGEINT], w0[1:n // 4]),
                 lambda h, k: ({rotate('xor(h, k)', 13)} * 5 + {0xE6546B64}) % {two32}) AS b FROM m3),
      tailed AS (SELECT *, xor(xor(b, CASE WHEN n % 4 > 0 THEN w0[n // 4 + 1] ELSE 0::HUGEINT END), n::HUGEINT) AS f0 FROM body),
      f1 AS (SELECT *, ({shift_xor('f0', 16)} * {0x85EBCA6B}) % {two32} AS f1 FROM tailed),
      f2 AS (SELECT *, ({shift_xor('f1', 13)} * {0xC2B2AE35}) % {two32} AS f2 FROM f1),
      f3 AS (SELECT *, {shift_xor('f2', 16)} AS u FROM f2)
      SELECT {keep}, CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END::BIGINT AS h FROM f3
    """
