"""Mixing sources to target weights along a time-varying curriculum.

Every source gets a word target by its weight, held below a multiple of its size. Within a source
documents stand in a fixed pseudo-random order, pass after pass, until the target is filled. A
source's weight changes linearly over the training time; the integral of that schedule is the share
of its words consumed so far, and its inverse turns the running word total of a document into the
time at which it is due. The demand of all sources together up to that time is the document's training
position, as a share of the whole mix. Sorting by position mixes the sources as scheduled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import word_count, written

WEIGHTS = (5.0, 2.0, 1.0)
# Relative change of a source's weight from the middle of the training to its end.
SLOPES = (0.6, 0.0, -0.6)


def training_time(share: Column, slope: Column) -> Column:
    """Time in [0, 1] at which a source has consumed ``share`` of its words.

    The weight at time t is proportional to ``1 + slope * (2t - 1)``, so the consumed share is
    ``slope * t^2 + (1 - slope) * t``.
    """
    level = 1 - slope
    root = F.sqrt(level * level + 4 * slope * share)
    return F.when(slope == 0, share).otherwise((root - level) / (2 * slope))


def training_position(time: Column, slope: Column) -> Column:
    """Share of the whole mix consumed at ``time``; ``slope`` is the mean of the sources' slopes by their quotas."""
    return slope * time * time + (1 - slope) * time


def source_targets(sized: DataFrame, share: float, cap: float) -> DataFrame:
    """One row per source: its size, target and schedule; ``sized`` has ``source`` and ``size``.

    Targets are proportional to the weights; one above ``cap`` times its source's size stops there
    and the excess goes to the others by weight, until none is above. With sources sorted by the
    ratio of cap to weight those that stop come first, so one running total finds them all.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1
    everything = Window.partitionBy()
    ranked = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    out = (
        totals.withColumn("place", place)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("place").cast("int")))
        .withColumn("slope", F.element_at(F.array(*map(F.lit, SLOPES)), F.col("place").cast("int")))
        .withColumn("most", cap * F.col("source_size"))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("wanted", share * F.sum("source_size").over(everything))
        .withColumn("all_weights", F.sum("weight").over(everything))
        .withColumn("level", (F.col("wanted") - earlier("most")) / (F.col("all_weights") - earlier("weight")))
        .withColumn("full", F.col("level") >= F.col("ratio"))
        .withColumn("held", F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(everything))
        .withColumn("free", F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("full"), F.col("most")).otherwise(
                F.col("weight") * (F.col("wanted") - F.col("held")) / F.col("free")
            ),
        )
    )
    out = out.withColumn("quota", F.floor(F.col("target") + 0.5).cast("long"))
    out = out.withColumn("mix_size", F.sum("quota").over(everything))
    # Slopes are tenths; whole numbers give the same sum in any order.
    tenths = F.round(F.col("slope") * 10).cast("long")
    mean = F.sum(F.col("quota") * tenths).over(everything) / (10 * F.col("mix_size"))
    return out.withColumn("mean_slope", F.when(F.col("mix_size") > 0, mean).otherwise(0.0)).select(
        "source", "source_size", "target", "slope", "quota", "mix_size", "mean_slope"
    )


def mix(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = 1.5,
    cap: float = 2.0,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken, positions, mix_size``.

    ``taken`` is the number of words the mix takes, repeats counted: whole passes over the source,
    then a last pass that stops exactly at the quota, the target rounded to a whole word (one
    document per source may be cut there). ``positions`` has the training position of each copy, a
    share of the ``mix_size`` words of the whole mix; it
    is empty for a document that is not taken. Rows come in the order of their first position.

    A NULL or empty text has size 0 and is never taken. A NULL source is a source of its own, last
    by name. Documents without an id, and repeated ids, are documents like all others; equal ids are
    ordered by size. No documents, no rows. The columns ``keep`` go along and break remaining ties;
    others are ignored.
    """
    if cap > 2:
        raise ValueError("a document is taken at most twice")
    # The order of a source's documents: a digest of the id, cut into ranges by its leading digits,
    # so that running totals need no task that sees a whole source.
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    sized = written(
        documents.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            key.alias("key"),
            *keep,
        ),
        "mix-sizes",
    ).withColumn("range", F.substring("key", 1, 3))
    targets = source_targets(sized, share, cap)
    group = F.struct("source")
    ranges = sized.groupBy("source", "range").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # What holds for a source is joined to its ranges, not to its documents: no key is hot.
    starts = (
        ranges.withColumn("group", group)
        .withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .drop("source", "words")
        .join(targets.withColumn("group", group).drop("source"), "group")
    )
    inside = (
        Window.partitionBy("group", "range")
        .orderBy("key", F.col("doc_id").asc_nulls_last(), "size", *keep)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        sized.withColumn("group", group)
        .withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, ["group", "range"])
        .withColumn("start", F.col("before") + F.col("inside"))
    )
    rest = F.col("quota") - F.col("passes") * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(rest - F.col("start"), F.col("size")))
    middle = lambda turn, words: (turn * F.col("source_size") + F.col("start") + words / 2) / F.col("quota")
    due = lambda share: training_position(training_time(share, F.col("slope")), F.col("mean_slope"))
    whole = F.transform(
        F.slice(F.array(F.lit(0), F.lit(1)), F.lit(1), F.least(F.col("passes"), F.lit(2)).cast("int")),
        lambda turn: due(middle(turn, F.col("size"))),
    )
    partial = F.array(due(middle(F.col("passes"), F.col("last"))))
    none = F.array().cast("array<double>")
    return (
        placed.withColumn("passes", F.when(F.col("source_size") > 0, F.expr("quota div source_size")).otherwise(0))
        .withColumn("last", last)
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (F.col("passes") * F.col("size") + F.col("last")).alias("taken"),
            F.when(F.col("size") == 0, none)
            .otherwise(F.concat(whole, F.when(F.col("last") > 0, partial).otherwise(none)))
            .alias("positions"),
            "mix_size",
            *keep,
        )
        .orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc_id")
    )


def schedule(mixed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per copy, ``doc_id, copy, position`` and ``keep``, sorted by position over all partitions."""
    copies = mixed.select("doc_id", F.posexplode("positions").alias("copy", "position"), *keep)
    return copies.orderBy("position", "doc_id", "copy")


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0
      ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w,
    [6, 0, -6][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS slope, 2.0::DOUBLE * source_size AS most, 1.5::DOUBLE * sum(source_size) OVER () AS wanted FROM totals),
levels AS (SELECT *, (wanted - coalesce(sum(most) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0))
      >= most / w AS stops FROM weighed
    WINDOW before AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, slope, CASE WHEN stops THEN most ELSE w *
      (wanted - coalesce(sum(most) FILTER (WHERE stops) OVER (), 0)) / sum(w) FILTER (WHERE NOT stops) OVER () END AS target
    FROM levels),
quotas AS (SELECT *, floor(target + 0.5)::BIGINT AS quota FROM targets),
mixes AS (SELECT *, sum(quota) OVER ()::BIGINT AS mix_size,
    sum(quota * slope) OVER ()::DOUBLE / (10 * sum(quota) OVER ())::DOUBLE AS mean FROM quotas),
placed AS (SELECT s.doc_id, s.size, t.source_size, t.target, t.quota, t.mix_size, t.mean, t.slope / 10::DOUBLE AS slope,
      coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM sized s JOIN mixes t ON s.source IS NOT DISTINCT FROM t.source),
counted AS (SELECT *, quota // source_size AS passes, greatest(0, least(quota % source_size - start, size))::BIGINT AS last FROM placed),
copies AS (SELECT *,
    CASE WHEN size > 0 THEN (start + (CASE WHEN passes > 0 THEN size ELSE nullif(last, 0) END)::DOUBLE / 2::DOUBLE) / quota::DOUBLE END AS first_share,
    CASE WHEN size > 0 AND passes > 0 THEN CASE WHEN passes < 2 AND last = 0
        THEN (start + size::DOUBLE / 2::DOUBLE) / quota::DOUBLE
      ELSE (source_size + start + (CASE WHEN passes < 2 THEN last ELSE size END)::DOUBLE / 2::DOUBLE) / quota::DOUBLE END
    WHEN size > 0 THEN (start + nullif(last, 0)::DOUBLE / 2::DOUBLE) / quota::DOUBLE END AS last_share FROM counted),
times AS (SELECT *,
    CASE WHEN slope = 0 THEN first_share ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * first_share) - (1 - slope)) / (2 * slope) END AS t1,
    CASE WHEN slope = 0 THEN last_share ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * last_share) - (1 - slope)) / (2 * slope) END AS t2
  FROM copies)
SELECT doc_id, size, source_size, target, (passes * size + last)::BIGINT AS taken,
  floor((mean * t1 * t1 + (1 - mean) * t1) * mix_size)::BIGINT AS first_position,
  floor((mean * t2 * t2 + (1 - mean) * t2) * mix_size)::BIGINT AS last_position FROM times
"""
