"""Chat formatting: a dialogue seen from every participant's side.

For each speaker the whole dialogue is written with that speaker's turns as the assistant's and all
others as named users; the mask holds the character ranges the model shall learn, the assistant's
words with their end mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A row holds at most so many turns; a longer dialogue goes on in the next part.
PART_TURNS = 256
END = "<|end|>\n"


def rotate(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    context_roles: tuple[str, ...] = ("system",),
) -> DataFrame:
    """One row per dialogue, speaker and part: ``conv_id, speaker, part, n_turns, text, spans``.

    Turns stand in the order of their number, then role and text; a NULL number comes last. Turns of
    ``context_roles`` are nobody's words: they are written with their own role, and make no
    perspective. A NULL role is the speaker ``unknown``, a NULL text is empty. A NULL conversation is
    a conversation of its own. Repeated rows are turns of their own. A dialogue of context alone has
    no rows. ``spans`` are half-open character ranges within ``text``. Other columns are ignored.

    Dialogues are cut into parts of at most 256 turns (by turn number, then by count; turns without
    a number are a part of their own), so that no task ever holds a whole long dialogue; the parts of a speaker, in order, are the full rendering.
    """
    said = turns.select(
        F.struct(F.col(conv_col).alias("id")).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("block", F.floor(F.col("turn") / PART_TURNS))
    order = [F.col("turn").asc_nulls_last(), "role", "text"]
    within = Window.partitionBy("conv", F.struct("block")).orderBy(*order)
    pieces = (
        said.withColumn("n", F.row_number().over(within))
        .withColumn("piece", F.floor((F.col("n") - 1) / PART_TURNS))
        .groupBy("conv", "block", "piece")
        .agg(F.sort_array(F.collect_list(F.struct("n", "role", "text"))).alias("turns"))
    )
    by_part = Window.partitionBy("conv").orderBy(F.col("block").asc_nulls_last(), "piece")
    parts = pieces.withColumn("part", F.row_number().over(by_part) - 1)
    speakers = said.filter(~F.col("role").isin(*context_roles)).select("conv", F.col("role").alias("speaker")).distinct()
    seen = parts.join(speakers, "conv")

    def head(turn: Column) -> Column:
        context = F.concat(F.lit("<|"), turn["role"], F.lit("|>"))
        named = F.concat(F.lit("<|user|>"), turn["role"], F.lit(": "))
        return (
            F.when(turn["role"].isin(*context_roles), context)
            .when(turn["role"] == F.col("speaker"), F.lit("<|assistant|>"))
            .otherwise(named)
        )

    lines = F.transform(
        "turns",
        lambda t: F.struct(
            head(t).alias("head"),
            F.concat(t["text"], F.lit(END)).alias("body"),
            (t["role"] == F.col("speaker")).alias("own"),
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))

    def advance(state: Column, line: Column) -> Column:
        begin = state["at"] + F.length(line["head"])
        end = begin + F.length(line["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(line["own"], F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return seen.withColumn("lines", lines).select(
        F.col("conv.id").alias("conv_id"),
        "speaker",
        F.col("part").cast("int").alias("part"),
        F.size("lines").alias("n_turns"),
        F.array_join(F.transform("lines", lambda x: F.concat(x["head"], x["body"])), "").alias("text"),
        F.aggregate("lines", start, advance, lambda s: s["spans"]).alias("spans"),
    )


ORACLE = """
WITH said AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
numbered AS (SELECT *, floor(turn / 256) AS block, row_number() OVER (PARTITION BY conv_id, floor(turn / 256)
    ORDER BY turn NULLS LAST, role, text) AS n FROM said),
pieces AS (SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY block NULLS LAST, (n - 1) // 256) - 1 AS part
  FROM numbered),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM said WHERE role <> 'system'),
lines AS (SELECT p.conv_id, speaker, part, n, role = speaker AS own,
    CASE WHEN role = 'system' THEN '<|system|>' WHEN role = speaker THEN '<|assistant|>'
      ELSE '<|user|>' || role || ': ' END AS head, text || '<|end|>' || chr(10) AS body
  FROM pieces p JOIN speakers s ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker, part ORDER BY n) AS done FROM lines)
SELECT conv_id, speaker, part::INTEGER AS part, count(*)::INTEGER AS n_turns, string_agg(head || body, '' ORDER BY n) AS text,
  coalesce(string_agg((done - length(body))::BIGINT || '-' || done::BIGINT, ',' ORDER BY n) FILTER (WHERE own), '') AS spans
FROM placed GROUP BY conv_id, speaker, part
"""
