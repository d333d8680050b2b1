"""Row filters over text and ids."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def track_keywords(df: DataFrame, text: str, keywords: list[str] | None) -> DataFrame:
    """Keep rows whose text holds one of the keywords as a whole word, in any case.

    Without keywords nothing is tracked and every row stays (see ``sample``).
    """
    if not keywords:
        return df
    # One alternation is one pass over the text, however many keywords there are.
    words = "|".join(re.escape(k) for k in sorted(keywords, key=len, reverse=True))
    return df.filter(F.col(text).rlike(rf"(?iuU)(?<!\w)(?:{words})(?!\w)"))


def sample(df: DataFrame, key: str | Column, keep: int, of: int) -> DataFrame:
    """Keep ``keep`` of every ``of`` rows, chosen by key so that a replay keeps the same rows.

    An integer key is used as it is, any other is hashed first.
    """
    if not 0 <= keep <= of or of < 1:
        raise ValueError("keep must lie between 0 and of")
    column = F.col(key) if isinstance(key, str) else key
    integral = isinstance(df.select(column).schema[0].dataType, (T.IntegerType, T.LongType))
    return df.filter(F.pmod(column if integral else F.xxhash64(column), F.lit(of)) < keep)


def by_id(df: DataFrame, value: str, id_col: str = "id") -> DataFrame:
    """The document with the given id."""
    return df.filter(F.col(id_col) == F.lit(value).cast(df.schema[id_col].dataType))
