"""Log parsing over a text column."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.grok import Grok, builtin_library, iso_utc, tokens
from docflow.functions.let import first_match, let

#: Ready-made patterns for common log formats.
PRESETS = (
    "COMMONAPACHELOG",
    "COMBINEDAPACHELOG",
    "SYSLOGBASE",
    "SYSLOGLINE",
    "SYSLOG5424LINE",
    "SYSLOGPAMSESSION",
    "CRONLOG",
    "NETSCREENSESSIONLOG",
    "CISCO_TAGGED_SYSLOG",
    "HAPROXYHTTP",
    "HAPROXYTCP",
    "JAVASTACKTRACEPART",
    "RT_FLOW1",
    "RT_FLOW2",
    "RT_FLOW3",
    "MCOLLECTIVE",
    "MCOLLECTIVEAUDIT",
    "MONGO_LOG",
    "MONGO_SLOWQUERY",
    "NAGIOSLOGLINE",
    "POSTGRESQL",
    "REDISLOG",
    "RUBY_LOGGER",
)
# Some of its layouts end in a lazy field, which an unanchored find would leave empty.
_FULL_MATCH = {"NAGIOSLOGLINE"}

#: Message numbers of each firewall layout; the layouts are named after them.
FIREWALL_LAYOUTS = {
    name: name.removeprefix("CISCOFW").split("_") for name in builtin_library() if name.startswith("CISCOFW")
}


@cache
def preset(name: str) -> Grok:
    """A built-in pattern by name, compiled once per driver."""
    if name not in PRESETS and name not in FIREWALL_LAYOUTS:
        raise ValueError(f"no log preset {name!r}; one of {sorted(PRESETS)}")
    return Grok(f"%{{{name}}}", full_match=name in _FULL_MATCH)


def _as_grok(pattern: Grok | str) -> Grok:
    if isinstance(pattern, Grok):
        return pattern
    return preset(pattern) if pattern in PRESETS else Grok(pattern)


def grok_extract(df: DataFrame, text: str, pattern: Grok | str) -> DataFrame:
    """Add the pattern's fields to every row that matches and drop the other rows.

    A field takes the place of an input column of the same name. The struct goes through a generator instead of a filter: a filter would be pushed below the
    projection and run the regular expression a second time.
    """
    grok = _as_grok(pattern)
    matched = F.filter(F.array(grok.extract(F.col(text))), lambda row: row.isNotNull())
    return df.select(*(c for c in df.columns if c not in grok.fields), F.inline(matched))


def grok_unmatched(df: DataFrame, text: str, pattern: Grok | str) -> DataFrame:
    """The rows ``grok_extract`` leaves out, empty lines included."""
    return df.filter(~_as_grok(pattern).matches(F.col(text)))


def with_iso_date(df: DataFrame, date_field: str, date_format: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Add an ISO-8601 UTC field read from ``date_field``.

    Returns the good rows (a missing date just leaves the new field empty) and the rows whose
    date cannot be read, with the reason.
    """
    if not date_format:
        raise ValueError("a date field needs its format")
    dated = df.withColumn(target, iso_utc(F.col(date_field), date_format))
    bad = F.col(date_field).isNotNull() & F.col(target).isNull()
    rejects = dated.filter(bad).drop(target).withColumn("error", F.lit(f"unreadable date in {date_field}"))
    return dated.filter(~bad), rejects


def firewall_messages(df: DataFrame, text: str) -> DataFrame:
    """Parse tagged firewall lines: header fields, layout chosen by tag, fields as a map.

    A line whose tag has no known layout, or whose message does not fit it, keeps its header and
    has a NULL ``fields`` map.
    """

    def by_number(number: Column) -> Column:
        return first_match(
            (number.isin(numbers), preset(name).extract_map(F.col(text))) for name, numbers in FIREWALL_LAYOUTS.items()
        )

    header = grok_extract(df, text, "CISCO_TAGGED_SYSLOG")
    return header.withColumn("fields", let(F.substring_index("ciscotag", "-", -1), by_number))


def extract_all_tokens(df: DataFrame, text: str, name: str, keep: list[str | Column]) -> DataFrame:
    """One row per occurrence of a named token (``IPV4``, ``URI``, ``UUID``...) in the whole text."""
    return df.select(*keep, F.explode(tokens(F.col(text), name)).alias("token"))
