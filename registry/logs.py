"""Log formats, named tokens and dates in log lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions.grok import Grok, is_token
from docflow.operators import logs as L
from registry import Registry
from registry import log_lines as lines
from registry.common import events, table

area = Registry()

# One line in seven is not of the format and must be dropped.
NOISE = "event_id % 7 = 3"


def _lines(spark, sf_dir, line_sql: str):
    line = F.expr(f"case when {NOISE} then 'unrelated ' || event_type else {line_sql} end")
    return events(spark, sf_dir).select("event_id", line.alias("line"))


def _columns(fields: dict[str, str]) -> str:
    return ", ".join(f'{expected} AS "{name}"' for name, expected in fields.items())


def _format(name: str, preset: str, parts: list[lines.Part], inner: dict[str, str] | None = None) -> None:
    """Register a query that parses one format and returns its fields as columns."""
    grok = L.preset(preset)
    expected = {**lines.fields_of(parts), **(inner or {})}
    expected = {f: expected.get(f, "cast(null as string)") for f in grok.fields}
    sql = f"SELECT event_id, {_columns(expected)} FROM events WHERE NOT ({NOISE})"

    @area.add(sql, name)
    def query(spark, sf_dir):
        parsed = L.grok_extract(_lines(spark, sf_dir, lines.line_of(parts)), "line", grok)
        return parsed.select("event_id", *(f"`{f}`" for f in grok.fields))


_format("access_log_parse", "COMMONAPACHELOG", lines.WEB_COMMON)
_format("access_log_combined", "COMBINEDAPACHELOG", lines.WEB_COMBINED)
_format("syslog_lines", "SYSLOGLINE", lines.SYSLOG_LINE)
_format("syslog_iso_lines", "SYSLOGLINE", lines.SYSLOG_LINE_ISO)
_format("syslog_pam_sessions", "SYSLOGPAMSESSION", lines.SYSLOG_PAM, lines.SYSLOG_PAM_INNER)
_format("cron_log", "CRONLOG", lines.CRON)
_format("syslog_5424", "SYSLOG5424LINE", lines.SYSLOG_5424)
_format("netscreen_sessions", "NETSCREENSESSIONLOG", lines.NETSCREEN)
_format("haproxy_http", "HAPROXYHTTP", lines.HAPROXY_HTTP, lines._HAP_INNER)
_format("haproxy_tcp", "HAPROXYTCP", lines.HAPROXY_TCP, lines._HAP_INNER)
_format("java_stack_frames", "JAVASTACKTRACEPART", lines.JAVA_FRAME)
_format("junos_flow_close", "RT_FLOW1", lines.FLOW_CLOSE)
_format("junos_flow_create", "RT_FLOW2", lines.FLOW_CREATE)
_format("junos_flow_deny", "RT_FLOW3", lines.FLOW_DENY)
_format("mcollective_events", "MCOLLECTIVE", lines.MCOLLECTIVE)
_format("mcollective_audit", "MCOLLECTIVEAUDIT", lines.MCOLLECTIVE_AUDIT)
_format("mongodb_log", "MONGO_LOG", lines.MONGO)
_format("mongodb_slow_queries", "MONGO_SLOWQUERY", lines.MONGO_SLOW)
_format("postgresql_log", "POSTGRESQL", lines.POSTGRES)
_format("redis_log", "REDISLOG", lines.REDIS)
_format("ruby_log", "RUBY_LOGGER", lines.RUBY)


def _case(cases: list[str]) -> str:
    whens = " ".join(f"when {i} then {text}" for i, text in enumerate(cases))
    return f"case event_id % {len(cases)} {whens} end"


def _pairs_sql(fields: dict[str, str]) -> str:
    """``name=value`` of the fields that have a value, in name order."""
    pairs = [f"'{name}=' || ({fields[name]})" for name in sorted(fields)]
    return f"array_to_string(list_filter([{', '.join(pairs)}], lambda p: p IS NOT NULL), ';')"


def _pairs(fields):
    pairs = F.transform(F.map_entries(fields), lambda e: F.struct(e["key"], F.concat_ws("=", e["key"], e["value"]).alias("p")))
    return F.array_join(F.transform(F.array_sort(pairs), lambda e: e["p"]), ";")


@area.add(f"""
    SELECT event_id, {_case([_pairs_sql(lines.fields_of(p)) for p in lines.NAGIOS])} AS fields
    FROM events WHERE NOT ({NOISE})
""")
def nagios_log(spark, sf_dir):
    df = _lines(spark, sf_dir, _case([lines.line_of(p) for p in lines.NAGIOS]))
    parsed = df.select("event_id", L.preset("NAGIOSLOGLINE").extract_map(F.col("line")).alias("fields"))
    return parsed.select("event_id", _pairs("fields").alias("fields")).filter("fields IS NOT NULL")


_HEADER = [
    "<", ("syslog_pri", lines.number("event_id", 190, 1)), ">", ("timestamp", lines.SYSLOG_TIME), " ",
    ("sysloghost", lines.HOST), ": %",
]
_TAGS = list(lines.FIREWALL)


@area.add(f"""
    SELECT event_id, {_case([f"'ASA-4-{t}'" for t in _TAGS])} AS ciscotag, {lines.HOST} AS sysloghost,
      {_case([_pairs_sql(lines.fields_of(p)) for p in lines.FIREWALL.values()])} AS fields
    FROM events WHERE NOT ({NOISE})
""")
def firewall_messages(spark, sf_dir):
    messages = _case([lines.line_of([f"ASA-4-{tag}: ", *parts]) for tag, parts in lines.FIREWALL.items()])
    df = _lines(spark, sf_dir, f"{lines.line_of(_HEADER)} || {messages}")
    parsed = L.firewall_messages(df, "line")
    return parsed.select("event_id", "ciscotag", "sysloghost", _pairs("fields").alias("fields"))


@area.add(f"SELECT event_id, 'unrelated ' || event_type AS line FROM events WHERE {NOISE}")
def unmatched_lines(spark, sf_dir):
    return L.grok_unmatched(_lines(spark, sf_dir, lines.line_of(lines.WEB_COMMON)), "line", "COMMONAPACHELOG")


@area.add(f"""
    SELECT event_id, event_type AS kind, user_id AS who FROM events
    WHERE NOT ({NOISE}) AND event_type <> 'error'
""")
def custom_pattern(spark, sf_dir):
    # A pattern of our own next to the built-in ones, with a typed field.
    library = {"ACTIVITY": "click|view|signup|purchase"}
    grok = Grok("%{ACTIVITY:kind} by %{INT:who:int}#", library)
    df = _lines(spark, sf_dir, "event_type || ' by ' || cast(user_id as string) || '#'")
    return L.grok_extract(df, "line", grok).drop("line")


@area.add("""
    SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S.000Z') AS iso FROM events WHERE event_id % 11 <> 0
""")
def iso_date(spark, sf_dir):
    dated = events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 11 == 0, "no date").otherwise(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss Z")).alias("timestamp"),
    )
    good, _ = L.with_iso_date(dated, "timestamp", "dd/MMM/yyyy:HH:mm:ss Z", "iso")
    return good.select("event_id", "iso")


@area.add("SELECT count(*) AS docs, 'unreadable date in timestamp' AS error FROM events WHERE event_id % 11 = 0")
def iso_date_rejects(spark, sf_dir):
    text = F.when(F.col("event_id") % 11 == 0, "no date").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    dated = events(spark, sf_dir).select("event_id", text.alias("timestamp"))
    _, bad = L.with_iso_date(dated, "timestamp", "yyyy-MM-dd HH:mm:ss", "iso")
    return bad.groupBy("error").agg(F.count(F.lit(1)).alias("docs"))


def _tokens(name: str, token: str, source: str, key: str, text: str, regex: str, group: int = 0) -> None:
    """Count the occurrences of a token per document over whole texts."""
    sql = f"""
        SELECT {key}, token, count(*) AS n
        FROM (SELECT {key}, unnest(regexp_extract_all({text}, '{regex}', {group})) AS token FROM {source}) GROUP BY 1, 2
    """

    @area.add(sql, name)
    def query(spark, sf_dir):
        found = L.extract_all_tokens(table(spark, sf_dir, source), text, token, [key])
        return found.groupBy(key, "token").agg(F.count(F.lit(1)).alias("n"))


_OCTET = "(?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9]{1,2})"
_tokens("token_extract_words", "WORD", "pages", "page_id", "url", r"\w+")
_tokens("token_extract_numbers", "POSINT", "pages", "page_id", "url", r"\b[1-9][0-9]*\b")
_tokens("token_extract_not_space", "NOTSPACE", "documents", "doc_id", "text", r"\S+")
_tokens("token_extract_uri", "URIPROTO", "pages", "page_id", "url", r"[A-Za-z]+(?:\+[A-Za-z+]+)?")


@area.add(f"""
    WITH spaced AS (SELECT doc_id, regexp_replace(text, '([^0-9.])', '\\1\\1', 'g') AS text FROM documents)
    SELECT doc_id, token, count(*) AS n FROM (
      SELECT doc_id, unnest(regexp_extract_all(text,
        '(?:^|[^0-9])({_OCTET}[.]{_OCTET}[.]{_OCTET}[.]{_OCTET})(?:[^0-9]|$)', 1)) AS token FROM spaced)
    GROUP BY 1, 2
""")
def token_extract_ipv4(spark, sf_dir):
    found = L.extract_all_tokens(table(spark, sf_dir, "documents"), "text", "IPV4", ["doc_id"])
    return found.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


# Text built from an event, and where a named pattern accepts it as a whole.
_VALID = {
    "IP": (lines.SRC, "true"),
    "HOSTPORT": (f"{lines.HOST} || ':' || {lines.number('event_id', 9)}", "event_id % 9 > 0"),
    "TIMESTAMP_ISO8601": (lines.ISO_TIME, "true"),
    "HTTPDATE": (lines.HTTP_TIME, "true"),
    "DATE_EU": (f"{lines.DAY} || '.' || {lines.number('event_id', 14)} || '.2024'", "event_id % 14 BETWEEN 1 AND 12"),
    "TIME": (f"{lines.number('event_id', 30)} || ':' || {lines.MINUTE} || ':' || {lines.SECOND}", "event_id % 30 < 24"),
    "LOGLEVEL": ("case when event_id % 2 = 0 then 'WARNING' else 'LOUD' end", "event_id % 2 = 0"),
    "DAY": ("case when event_id % 2 = 0 then 'Wednesday' else 'Weds' end", "event_id % 2 = 0"),
    "NUMBER": (f"case when event_id % 2 = 0 then '-{{0}}.5' else '1.' end || {lines.USER}".replace("{0}", "7"), "true"),
    "BASE16NUM": (f"'0x' || {lines.EVENT}", "true"),
    "MAC": (f"'00:1B:44:11:3A:' || lpad({lines.number('event_id', 100)}, 2, '0')", "true"),
    "PATH": (f"'/var/log/' || event_type || '.' || {lines.EVENT}", "true"),
    "URI": (f"'https://u@' || {lines.HOST} || ':8080/a/' || event_type || '?k=' || {lines.EVENT}", "true"),
    "UUID": (f"lpad({lines.EVENT}, 8, '0') || '-0000-0000-0000-' || lpad({lines.USER}, 12, '0')", "true"),
    "QUOTEDSTRING": ("case when event_id % 2 = 0 then '\"' || event_type || '\"' else '\"' || event_type end", "event_id % 2 = 0"),
}


@area.add(f"SELECT event_id, {', '.join(f'({valid}) AS {name.lower()}' for name, (_, valid) in _VALID.items())} FROM events")
def token_validate(spark, sf_dir):
    checks = [is_token(F.expr(text), name).alias(name.lower()) for name, (text, _) in _VALID.items()]
    return events(spark, sf_dir).select("event_id", *checks)
