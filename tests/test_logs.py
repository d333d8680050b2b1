from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from docflow.functions.grok import Grok, builtin_library, load_library, parse_library
from docflow.operators import logs as L


def _parse(spark, pattern, *lines):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "n int, raw string")
    return {r.n: {k: v for k, v in r.asDict().items() if k not in ("n", "raw")} for r in L.grok_extract(df, "raw", pattern).collect()}


def test_library_is_complete_and_compiles(spark):
    library = builtin_library()
    assert len(library) == 185
    probes = [F.lit("x").rlike(Grok(f"%{{{name}}}").search_regex).alias(name) for name in library]
    for start in range(0, len(probes), 40):
        assert spark.range(1).select(*probes[start : start + 40]).collect()


def test_every_preset_compiles_with_fields():
    for name in L.PRESETS:
        assert L.preset(name).fields, name
    assert sum(len(numbers) for numbers in L.FIREWALL_LAYOUTS.values()) == 36
    with pytest.raises(ValueError):
        L.preset("NO_SUCH_FORMAT")


def test_web_log(spark):
    rows = _parse(
        spark,
        "COMBINEDAPACHELOG",
        '10.1.2.3 - bob [10/Oct/2000:13:55:36 -0700] "GET /a?b=c HTTP/1.0" 200 2326 "http://r/" "M 5"',
        'example.com - - [10/Oct/2000:13:55:36 -0700] "GET /x" 404 - "-" "-"',
        "not a request",
        "",
        None,
    )
    assert set(rows) == {0, 1}
    assert rows[0]["request"] == "/a?b=c" and rows[0]["bytes"] == "2326" and rows[0]["agent"] == '"M 5"'
    assert rows[1]["bytes"] is None and rows[1]["httpversion"] is None and rows[1]["clientip"] == "example.com"


def test_unmatched_is_the_complement(spark):
    df = spark.createDataFrame([("1 a",), ("b",), ("",), (None,)], "raw string")
    assert [r.raw for r in L.grok_extract(df, "raw", "%{INT:n} %{WORD:w}").collect()] == ["1 a"]
    assert {r.raw for r in L.grok_unmatched(df, "raw", "%{INT:n} %{WORD:w}").collect()} == {"b", "", None}


def test_one_line_per_format(spark):
    samples = {
        "SYSLOGLINE": ("Mar  5 01:02:03 web1 sshd[77]: hello there", {"program": "sshd", "pid": "77", "message": "hello there"}),
        "SYSLOG5424LINE": ("<34>1 2003-10-11T22:14:15Z h su - ID47 - failed", {"syslog5424_app": "su", "syslog5424_proc": None, "syslog5424_msg": "failed"}),
        "SYSLOGPAMSESSION": (
            "Mar  5 01:02:03 h su[1]: pam_unix(su:session): session opened for user bob by (uid=0)",
            {"pam_module": "pam_unix", "username": "bob", "pam_by": "(uid=0)"},
        ),
        "CRONLOG": ("Mar  5 01:02:03 h CRON[9]: (root) CMD (run x)", {"user": "root", "action": "CMD", "message": "run x"}),
        "JAVASTACKTRACEPART": ("  at a.b.C$D.run(C.java:12)", {"class": "a.b.C$D", "method": "run", "line": "12"}),
        "RT_FLOW3": (
            "RT_FLOW_SESSION_DENY: session denied 10.0.0.1/5->10.0.0.2/53 junos-dns 17(0) p1 a b UNKNOWN",
            {"src-ip": "10.0.0.1", "policy-name": "p1", "to-zone": "b"},
        ),
        "MCOLLECTIVEAUDIT": ("2010-12-28T17:09:03+0000: reqid=1", {"timestamp": "2010-12-28T17:09:03+0000"}),
        "MONGO_SLOWQUERY": (
            "query my-db.c query: { a: 1 } ntoreturn: } ntoreturn:0 ntoskip:0 nscanned:7 x nreturned:1 reslen:2 123ms",
            {"database": "my-db", "nscanned": "7", "duration": "123"},
        ),
        "NAGIOSLOGLINE": ("[1] SERVICE ALERT: h;s;CRITICAL;HARD;3;msg", {"nagios_type": "SERVICE ALERT", "nagios_message": "msg"}),
        "POSTGRESQL": ("03/05/2014 10:11:12 UTC bob conn 42", {"user_id": "bob", "pid": "42"}),
        "REDISLOG": ("[123] 01 Jan 10:11:12 * Saving", {"pid": "123", "timestamp": "01 Jan 10:11:12"}),
        "RUBY_LOGGER": ("I, [2014-03-05T10:11:12.5 #7]  INFO -- main: up", {"pid": "7", "loglevel": "INFO", "message": "up"}),
    }
    for name, (line, expected) in samples.items():
        found = _parse(spark, name, line, "zzz")
        assert set(found) == {0}, name
        assert {k: found[0][k] for k in expected} == expected, name


def test_header_captures_can_be_overridden(spark):
    line = (
        'Feb  6 12:14:14 lb haproxy[14389]: 10.0.1.2:33317 [06/Feb/2009:12:14:14.655] in st/srv1 10/0/30/69/109 200 2750 - - ----'
        ' 1/1/1/1/0 0/0 {1wt.eu|me} {} "GET /index.html HTTP/1.1"'
    )
    override = {"HAPROXYCAPTUREDREQUESTHEADERS": r"%{DATA:request_host}\|%{DATA:request_agent}"}
    found = _parse(spark, Grok("%{HAPROXYHTTP}", override), line)[0]
    assert found["request_host"] == "1wt.eu" and found["request_agent"] == "me" and found["http_request"] == "/index.html"
    assert "captured_request_headers" not in found


def test_firewall_dispatch(spark):
    lines = [
        "<166>Mar 05 01:02:03 fw: %ASA-6-302010: 5 in use, 9 most used",
        "<166>Mar 05 01:02:03: %ASA-6-999999: something new",
        "no tag",
    ]
    df = spark.createDataFrame([(line,) for line in lines], "raw string")
    rows = {r.ciscotag: r.fields for r in L.firewall_messages(df, "raw").collect()}
    assert rows == {"ASA-6-302010": {"connection_count": "5", "connection_count_max": "9"}, "ASA-6-999999": None}


def test_library_files(spark, tmp_path):
    path = tmp_path / "patterns"
    path.write_text("# comment\n\nCODE [A-Z]{2}\\d+\nPAIR %{CODE:left}-%{CODE:right}\n")
    library = load_library(str(path))
    assert library["CODE"] == r"[A-Z]{2}\d+" and "IPV4" in library
    assert _parse(spark, Grok("%{PAIR}", library), "AB1-CD22")[0] == {"left": "AB1", "right": "CD22"}
    assert parse_library("A  two blanks") == {"A": " two blanks"}


def test_compiler_rules(spark):
    assert _parse(spark, "(a)(?<x>b+)(c|d)%{INT:num:int}", "zabbd7")[0] == {"x": "bb", "num": 7}
    assert _parse(spark, Grok(r"[(\])]%{WORD:w}"), "]word")[0] == {"w": "word"}
    assert _parse(spark, "%{WORD:w}=%{INT:w}", "k=5", "=5")[0] == {"w": "k"}
    assert _parse(spark, "%{WORD}", "word")[0] == {"matched": True}
    lazy = "k=%{DATA:v}"
    assert _parse(spark, lazy, "k=abc")[0] == {"v": None}
    assert _parse(spark, Grok(lazy, full_match=True), "k=abc", "xk=abc") == {0: {"v": "abc"}}
    for bad in ("%{NOPE:x}", r"(a)\1", "%{INT:n:date}"):
        with pytest.raises(ValueError):
            Grok(bad)
    with pytest.raises(ValueError):
        Grok("%{LOOP}", {"LOOP": "x%{LOOP}"})


def test_separator_characters_in_the_text(spark):
    text = "a\u0001\u0002\u0001\u0001\u0002b|c\u0002\u0001\u0002"
    assert _parse(spark, r"%{NOTSPACE:x}\|%{NOTSPACE:y}", text)[0] == dict(zip("xy", text.split("|")))


def test_iso_dates(spark):
    df = spark.createDataFrame([("05/Mar/2014:10:11:12 +0200",), ("bad",), (None,)], "d string")
    good, bad = L.with_iso_date(df, "d", "dd/MMM/yyyy:HH:mm:ss Z", "t")
    assert {r.d: r.t for r in good.collect()} == {"05/Mar/2014:10:11:12 +0200": "2014-03-05T08:11:12.000Z", None: None}
    assert [(r.d, r.error) for r in bad.collect()] == [("bad", "unreadable date in d")]
    with pytest.raises(ValueError):
        L.with_iso_date(df, "d", "", "t")


def test_long_texts_do_not_exhaust_the_stack(spark):
    n = 20000
    texts = {
        "HOSTNAME": "a." * n, "JAVACLASS": "a." * n + "B", "URIPATH": "/a" * n, "UNIXPATH": "/a" * n, "WINPATH": "C:" + "\\a" * n,
        "QUOTEDSTRING": '"' + '\\"a' * n + '"', "CISCO_REASON": "some words " * n, "GREEDYDATA": "x" * n,
    }
    for name, text in texts.items():
        df = spark.createDataFrame([(text,)], "t string")
        assert [r.token for r in L.extract_all_tokens(df, "t", name, []).collect()][0] == text, name


def test_rewritten_patterns_match_as_the_originals(spark):
    originals = {
        "HOSTNAME": r"\b(?:[0-9A-Za-z][0-9A-Za-z-]{0,62})(?:\.(?:[0-9A-Za-z][0-9A-Za-z-]{0,62}))*(\.?|\b)",
        "WINPATH": r"(?>[A-Za-z]+:|\\)(?:\\[^\\?*]*)+",
        "URIPATH": r"(?:/[A-Za-z0-9$.+!*'(){},~:;=@#%_\-]*)+",
        "JAVACLASS": r"(?:[a-zA-Z0-9-]+\.)+[A-Za-z0-9$_]+",
        "CISCO_REASON": r"Duplicate TCP SYN|Failed to locate egress interface|Invalid transport field|No matching connection|DNS Response|DNS Query|(?:%{WORD}\s*)*",
        "QUOTEDSTRING": r"""(?>(?<!\\)(?>"(?>\\.|[^\\"]+)+"|""|(?>'(?>\\.|[^\\']+)+')|''|(?>`(?>\\.|[^\\`]+)+`)|``))""",
    }
    texts = [
        "a.b-c.d..e -x.y 10.0.0.1:80 web-1.example.com. end", r"C:\a\b c?d \\srv\x* E:\\", "//a/b//c?x /d(e) f/g",
        "at a.b.C$D.run(X.java:1) a..b .c.d x-y.z", "no more words (u1) DNS Query é word-word  ", r"""say "a\"b" 'c' `` "" '\'' "open""",
        "http://u:p@h.x/a/b;c?d=e#f",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for name, original in originals.items():
        for follower in ("", r"\.", " ", r"\w", "/"):
            now, then = Grok(f"%{{{name}}}{follower}").regex, Grok(f"%{{OLD}}{follower}", {"OLD": original}).regex
            row = df.select(
                F.regexp_extract_all("t", F.lit(now), F.lit(0)).alias("now"), F.regexp_extract_all("t", F.lit(then), F.lit(0)).alias("then")
            )
            assert all(r.now == r.then for r in row.collect()), (name, follower)


def test_tokens(spark):
    text = "ip 10.0.0.1, 300.1.1.1 and 1.2.3.4.5; id 123e4567-e89b-12d3-a456-426614174000; mac 00:1B:44:11:3A:B7"
    df = spark.createDataFrame([(text,)], "t string")

    def found(name):
        return [r.token for r in L.extract_all_tokens(df, "t", name, []).collect()]

    assert "10.0.0.1" in found("IPV4") and "300.1.1.1" not in found("IPV4")
    assert found("UUID") == ["123e4567-e89b-12d3-a456-426614174000"]
    assert found("MAC") == ["00:1B:44:11:3A:B7"]


def test_envelopes_of_all_lines_have_all_fields(spark):
    from registry import ingest
    from registry import log_lines as lines
    from registry.common import events

    sf_dir = "/root/testdata/sf0.001"
    want = lines.fields_of(lines.WEB_COMMON)
    expected = events(spark, sf_dir).selectExpr(*(f"coalesce({sql}, '') AS {name}" for name, sql in want.items()))
    found = [{f["name"]: f["value"] for f in json.loads(r.fields)} for r in ingest.web_envelopes(spark, sf_dir).selectExpr("to_json(fields) AS fields").collect()]
    rows = [{k: str(v) for k, v in f.items()} for f in found]
    assert any(not r["verb"] for r in rows) and any(not r["bytes"] for r in rows)
    assert sorted(tuple(r[k] for k in want) for r in rows) == sorted(tuple(r) for r in expected.collect())
