"""Log lines written from event columns, so that SQL knows what a parser must find in them.

A line is a list of parts: plain text, or ``(field, expression)``, or ``(field, expression in the
line, expected value)`` for optional fields. Expressions mean the same in Spark SQL and DuckDB.
"""

from __future__ import annotations

Part = str | tuple[str, str] | tuple[str, str, str]

_TWO = "lpad(cast({0}(ts) as string), 2, '0')"
HOUR, MINUTE, SECOND, DAY = (_TWO.format(f) for f in ("hour", "minute", "second", "day"))
MONTH_NO = _TWO.format("month")
YEAR = "cast(year(ts) as string)"
MONTH = "substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(month(ts) as int) * 3 - 2, 3)"
CLOCK = f"{HOUR} || ':' || {MINUTE} || ':' || {SECOND}"
SYSLOG_TIME = f"{MONTH} || ' ' || {DAY} || ' ' || {CLOCK}"
ISO_TIME = f"{YEAR} || '-' || {MONTH_NO} || '-' || {DAY} || 'T' || {CLOCK} || 'Z'"
HTTP_TIME = f"{DAY} || '/' || {MONTH} || '/' || {YEAR} || ':' || {CLOCK} || ' +0000'"

EVENT = "cast(event_id as string)"
USER = "cast(user_id as string)"
KIND = "event_type"


def number(column: str, modulus: int, plus: int = 0) -> str:
    return f"cast({column} % {modulus} + {plus} as string)"


def ip(column: str, net: int = 10) -> str:
    return f"'{net}.' || {number(column, 200)} || '.' || {number(column, 250, 1)} || '.' || {number(column, 199, 1)}"


def maybe(expression: str, condition: str, absent: str = "''") -> tuple[str, str]:
    """An optional piece: what the line shows, and the value (or NULL) to expect."""
    return (
        f"case when {condition} then {expression} else {absent} end",
        f"case when {condition} then {expression} end",
    )


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def line_of(parts: list[Part]) -> str:
    return " || ".join(literal(p) if isinstance(p, str) else f"({p[1]})" for p in parts)


def fields_of(parts: list[Part]) -> dict[str, str]:
    return {p[0]: p[-1] for p in parts if not isinstance(p, str) and p[0]}


HOST = "'host' || " + number("user_id", 20)
PROGRAM = "'app.' || event_type"
SRC, DST = ip("event_id"), ip("user_id", 172)
SPORT, DPORT = number("event_id", 60000, 1024), number("user_id", 1000, 1)

WEB_REQUEST, WEB_REQUEST_FOUND = maybe(f"'/item/' || {EVENT} || '?k=' || {USER}", "event_id % 9 <> 0")
WEB_COMMON: list[Part] = [
    ("clientip", SRC), " ", ("ident", "'-'"), " ", ("auth", "'user' || " + USER), " [", ("timestamp", HTTP_TIME), '] "',
    ("verb", "case when event_id % 9 <> 0 then 'GET' else '' end", "case when event_id % 9 <> 0 then 'GET' end"),
    ("", "case when event_id % 9 <> 0 then ' ' else '' end"),
    ("request", WEB_REQUEST, WEB_REQUEST_FOUND),
    ("", "case when event_id % 9 <> 0 then ' HTTP/' else '' end"),
    ("httpversion", "case when event_id % 9 <> 0 then '1.1' else '' end", "case when event_id % 9 <> 0 then '1.1' end"),
    ("rawrequest", *maybe("'?? ' || event_type", "event_id % 9 = 0")),
    '" ', ("response", number("event_id", 400, 100)), " ",
    ("bytes", *maybe(EVENT, "event_id % 4 <> 0", "'-'")),
]
WEB_COMBINED: list[Part] = [
    *WEB_COMMON, " ", ("referrer", "'\"http://ref.example/' || " + USER + " || '\"'"), " ",
    ("agent", "'\"Agent/1.0 (' || event_type || ')\"'"),
]

_PREFIX: list[Part] = [("timestamp", SYSLOG_TIME), " ", ("logsource", HOST), " ", ("program", PROGRAM)]
_PID: list[Part] = ["[", ("pid", number("event_id", 9000, 1)), "]"]
SYSLOG_LINE: list[Part] = [*_PREFIX, *_PID, ": ", ("message", "event_type || ' by user ' || " + USER)]
SYSLOG_LINE_ISO: list[Part] = [
    ("timestamp8601", ISO_TIME), " <", ("facility", number("user_id", 24)), ".", ("priority", number("event_id", 8)),
    "> ", ("logsource", HOST), " ", ("program", PROGRAM), ": ", ("message", "event_type || '; ' || " + EVENT),
]
_PAM_BY, _PAM_BY_FOUND = maybe(f"'root(uid=' || {USER} || ')'", "event_id % 2 = 0")
SYSLOG_PAM: list[Part] = [
    *_PREFIX, *_PID, ": ",
    ("message", "'pam_unix(sshd:session): session opened for user u' || " + USER
        + " || case when event_id % 2 = 0 then ' by root(uid=' || " + USER + " || ')' else '' end"),
]
# The message is what the other fields are cut from: they add nothing to the line.
SYSLOG_PAM_INNER = {
    "pam_module": "'pam_unix'", "pam_caller": "'sshd:session'", "pam_session_state": "'opened'",
    "username": "'u' || " + USER, "pam_by": _PAM_BY_FOUND,
}
CRON: list[Part] = [
    *_PREFIX, *_PID, ": (", ("user", "'u' || " + USER), ") ", ("action", "'CMD'"), " (",
    ("message", "'run ' || event_type || ' ' || " + EVENT), ")",
]
SYSLOG_5424: list[Part] = [
    "<", ("syslog5424_pri", number("event_id", 191)), ">", ("syslog5424_ver", "'1'"), " ",
    ("syslog5424_ts", *maybe(ISO_TIME, "event_id % 5 <> 0", "'-'")), " ", ("syslog5424_host", HOST), " ",
    ("syslog5424_app", *maybe(PROGRAM, "event_id % 3 <> 0", "'-'")), " ", ("syslog5424_proc", EVENT), " ",
    ("syslog5424_msgid", "'ID' || " + USER), " ",
    ("syslog5424_sd", *maybe("'[x@1 k=\"' || event_type || '\"]'", "event_id % 2 = 0", "'-'")), " ",
    ("syslog5424_msg", "event_type || ' happened'"),
]
NETSCREEN: list[Part] = [
    ("date", SYSLOG_TIME), " ", ("device", HOST), " fw1: NetScreen device_id=", ("device_id", "'ns' || " + USER),
    "  [Root]system-notification-00257(traffic): start_time=", ("start_time", f"'\"' || {CLOCK} || '\"'"),
    " duration=", ("duration", number("event_id", 500)), " policy_id=", ("policy_id", number("user_id", 50)),
    " service=", ("service", "event_type"), " proto=", ("proto", number("event_id", 17)),
    " src zone=", ("src_zone", "'Trust'"), " dst zone=", ("dst_zone", "'Untrust'"), " action=", ("action", "'Permit'"),
    " sent=", ("sent", EVENT), " rcvd=", ("rcvd", USER), " src=", ("src_ip", SRC), " dst=", ("dst_ip", DST),
    " src_port=", ("src_port", SPORT), " dst_port=", ("dst_port", DPORT), " src-xlated ip=", ("src_xlated_ip", SRC),
    " port=", ("src_xlated_port", SPORT), " dst-xlated ip=", ("dst_xlated_ip", DST), " port=",
    ("dst_xlated_port", DPORT), " session_id=", ("session_id", EVENT), " reason=", ("reason", "'Close - ' || event_type"),
]

_HAP_TIME = f"{DAY} || '/' || {MONTH} || '/' || {YEAR} || ':' || {CLOCK} || '.123'"
_HAP_INNER = {
    "haproxy_monthday": DAY, "haproxy_month": MONTH, "haproxy_year": YEAR, "haproxy_time": CLOCK, "haproxy_hour": HOUR,
    "haproxy_minute": MINUTE, "haproxy_second": SECOND, "haproxy_milliseconds": "'123'",
}
_HAP_START: list[Part] = [
    ("syslog_timestamp", SYSLOG_TIME), " ", ("syslog_server", HOST), " ", ("program", "'haproxy'"),
    "[", ("pid", number("event_id", 9000, 1)), "]: ", ("client_ip", SRC), ":", ("client_port", SPORT), " [",
    ("accept_date", _HAP_TIME), "] ", ("frontend_name", "'fe-' || event_type"), " ", ("backend_name", "'be'"), "/",
    ("server_name", HOST), " ",
]
_HAP_COUNTS: list[Part] = [
    ("actconn", number("event_id", 7)), "/", ("feconn", number("event_id", 5)), "/", ("beconn", number("event_id", 3)),
    "/", ("srvconn", number("event_id", 2)), "/", ("retries", "'+0'"), " ", ("srv_queue", number("user_id", 9)), "/",
    ("backend_queue", number("user_id", 4)),
]
HAPROXY_HTTP: list[Part] = [
    *_HAP_START, ("time_request", number("event_id", 100)), "/", ("time_queue", "'0'"), "/",
    ("time_backend_connect", number("user_id", 30)), "/", ("time_backend_response", "'-1'"), "/",
    ("time_duration", "'+' || " + EVENT), " ", ("http_status_code", number("event_id", 400, 100)), " ",
    ("bytes_read", EVENT), " ", ("captured_request_cookie", "'-'"), " ", ("captured_response_cookie", "'-'"), " ",
    ("termination_state", "'----'"), " ", *_HAP_COUNTS, " {", ("captured_request_headers", "'h1|' || event_type"), "} {",
    ("captured_response_headers", "'text/html'"), '} "', ("http_verb", "'GET'"), " ",
    ("http_request", "'/a/' || " + EVENT + " || '?u=' || " + USER), " HTTP/", ("http_version", "'1.1'"), '"',
]
HAPROXY_TCP: list[Part] = [
    *_HAP_START, ("time_queue", "'0'"), "/", ("time_backend_connect", number("user_id", 30)), "/",
    ("time_duration", EVENT), " ", ("bytes_read", USER), " ", ("termination_state", "'--'"), " ", *_HAP_COUNTS,
]
JAVA_FRAME: list[Part] = [
    "  at ", ("class", "'org.example.' || event_type || '.Task$Inner'"), ".", ("method", "'run' || " + USER), "(",
    ("file", "'Task-' || event_type || '.java'"), ":", ("line", number("event_id", 900, 1)), ")",
]
_FLOW: list[Part] = [
    ("src-ip", SRC), "/", ("src-port", SPORT), "->", ("dst-ip", DST), "/", ("dst-port", DPORT), " ",
    ("service", "'junos-' || event_type"), " ",
]
_FLOW_NAT: list[Part] = [
    ("nat-src-ip", SRC), "/", ("nat-src-port", SPORT), "->", ("nat-dst-ip", DST), "/", ("nat-dst-port", DPORT), " ",
    ("src-nat-rule-name", "'None'"), " ", ("dst-nat-rule-name", "'None'"), " ",
]
_FLOW_END: list[Part] = [
    ("policy-name", "'pol' || " + number("user_id", 9)), " ", ("from-zone", "'trust'"), " ", ("to-zone", "'untrust'"),
]
FLOW_CLOSE: list[Part] = [
    ("event", "'RT_FLOW_SESSION_CLOSE'"), ": ", ("close-reason", "'session closed ' || event_type"), ": ", *_FLOW,
    *_FLOW_NAT, ("protocol-id", "'6'"), " ", *_FLOW_END, " ", ("session-id", EVENT), " 12(",
    ("sent", number("event_id", 4000)), ") 9(", ("received", number("user_id", 4000)), ") ",
    ("elapsed-time", number("event_id", 60)), " UNKNOWN",
]
FLOW_CREATE: list[Part] = [
    ("event", "'RT_FLOW_SESSION_CREATE'"), ": session created ", *_FLOW, *_FLOW_NAT, ("protocol-id", "'17'"), " ",
    *_FLOW_END, " ", ("session-id", EVENT), " N/A",
]
FLOW_DENY: list[Part] = [
    ("event", "'RT_FLOW_SESSION_DENY'"), ": session denied ", *_FLOW, ("protocol-id", "'1'"), "(8) ", *_FLOW_END, " UNKNOWN",
]
_LEVEL = "case event_id % 4 when 0 then 'INFO' when 1 then 'WARN' when 2 then 'ERROR' else 'DEBUG' end"
MCOLLECTIVE: list[Part] = [
    "I, [", ("timestamp", ISO_TIME), " #", ("pid", number("event_id", 9000, 1)), "]  ", ("event_level", _LEVEL),
    " -- : plugin loaded",
]
MCOLLECTIVE_AUDIT: list[Part] = [("timestamp", ISO_TIME), ": reqid=abc caller=cert"]
MONGO: list[Part] = [
    ("timestamp", SYSLOG_TIME), " [", ("component", "'conn' || " + USER), "] ",
    ("message", "'end connection ' || " + EVENT),
]
MONGO_SLOW: list[Part] = [
    "query ", ("database", "'db-' || event_type"), ".", ("collection", "'col' || " + USER), " query: ",
    ("query", "'{ k: ' || " + EVENT + " || ' } ntoreturn: }'"), " ntoreturn:", ("ntoreturn", "'0'"), " ntoskip:",
    ("ntoskip", number("event_id", 9)), " nscanned:", ("nscanned", EVENT), " keyUpdates:0 locks(micros) nreturned:",
    ("nreturned", number("event_id", 40, 10)), " reslen:20 ", ("duration", number("event_id", 900, 100)), "ms",
]
POSTGRES: list[Part] = [
    ("timestamp", f"{MONTH_NO} || '/' || {DAY} || '/' || {YEAR} || ' ' || {CLOCK}"), " UTC ",
    ("user_id", "'u' || cast(user_id as string)"), " ", ("connection_id", "'c.' || " + EVENT), " ",
    ("pid", number("event_id", 9000, 1)),
]
REDIS: list[Part] = [
    "[", ("pid", number("event_id", 9000, 1)), "] ", ("timestamp", f"{DAY} || ' ' || {MONTH} || ' ' || {CLOCK}"),
    " * 1 changes in 900 seconds. Saving...",
]
RUBY: list[Part] = [
    "I, [", ("timestamp", ISO_TIME), " #", ("pid", number("event_id", 9000, 1)), "]  ", ("loglevel", _LEVEL), " -- ",
    ("progname", "'rails'"), ": ", ("message", "event_type || ' ' || " + EVENT),
]

_N = ("nagios_hostname", HOST)
_NS = ("nagios_service", "'svc ' || event_type")
_NST = ("nagios_state", "case when event_id % 2 = 0 then 'OK' else 'CRITICAL' end")
_NM = ("nagios_message", "event_type || ' ' || " + EVENT)
_NC = ("nagios_comment", "'comment ' || " + USER)
_NATT = ("nagios_attempt", number("event_id", 5, 1))
_NLEV = ("nagios_statelevel", "'HARD'")


def _nagios(kind: str, *rest: Part, typed: bool = True) -> list[Part]:
    head = ("nagios_type", literal(kind)) if typed else kind
    return ["[", ("nagios_epoch", number("event_id", 100000, 1400000000)), "] ", head, ": ", *rest]


def _command(command: str, *rest: Part) -> list[Part]:
    return _nagios("EXTERNAL COMMAND", ("nagios_command", literal(command)), ";", *rest)


def _joined(*parts: Part) -> list[Part]:
    out: list[Part] = []
    for part in parts:
        out += [";", part] if out else [part]
    return out


NAGIOS: list[list[Part]] = [
    ["[", ("nagios_epoch", number("event_id", 100000, 1400000000)), "] Warning: ", _NM],
    _nagios("CURRENT SERVICE STATE", *_joined(_N, _NS, _NST, ("nagios_statetype", "'HARD'"), ("nagios_statecode", "'1'"), _NM)),
    _nagios("CURRENT HOST STATE", *_joined(_N, _NST, ("nagios_statetype", "'HARD'"), ("nagios_statecode", "'1'"), _NM)),
    _nagios("SERVICE NOTIFICATION", *_joined(("nagios_notifyname", "'ops'"), _N, _NS, _NST, ("nagios_contact", "'mail'"), _NM)),
    _nagios("HOST NOTIFICATION", *_joined(("nagios_notifyname", "'ops'"), _N, _NST, ("nagios_contact", "'mail'"), _NM), typed=False),
    _nagios("SERVICE ALERT", *_joined(_N, _NS, _NST, _NLEV, _NATT, _NM)),
    _nagios("HOST ALERT", *_joined(_N, _NST, _NLEV, _NATT, _NM)),
    _nagios("SERVICE FLAPPING ALERT", *_joined(_N, _NS, _NST, _NM)),
    _nagios("HOST FLAPPING ALERT", *_joined(_N, _NST, _NM)),
    _nagios("SERVICE DOWNTIME ALERT", *_joined(_N, _NS, _NST, _NC)),
    _nagios("HOST DOWNTIME ALERT", *_joined(_N, _NST, _NC)),
    _nagios("PASSIVE SERVICE CHECK", *_joined(_N, _NS, _NST, _NC)),
    _nagios("PASSIVE HOST CHECK", *_joined(_N, _NST, _NC)),
    _nagios("SERVICE EVENT HANDLER", *_joined(_N, _NS, _NST, _NLEV, ("nagios_event_handler_name", "'restart'"))),
    _nagios("HOST EVENT HANDLER", *_joined(_N, _NST, _NLEV, ("nagios_event_handler_name", "'restart'"))),
    [*_nagios("TIMEPERIOD TRANSITION", *_joined(_NS, ("nagios_unknown1", "'0'"), ("nagios_unknown2", "'1'"))), ";"],
    _command("DISABLE_SVC_CHECK", *_joined(_N, _NS)),
    _command("ENABLE_SVC_CHECK", *_joined(_N, _NS)),
    _command("DISABLE_HOST_CHECK", _N),
    _command("ENABLE_HOST_CHECK", _N),
    _command("PROCESS_HOST_CHECK_RESULT", *_joined(_N, _NST, ("nagios_check_result", "'ping ' || " + USER))),
    _command("PROCESS_SERVICE_CHECK_RESULT", *_joined(_N, _NS, _NST, ("nagios_check_result", "'ping ' || " + USER))),
    _command(
        "SCHEDULE_HOST_DOWNTIME",
        *_joined(
            _N, ("nagios_start_time", EVENT), ("nagios_end_time", USER), ("nagios_fixed", "'1'"),
            ("nagios_trigger_id", "'0'"), ("nagios_duration", "'7200'"), ("author", "'ops'"), ("comment", "'planned work'"),
        ),
    ),
]

_SI, _DI = ("src_interface", "'inside'"), ("dst_interface", "'outside'")
_SIP, _DIP, _SP, _DP = ("src_ip", SRC), ("dst_ip", DST), ("src_port", SPORT), ("dst_port", DPORT)
_ACT, _DIR, _PROTO = ("action", "'Deny'"), ("direction", "'inbound'"), ("protocol", "'tcp'")
_SRC: list[Part] = [_SI, ":", _SIP, "/", _SP]
_DST: list[Part] = [_DI, ":", _DIP, "/", _DP]
_FWUSER: list[Part] = ["(", ("src_fwuser", "'LOCAL-' || event_type"), ")"]

# The optional reason of 302013 matches the empty text before a user, which is then not captured.
FIREWALL: dict[str, list[Part]] = {
    "106001": [("direction", "'Inbound'"), " ", ("protocol", "'TCP'"), " connection ", ("action", "'denied'"), " from ", _SIP,
               "/", _SP, " to ", _DIP, "/", _DP, " flags ", ("tcp_flags", "'SYN'"), " on interface ", ("interface", "'outside'")],
    "106006": [_ACT, " ", _DIR, " ", ("protocol", "'UDP'"), " from ", _SIP, "/", _SP, *_FWUSER, " to ", _DIP, "/", _DP, " due to ",
               ("reason", "'DNS Query'")],
    "106014": [_ACT, " ", _DIR, " ", ("protocol", "'icmp'"), " src ", _SI, ":", _SIP, " dst ", _DI, ":", _DIP, " (type ",
               ("icmp_type", "'8'"), ", code ", ("icmp_code", "'0'"), ")"],
    "106015": [_ACT, " ", _PROTO, " (", ("policy_id", "'no connection'"), ") from ", _SIP, "/", _SP, " to ", _DIP, "/", _DP,
               " flags ", ("tcp_flags", "'RST ACK'"), "  on interface ", ("interface", "'inside'")],
    "106021": [_ACT, " ", _PROTO, " reverse path check from ", _SIP, " to ", _DIP, " on interface ", ("interface", "'dmz'")],
    "106023": [_ACT, " ", _PROTO, " src ", *_SRC, " dst ", *_DST, " by access-group ", ("policy_id", "'acl_out'"), " [",
               ("hashcode1", "'0x8ed66b60'"), ", ", ("hashcode2", "'0xf8852875'"), "]"],
    "106100": ["access-list ", ("policy_id", "'acl' || " + USER), " ", ("action", "'permitted'"), " ", _PROTO, " ", _SI, "/", _SIP,
               "(", _SP, ")", *_FWUSER, " -> ", _DI, "/", _DIP, "(", _DP, ") hit-cnt ", ("hit_count", EVENT), " ",
               ("interval", "case when event_id % 2 = 0 then 'first hit' else '300-second interval' end"), " [",
               ("hashcode1", "'0x1'"), ", ", ("hashcode2", "'0x2'"), "]"],
    "110002": [("reason", "'Failed to locate egress interface'"), " for ", _PROTO, " from ", *_SRC, " to ", _DIP, "/", _DP],
    "302010": [("connection_count", EVENT), " in use, ", ("connection_count_max", number("event_id", 1000, 100000)), " most used"],
    "302013": [("action", "'Built'"), " ", ("direction", "'inbound'"), " ", ("protocol", "'TCP'"), " connection ",
               ("connection_id", EVENT), " for ", *_SRC, " (", ("src_mapped_ip", SRC), "/", ("src_mapped_port", SPORT), ") to ",
               *_DST, " (", ("dst_mapped_ip", DST), "/", ("dst_mapped_port", DPORT), ")", ("", "' (u' || " + USER + " || ')'")],
    "302014": [("action", "'Teardown'"), " ", ("protocol", "'TCP'"), " connection ", ("connection_id", EVENT), " for ", *_SRC, " to ",
               *_DST, " duration ", ("duration", CLOCK), " bytes ", ("bytes", EVENT), " ", ("reason", "'TCP FINs'")],
    "302020": [("action", "'Built'"), " ", ("direction", "'outbound'"), " ", ("protocol", "'ICMP'"), " connection for faddr ", _DIP,
               "/", ("icmp_seq_num", "'0'"), " gaddr ", ("src_xlated_ip", SRC), "/", ("icmp_code_xlated", "'1'"), " laddr ", _SIP,
               "/", ("icmp_code", "'2'")],
    "305011": [("action", "'Built'"), " ", ("xlate_type", "'dynamic'"), " ", ("protocol", "'TCP'"), " translation from ", *_SRC,
               " to ", ("src_xlated_interface", "'outside'"), ":", ("src_xlated_ip", DST), "/"],
    "313001": [("action", "'Denied'"), " ", ("protocol", "'ICMP'"), " type=", ("icmp_type", "'5'"), ", code=", ("icmp_code", "'1'"),
               " from ", _SIP, " on interface "],
    "313005": [("reason", "'No matching connection'"), " for ", ("protocol", "'ICMP'"), " error message: ", ("err_protocol", "'icmp'"),
               " src ", ("err_src_interface", "'outside'"), ":", ("err_src_ip", SRC), " dst ", ("err_dst_interface", "'inside'"), ":",
               ("err_dst_ip", DST), " (type ", ("err_icmp_type", "'3'"), ", code ", ("err_icmp_code", "'3'"), ") on ",
               ("interface", "'outside'"), " interface.  Original IP payload: udp src ", ("orig_src_ip", DST), "/",
               ("orig_src_port", DPORT), " dst ", ("orig_dst_ip", SRC), "/", ("orig_dst_port", SPORT)],
    "402117": [("protocol", "'IPSEC'"), ": Received a non-IPSec packet (protocol= ", ("orig_protocol", "'esp'"), ") from ", _SIP,
               " to ", _DIP],
    "402119": [("protocol", "'IPSEC'"), ": Received an ", ("orig_protocol", "'ESP'"), " packet (SPI= ", ("spi", "'0xDEAD'"),
               ", sequence number= ", ("seq_num", EVENT), ") from ", _SIP, " (user= ", ("user", "'u' || " + USER), ") to ", _DIP,
               " that failed anti-replay checking"],
    "419001": [("action", "'Dropping'"), " ", ("protocol", "'TCP'"), " packet from ", *_SRC, " to ", *_DST, ", reason: ",
               ("reason", "'MSS exceeded, ' || event_type")],
    "419002": [("reason", "'Duplicate TCP SYN'"), " from ", *_SRC, " to ", *_DST, " with different initial sequence number"],
    "500004": [("reason", "'Invalid transport field'"), " for protocol=", ("protocol", "'UDP'"), ", from ", _SIP, "/", _SP, " to ",
               _DIP, "/", _DP],
    "602303": [("protocol", "'IPSEC'"), ": An ", ("direction", "'outbound'"), " ", ("tunnel_type", "'LAN-to-LAN'"), " SA (SPI= ",
               ("spi", "'0xBEEF'"), ") between ", _SIP, " and ", _DIP, " (user= ", ("user", "'u' || " + USER), ") has been ",
               ("action", "'created'")],
    "710003": [("protocol", "'TCP'"), " access ", ("action", "'denied by ACL'"), " from ", _SIP, "/", _SP, " to ", *_DST],
    "713172": ["Group = ", ("group", "'g' || " + USER), ", IP = ", _SIP,
               ", Automatic NAT Detection Status:     Remote end ", ("is_remote_natted", "'is NOT'"),
               "behind a NAT device     This   end ", ("is_local_natted", "'IS'"), "behind a NAT device"],
    "733100": ["[ ", ("drop_type", "'Scanning'"), "] drop ", ("drop_rate_id", "'rate-1'"), " exceeded. Current burst rate is ",
               ("drop_rate_current_burst", number("event_id", 90)), " per second, max configured rate is ",
               ("drop_rate_max_burst", "'10'"), "; Current average rate is ", ("drop_rate_current_avg", number("user_id", 90)),
               " per second, max configured rate is ", ("drop_rate_max_avg", "'5'"), "; Cumulative total count is ",
               ("drop_total_count", EVENT)],
}
