"""Syslog headers as column expressions: parse, strip, tag, decode and encode."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

R5424 = r"(?s)^<([0-9]*)>[0-9]+ (?:[^ ]* ){5}(?:-|\[[^\]]*\]) ?(.*)$"
R3164 = (
    r"(?s)^<([0-9]*)>(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) {1,2}[0-9]{1,2} "
    r"[0-9]{2}:[0-9]{2}:[0-9]{2} [^ ]+ .*?: (.*)$"
)
#: RFC 5424 without the demand that the line starts with the priority.
LENIENT_5424 = r"(?s)^[^>]*>[0-9]+ (?:[^ ]* ){5}(?:-|\[[^\]]*\]) ?(.*)$"
#: What stands before the message; of a line with both headers the first of the two.
HEAD_5424, HEAD_3164, HEAD_LENIENT = (p.removesuffix("(.*)$") for p in (R5424, R3164, LENIENT_5424))
HEAD = f"{HEAD_5424}|{HEAD_3164}"
BLANKS = " \t\n\x0b\f\r"

# The names of the facility codes 0 to 23 and of the severities 0 to 7.
FACILITIES = (
    "kern user mail daemon auth syslog lpr news uucp clock authpriv ftp ntp audit alert cron "
    "local0 local1 local2 local3 local4 local5 local6 local7"
).split()
SEVERITIES = "emerg alert crit err warn notice info debug".split()

MODES = {"raw": "raw", "keep": "raw", "skip": "skip", "strip": "skip", "tag": "tag", "parse": "tag"}


def priority(text: Column) -> Column:
    """The number between the brackets, 0 to 65535; else null."""
    n = F.when(F.length(text) > 0, text.try_cast("long"))
    return F.when(n.between(0, 65535), n.cast("int"))


def pri_value(pri: Column) -> Column:
    return pri.bitwiseAND(F.lit(255))


def facility_code(pri: Column) -> Column:
    return (F.floor(pri / 8) % 256).cast("int")


def facility_name(pri: Column) -> Column:
    """Name of a priority's facility; ``unknown`` beyond 23, null without a priority."""
    names = F.array(*map(F.lit, FACILITIES))
    return F.when(pri.isNotNull(), F.coalesce(F.get(names, facility_code(pri)), F.lit("unknown")))


def severity_name(pri: Column) -> Column:
    return F.get(F.array(*map(F.lit, SEVERITIES)), pri % 8)


def parse_rfc5424(line: Column) -> Column:
    """struct(message, pri), or null if the line has no such header."""
    return _headed(line, HEAD_5424, lambda x: F.when(x["head"] != "", F.struct(x["message"].alias("message"), x["pri"].alias("pri"))))


def parse_rfc3164(line: Column) -> Column:
    return _headed(line, HEAD_3164, lambda x: F.when(x["head"] != "", F.struct(x["message"].alias("message"), x["pri"].alias("pri"))))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often use names it."""
    return F.transform(F.array(value), use)[0]


def _headed(line: Column, pattern: str, use: Callable[[Column], Column]) -> Column:
    """use of struct(line, head, message, pri). The pattern is tried once for each line."""

    def split(x: Column) -> Column:
        head = x["head"]
        number = F.substring(head, F.lit(2), F.instr(head, ">") - 2)
        message = F.substring(x["line"], F.length(head) + 1, F.length(x["line"]))
        return _bound(F.struct(x["line"].alias("line"), head.alias("head"), message.alias("message"), F.when(head != "", priority(number)).alias("pri")), use)

    # The patterns end where the message begins, which then is all of the rest.
    found = _bound(line, lambda text: F.struct(text.alias("line"), F.regexp_extract(text, pattern, 0).alias("head")))
    return F.when(line.isNotNull(), _bound(found, split))


def normalize(line: Column) -> Column:
    """struct(header, message, pri, facility, severity, msg_start, msg_end); offsets in bytes.

    RFC 5424 goes before RFC 3164; any other line is all message. The header
    has no blanks at its end.
    """

    def fields(x: Column) -> Column:
        end = F.octet_length(x["line"])
        return F.struct(
            F.when(x["head"] != "", F.rtrim(x["head"], F.lit(BLANKS))).alias("header"),
            x["message"].alias("message"),
            pri_value(x["pri"]).alias("pri"),
            facility_name(x["pri"]).alias("facility"),
            severity_name(x["pri"]).alias("severity"),
            (end - F.octet_length(x["message"])).alias("msg_start"),
            end.alias("msg_end"),
        )

    return _headed(line, HEAD, fields)


def header_mode(mode: str, lenient: bool = True) -> str:
    """``raw``, ``skip`` or ``tag`` for a mode or one of its other names, in any case; an unknown one is ``tag``, with a warning, or if not lenient an error."""
    known = MODES.get(mode.strip().lower())
    if known is None:
        said = f"unknown header mode {mode!r}; one of {sorted(MODES)}"
        if not lenient:
            raise ValueError(said)
        warnings.warn(f"{said}. Headers are tagged.", stacklevel=2)
    return known or "tag"


def apply_header_mode(df: DataFrame, mode: str = "skip", payload: str = "payload", tags: str = "tags", lenient: bool = True, fast: bool = True) -> DataFrame:
    """Strip (and with ``tag`` also record) the syslog header of each payload.

    A payload that is not UTF-8 is left alone. ``fast`` is accepted for
    callers that ask for a shortcut; the plan and the rows are the same.
    """
    mode = header_mode(mode, lenient)
    if mode == "raw":
        return df
    kind = dict(df.dtypes)[payload]
    text = F.col(payload).cast("string")
    ok = F.is_valid_utf8(text)
    n = normalize(text)
    out = df.withColumn("_syslog", F.when(ok, n))
    if mode == "tag":
        found = {"syslog.pri": F.col("_syslog.pri").cast("string"), "syslog.facility": F.col("_syslog.facility"), "syslog.severity": F.col("_syslog.severity")}
        added = F.map_filter(F.create_map(*(x for k, v in found.items() for x in (F.lit(k), v))), lambda k, v: v.isNotNull())
        old = F.coalesce(F.col(tags), F.create_map().cast("map<string,string>")) if tags in df.columns else F.create_map().cast("map<string,string>")
        old = F.map_filter(old, lambda k, v: ~F.map_contains_key(added, k))
        out = out.withColumn(tags, F.map_concat(old, added))
    return out.withColumn(payload, F.when(F.col("_syslog").isNotNull(), F.col("_syslog.message").cast(kind)).otherwise(F.col(payload))).drop("_syslog")


def strip_lenient(line: Column, markers: tuple[str, ...] = ()) -> Column:
    """The message of a line that may not be strict syslog.

    After a 5424-like header that starts at the first ``>``; else after the
    first ``": "`` past that; else after the first of ``markers``; else as in
    normalize. Lines that are not syslog may lose text, so this is never the
    default.
    """

    def message(x: Column) -> Column:
        text, head = x["text"], x["head"]
        after = lambda at: F.substring(text, at, F.length(text))
        colon, bracket = F.instr(text, ": "), F.instr(text, ">")
        out = F.when(head != "", after(F.length(head) + 1)).when((bracket > 0) & (colon > bracket), after(colon + 2))
        for m in markers:
            out = out.when(F.instr(text, m) > 0, after(F.instr(text, m) + len(m)))
        return out.otherwise(after(F.length(F.regexp_extract(text, HEAD, 0)) + 1))

    found = _bound(line, lambda text: F.struct(text.alias("text"), F.regexp_extract(text, HEAD_LENIENT, 0).alias("head")))
    return F.when(line.isNotNull(), _bound(found, message))


def encode_rfc3164(message: Column, ts: Column, pri: Column | int = 13, host: Column | str = "localhost", app: Column | str = "sparklog", newline: bool = False) -> Column:
    """``<PRI>Mon DD HH:MM:SS host app: message``; times in the session's time zone, days with two digits."""
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    line = F.concat(F.lit("<"), as_column(pri).cast("string"), F.lit(">"), F.date_format(ts, "MMM dd HH:mm:ss"), F.lit(" "), as_column(host), F.lit(" "), as_column(app), F.lit(": "), message)
    return F.when(F.endswith(line, F.lit("\n")), line).otherwise(F.concat(line, F.lit("\n"))) if newline else line


def resolved_app_name(app: Column, name: Column | str) -> Column:
    """app without blanks around it, or the sink's name where that is empty."""
    return F.coalesce(F.nullif(F.trim(app), F.lit("")), name if isinstance(name, Column) else F.lit(name))
