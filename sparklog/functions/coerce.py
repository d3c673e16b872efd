"""Loosely typed values to typed columns: one policy for what comes in, another for what goes out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
NAMED = r"(?i)^[+-]?(?:inf|infinity|nan)$"
RFC3339 = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?(?:[Zz]|[+-][0-9]{2}:[0-9]{2})$"
#: Years outside of what a count of nanoseconds in 64 bits can reach.
FIRST_NS, LAST_NS = "1677-09-21 00:12:44", "2262-04-11 23:47:16"
#: Milliseconds that a count of microseconds in 64 bits can reach.
MOST_MS = ((1 << 63) - 1) // 1000


def to_long(v: Column) -> Column:
    """Digits with an optional sign and nothing else, within 64 bits; else null."""
    return F.when(v.rlike(r"^[+-]?[0-9]+\z"), v.try_cast("long"))


def to_double(v: Column) -> Column:
    word = F.lower(F.regexp_replace(v, r"^[+-]", ""))
    named = F.when(word.startswith("inf"), F.when(v.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))).otherwise(F.lit(float("nan")))
    return F.when(v.rlike(NUMBER.replace("$", r"\z")), v.try_cast("double")).when(v.rlike(NAMED.replace("$", r"\z")), named)


def to_boolean(v: Column) -> Column:
    return F.when(v == "true", True).when(v == "false", False)


def rfc3339(v: Column) -> Column:
    """Time of an RFC 3339 text as UTC without zone; a second 60 counts as the next minute's first."""
    text = F.upper(v)
    leap = text.rlike(r":60(?:\.[0-9]+)?(?:Z|[+-])")
    plain = F.try_to_timestamp(F.when(leap, F.regexp_replace(text, r":60(\.[0-9]+)?", ":59")).otherwise(text))
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), plain.cast("timestamp_ntz"))
    utc = F.when(leap, utc + F.expr("INTERVAL 1 SECOND")).otherwise(utc)
    return F.when(v.rlike(RFC3339.replace("$", r"\z")), utc)


def to_timestamp(v: Column, compat_epoch: bool = False) -> Column:
    """RFC 3339 text only; a time that nanoseconds in 64 bits cannot hold is null, or with ``compat_epoch`` the epoch."""
    ts = rfc3339(v)
    reach = ts.between(F.lit(FIRST_NS).cast("timestamp_ntz"), F.lit(LAST_NS).cast("timestamp_ntz"))
    return F.when(reach, ts).when(ts.isNotNull(), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") if compat_epoch else F.lit(None).cast("timestamp_ntz"))


def ingest(v: Column, kind: T.DataType) -> Column:
    """A JSON value as text -> a column of the declared type; an unsupported type is an error that names it."""
    if isinstance(kind, T.StringType):
        return v
    if isinstance(kind, T.LongType):
        return to_long(v)
    if isinstance(kind, T.DoubleType):
        return to_double(v)
    if isinstance(kind, T.BooleanType):
        return to_boolean(v)
    if isinstance(kind, T.TimestampNTZType):
        return to_timestamp(v)
    raise ValueError(f"unsupported type {kind.simpleString()}")


# What goes out: a record's value is text with the name of its kind beside it.

#: Record type -> Spark type; None for a type whose fields are left out.
RECORD_TYPES: dict[str, T.DataType | None] = {
    "bool": T.BooleanType(),
    "digit": T.LongType(),
    "float": T.DoubleType(),
    "port": T.IntegerType(),
    **dict.fromkeys(("time", "time_iso", "time_rfc3339", "time_rfc2822", "time_timestamp", "time_clf"), T.TimestampNTZType()),
    **dict.fromkeys(("hex", "base64"), T.BinaryType()),
    **dict.fromkeys(
        "chars symbol peek_symbol ip ip_net domain email url sn id_card mobile_phone kv kv_arr json exact_json http_request http_status http_agent http_method auto proto_text obj".split(),
        T.StringType(),
    ),
    "ignore": None,
}


def record_type(meta: str) -> T.DataType | None:
    """Spark type of a record field; arrays are text (JSON)."""
    name = meta.strip().lower()
    if name.startswith("array"):
        return T.StringType()
    if name not in RECORD_TYPES:
        raise ValueError(f"unknown record type {meta!r}")
    return RECORD_TYPES[name]


_TEXT = ("bool", "digit", "float", "hex", "obj", "array") + tuple(k for k in RECORD_TYPES if k.startswith("time"))


def _is(meta: Column, *kinds: str) -> Column:
    return meta.isin(*kinds)


def out_boolean(v: Column, meta: Column) -> Column:
    """Booleans; of text ``true`` in any case is true and the rest false; other kinds are null."""
    return F.when(_is(meta, "bool"), F.lower(v) == "true").when(~_is(meta, *_TEXT), F.lower(v) == "true")


def out_long(v: Column, meta: Column) -> Column:
    """Whole numbers; fractions lose their fraction, at the ends of 64 bits they stay there; text must be digits."""
    f = to_double(v)
    cut = F.when(F.isnan(f), F.lit(0).cast("long")).when(f >= 2.0**63, F.lit((1 << 63) - 1)).when(f <= -(2.0**63), F.lit(-(1 << 63))).otherwise(f.try_cast("long"))
    return F.when(_is(meta, "float"), cut).when(~_is(meta, *(k for k in _TEXT if k != "digit")), to_long(v))


def out_int(v: Column, meta: Column, strict: bool = False) -> Column:
    """As out_long, then modulo 2^32 into the signed range; strict makes what does not fit null."""
    n = out_long(v, meta)
    low = n.bitwiseAND(F.lit(0xFFFFFFFF))
    wrapped = F.when(low >= 1 << 31, low - (1 << 32)).otherwise(low)
    return (F.when(n.between(-(1 << 31), (1 << 31) - 1), n) if strict else wrapped).cast("int")


def out_double(v: Column, meta: Column) -> Column:
    return F.when(~_is(meta, *(k for k in _TEXT if k not in ("digit", "float"))), to_double(v))


def out_timestamp(v: Column, meta: Column) -> Column:
    """Times; whole numbers are milliseconds since the epoch, as many as microseconds in 64 bits reach; text is RFC 3339 or ``YYYY-MM-DD HH:MM:SS``."""
    plain = F.when(v.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?\z"), v.try_cast("timestamp_ntz"))
    ms = to_long(v)
    within = ms % 86_400_000
    # A whole number of days is exact as a double; both parts have the sign of ms, so their sum stays in reach.
    since = F.make_dt_interval(days=((ms - within) / 86_400_000).cast("int"), secs=within.cast("decimal(18,6)") / 1000)
    whole = F.when(ms.between(-MOST_MS, MOST_MS), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since)
    return F.when(_is(meta, "digit"), whole).when(~_is(meta, "bool", "float", "hex", "obj", "array"), F.coalesce(rfc3339(v), plain))


def out_binary(v: Column, meta: Column) -> Column:
    """Hex values as their least bytes, high byte first; anything else as its text in UTF-8."""
    digits = F.regexp_replace(F.lower(v), "^0x", "")
    even = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    return F.when(_is(meta, "hex"), F.unhex(F.regexp_replace(even, "^(00)+(?=..)", ""))).otherwise(v.cast("binary"))


def egress(v: Column, meta: Column, kind: T.DataType) -> Column:
    """A record's value -> a column of the given type."""
    by = {T.BooleanType: out_boolean, T.LongType: out_long, T.IntegerType: out_int, T.DoubleType: out_double, T.TimestampNTZType: out_timestamp, T.BinaryType: out_binary}
    return by[type(kind)](v, meta) if type(kind) in by else v
