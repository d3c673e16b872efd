"""Payloads and tags: text and bytes, strict base64 and hex, key-value tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ENCODINGS = ("text", "base64", "hex")


def payload_to_text(payload: Column) -> Column:
    """Bytes as text; what is not UTF-8 becomes U+FFFD."""
    return F.make_valid_utf8(payload.cast("string"))


def _checked(value: Column, ok: Column, what: str, on_error: str, raw: Column) -> Column:
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    if on_error == "null":
        return F.when(ok, value)
    return F.when(raw.isNull(), F.lit(None).cast("binary")).when(ok, value).otherwise(F.raise_error(F.concat(F.lit(f"not {what}: "), F.substring(raw, 1, 60))))


def _trimmed(line: Column) -> Column:
    return F.regexp_replace(line, r"^\s+|\s+$", "")


def decode_base64(line: Column, on_error: str = "fail") -> Column:
    """Standard base64 with padding, blanks around it allowed; anything else fails, or is null."""
    text = _trimmed(line)
    value = F.try_to_binary(text, F.lit("base64"))
    # Encoding the value again tells whether bits beyond its last byte were zero; base64() breaks long lines.
    again = F.regexp_replace(F.base64(value), "[\r\n]", "")
    strict = text.rlike(r"^[A-Za-z0-9+/]*={0,2}\z") & (F.length(text) % 4 == 0)
    return _checked(value, strict & F.coalesce(again == text, F.lit(False)), "base64", on_error, text)


def decode_hex(line: Column, on_error: str = "fail") -> Column:
    """Pairs of hex digits, blanks around them allowed; anything else fails, or is null."""
    text = _trimmed(line)
    return _checked(F.try_to_binary(text, F.lit("hex")), text.rlike(r"^[0-9A-Fa-f]*\z") & (F.length(text) % 2 == 0), "hex", on_error, text)


def decode_line(line: Column, encode: str = "text", on_error: str = "fail") -> Column:
    if encode not in ENCODINGS:
        raise ValueError(f"unknown encoding {encode!r}; one of {ENCODINGS}")
    return {"text": lambda: line.cast("binary"), "base64": lambda: decode_base64(line, on_error), "hex": lambda: decode_hex(line, on_error)}[encode]()


def parse_tags(items: Column) -> Column:
    """array of ``k=v`` or ``k:v`` -> map; the first ``=`` splits, or without one the first ``:``; items with neither are left out, the last of a key holds."""

    def entry(item: Column) -> Column:
        sep = F.when(F.instr(item, "=") > 0, F.instr(item, "=")).otherwise(F.instr(item, ":"))
        return F.struct(F.substring(item, F.lit(1), sep - 1).alias("key"), F.substring(item, sep + 1, F.length(item)).alias("value"))

    entries = F.transform(F.filter(items, lambda x: (F.instr(x, "=") > 0) | (F.instr(x, ":") > 0)), entry)
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]))


def frame_line(payload: Column) -> Column:
    """The payload with a newline at its end."""
    return F.when(F.endswith(payload, F.lit("\n")), payload).otherwise(F.concat(payload, F.lit("\n")))


def frame_length(payload: Column) -> Column:
    """The payload behind its length in bytes and a blank."""
    return F.concat(F.octet_length(payload).cast("string"), F.lit(" "), payload)
