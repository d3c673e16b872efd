"""Rows as lines of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("json", "csv", "show", "kv", "raw", "proto-text")


def _text(df: DataFrame, f: T.StructField) -> Column:
    return F.to_json(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f.name).cast("string")


def _quoted(v: Column) -> Column:
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        v = F.replace(v, F.lit(plain), F.lit(escaped))
    return F.concat(F.lit('"'), v, F.lit('"'))


def format_lines(df: DataFrame, fmt: str = "json") -> DataFrame:
    """df -> value, one line for each row; a null is left out (csv: empty; raw: an empty word).

    json: an object. csv: comma-separated, quoted where needed. kv: ``k: v``
    joined by ``, ``, text in quotes with ``\\`` escapes. show: ``k = v``
    joined by `` | ``. raw: the values, joined by blanks, newlines as blanks.
    proto-text: ``k: v`` joined by blanks, text in quotes.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; one of {FORMATS}")
    fields = df.schema.fields
    if fmt == "json":
        return df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    if fmt == "csv":
        return df.select(F.to_csv(F.struct(*(_text(df, f).alias(f.name) for f in fields)), {"escape": '"', "quoteAll": "false", "emptyValue": '""'}).alias("value"))
    if fmt == "raw":
        return df.select(F.regexp_replace(F.concat_ws(" ", *(F.coalesce(_text(df, f), F.lit("")) for f in fields)), "[\r\n]+", " ").alias("value"))
    bare = (T.NumericType, T.BooleanType)
    equal, between = {"kv": (": ", ", "), "show": (" = ", " | "), "proto-text": (": ", " ")}[fmt]
    parts = [F.concat(F.lit(f.name + equal), _text(df, f) if isinstance(f.dataType, bare) else _quoted(_text(df, f))) for f in fields]
    return df.select(F.concat_ws(between, *parts).alias("value"))


def raw_record(df: DataFrame) -> DataFrame:
    """The text that network sinks send for a row."""
    return format_lines(df, "raw")


def write_lines(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Append the rows as text files under path; folders are made as needed."""
    format_lines(df, fmt).write.mode("append").text(path)


def write_raw(df: DataFrame, path: str, payload: str = "payload") -> None:
    """Append payloads as lines, with a newline added only where there is none."""
    text = F.col(payload).cast("string")
    line = F.when(F.endswith(text, F.lit("\n")), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    df.select(line.alias("value")).write.mode("append").text(path)


def write_rejected(df: DataFrame, path: str) -> None:
    """Rejected rows (error_class, raw) as kv lines."""
    write_lines(df, path, "kv")


def drop_all(df: DataFrame) -> None:
    """Run the plan and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def counted(df: DataFrame, payload: str = "payload", name: str | Observation = "egress") -> DataFrame:
    """df with an observation of how many rows and bytes pass, and of the first payload's start."""
    return df.observe(name, F.count(F.lit(1)).alias("sent"), F.sum(F.octet_length(payload)).alias("bytes"), F.first(F.substring(F.col(payload).cast("string"), 1, 64)).alias("preview"))
