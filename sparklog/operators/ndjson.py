"""JSON lines to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklog.functions.coerce import ingest


def ndjson_to_table(df: DataFrame, schema: T.StructType, line: str = "value", on_error: str = "fail") -> DataFrame:
    """Lines, each a JSON object -> the declared columns; further keys are ignored, missing ones are null.

    ``fail``: a line that is not one object, a blank one too, is an error, as
    is null in a column declared not null. ``rescue``: such rows have nulls,
    and the columns error_class and raw say why and what. Plain ``from_json``
    takes blank lines and trailing text; reading the line as an array of one
    object does not.
    """
    for f in schema.fields:
        ingest(F.lit(None).cast("string"), f.dataType)
    if on_error not in ("fail", "rescue"):
        raise ValueError(f"on_error must be 'fail' or 'rescue', not {on_error!r}")
    text = F.col(line).cast("string")
    body = F.trim(F.regexp_replace(text, r"^\s+|\s+$", ""))
    raw = T.ArrayType(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] or [T.StructField("_", T.StringType())]))
    mode = "FAILFAST" if on_error == "fail" else "PERMISSIVE"
    bracketed = F.concat(F.lit("["), text, F.lit("]"))
    parsed = F.from_json(bracketed, raw, {"mode": mode})
    ok = body.startswith("{") & body.endswith("}") & (F.size(parsed) == 1) & F.get(parsed, 0).isNotNull()
    if on_error == "rescue":
        # A permissive parse keeps what it can of a broken line; the parse into a variant is strict.
        ok = F.coalesce(ok & F.try_parse_json(bracketed).isNotNull(), F.lit(False))
    out = df.withColumn("_raw", F.when(text.isNotNull(), text)).withColumn("_row", F.get(parsed, 0))
    value = {f.name: ingest(F.col("_row")[f.name], f.dataType) for f in schema.fields}
    if on_error == "fail":
        good = F.coalesce(ok, F.lit(False))
        out = df.withColumn("_row", F.when(good, F.get(parsed, 0)).otherwise(F.raise_error(F.concat(F.lit("not a JSON object: "), F.coalesce(F.substring(text, 1, 60), F.lit("null"))))))
        columns = []
        for f in schema.fields:
            v = value[f.name]
            columns.append((v if f.nullable else F.coalesce(v, F.raise_error(F.lit(f"null in {f.name}, which is declared not null")).cast(f.dataType))).alias(f.name))
        return out.select(*columns)
    out = out.withColumn("_ok", ok)
    missing = [F.when(F.col("_ok") & v.isNull(), F.lit(f"null in {f.name}")) for f in schema.fields if not f.nullable for v in [value[f.name]]]
    error = F.coalesce(F.when(~F.col("_ok"), F.lit("decode")), *missing, F.lit(None).cast("string"))
    return out.select(*(F.when(F.col("_ok"), value[f.name]).alias(f.name) for f in schema.fields), error.alias("error_class"), F.col("_raw").alias("raw"))


def split_good_bad(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows with error_class and raw: (good rows without the two, rejected rows with only the two)."""
    return df.where("error_class IS NULL").drop("error_class", "raw"), df.where("error_class IS NOT NULL").select("error_class", "raw")
