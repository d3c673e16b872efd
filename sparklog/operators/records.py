"""Records, lists of named and typed fields, to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklog.functions.coerce import RECORD_TYPES, egress, record_type

RECORD = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("meta", T.StringType()), T.StructField("value", T.StringType())]))


def as_text(value: Column) -> Column:
    """A value's text: JSON for arrays, maps and structs."""
    held = F.to_json(F.struct(value.alias("v")))
    # The type is known when the query is planned, so one of the two remains.
    return F.when(F.typeof(value).rlike("^(array|map|struct)<"), F.when(value.isNotNull(), F.substring(held, F.lit(6), F.length(held) - 6))).otherwise(value.cast("string"))


def record(fields: list[tuple[str, str, Column]]) -> Column:
    """A record of (name, type, value) from columns; a null value is a missing field; arrays, maps and structs become JSON."""
    parts = [F.struct(F.lit(n).alias("name"), F.lit(m).alias("meta"), as_text(v).alias("value")) for n, m, v in fields]
    return F.filter(F.array(*parts), lambda f: f["value"].isNotNull())


def text_schema(names: list[str]) -> T.StructType:
    """A column of text for each name."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def schema_of_first(df: DataFrame, order: str, rec: str = "rec") -> T.StructType:
    """Schema of the record with the smallest order key: fields to be ignored are left out, all may be null. One row reaches the driver."""
    first = df.select(F.min_by(rec, order)).first()[0] or []
    kinds = [(f["name"], record_type(f["meta"])) for f in first]
    return T.StructType([T.StructField(n, k) for n, k in kinds if k is not None])


def schema_table(df: DataFrame, order: str, rec: str = "rec") -> DataFrame:
    """schema_of_first as a table (name, type), without a row reaching the driver. Arrays are text; unknown types and those to be ignored are left out."""
    first = df.agg(F.min_by(rec, order).alias("rec")).select(F.explode("rec").alias("f"))
    meta = F.lower(F.trim("f.meta"))
    types = F.create_map(*(F.lit(x) for name, kind in RECORD_TYPES.items() if kind is not None for x in (name, kind.simpleString())))
    found = first.select(F.col("f.name").alias("name"), F.when(meta.startswith("array"), "string").otherwise(types[meta]).alias("type"))
    return found.where("type IS NOT NULL")


def records_to_table(df: DataFrame, schema: T.StructType, rec: str = "rec", keep: tuple[str, ...] = ()) -> DataFrame:
    """A column for each field of schema, looked up by name in the record; missing ones are null, others are ignored. No shuffle."""

    def fields(r: Column) -> Column:
        names = F.transform(F.array(F.transform(r, lambda x: x["name"])), lambda n: F.struct(*(F.array_position(n, f.name).cast("int").alias(f"_{i}") for i, f in enumerate(schema.fields))))[0]
        return F.transform(F.array(names), lambda at: F.struct(*(F.when(at[f"_{i}"] > 0, F.get(r, at[f"_{i}"] - 1)).alias(f"_{i}") for i in range(len(schema.fields)))))[0]

    # The record is walked through once; what stands under each name is then a field of a struct.
    found = df.withColumn("_found", F.transform(F.array(rec), fields)[0]).select(*keep, "_found")
    return found.select(*keep, *(egress(F.col(f"_found._{i}.value"), F.lower(f"_found._{i}.meta"), f.dataType).alias(f.name) for i, f in enumerate(schema.fields)))


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
