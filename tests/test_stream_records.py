"""The schema of a stream's first record holds, over later records and restarts."""

from pyspark.sql import types as T

from sparklog.operators.records import RECORD
from sparklog.streaming.records import frozen_schema, logged_schema, write_records

SCHEMA = T.StructType([T.StructField("at", T.LongType()), T.StructField("rec", RECORD)])


def rec(**fields):
    return [{"name": k, "meta": m, "value": v} for k, (m, v) in fields.items()]


def test_schema_is_frozen(spark, tmp_path):
    base = str(tmp_path)

    def run(*rows):
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
        q = write_records(stream, f"{base}/schema", "at", lambda df, n: df.write.mode("append").parquet(f"{base}/out"), f"{base}/state", keep=("at",))
        q.awaitTermination()

    assert logged_schema(spark, f"{base}/schema") is None
    run((9, None))
    assert logged_schema(spark, f"{base}/schema") is None
    run((5, rec(late=("chars", "x"))), (2, rec(n=("digit", "4"), s=("chars", "a"), no=("ignore", "z"))))
    first = logged_schema(spark, f"{base}/schema")
    assert [(f.name, f.dataType.simpleString()) for f in first] == [("n", "bigint"), ("s", "string")]
    # A later record of a smaller key and of other kinds changes nothing.
    run((1, rec(n=("chars", "7"), other=("digit", "1"))))
    assert logged_schema(spark, f"{base}/schema") == first
    out = spark.read.parquet(f"{base}/out")
    assert sorted(map(tuple, out.select("at", "n", "s").collect())) == [(1, 7, None), (2, 4, "a"), (5, None, None)]


def test_who_logs_first_is_right(spark, tmp_path):
    log = f"{tmp_path}/schema"
    a, b = (spark.createDataFrame([(1, rec(**{name: ("digit", "1")}))], SCHEMA) for name in "ab")
    assert frozen_schema(a, log, "at").fieldNames() == ["a"] == frozen_schema(b, log, "at").fieldNames()
