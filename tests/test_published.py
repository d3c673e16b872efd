"""Files that a manifest names: what counts, and what does not."""

import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparklog.sinks import published


@pytest.fixture
def put(spark, tmp_path):
    published.register(spark)
    base = f"{tmp_path}/out"

    def write(df, kind="published_lines", file="x.log", **more):
        df.write.format(kind).options(base=base, file=file, **more).mode("append").save()
        return base

    return write


def lines(spark, base, file="x.log"):
    return sorted(bytes(r.payload).decode() for r in published.read_published_lines(spark, base, file).collect())


def held(base):
    return sorted(x for x in os.listdir(base) if not x.startswith("_"))


def test_jobs_add_up(spark, put):
    a, b = (spark.range(k, k + 50).select(F.col("id").cast("string")).repartition(3) for k in (0, 50))
    base = put(a)
    assert lines(spark, base) == sorted(map(str, range(50)))
    put(b)
    assert lines(spark, base) == sorted(map(str, range(100)))
    found = published.published(spark, base, "x.log").collect()
    assert sum(r["rows"] for r in found) == 100 and all(os.path.getsize(f"{base}/{r.name}") == r.bytes for r in found)
    assert len({r.batch for r in found}) == 2 and len(found) == len(held(base)) == 6
    assert lines(spark, base, "other.log") == [] if os.path.isdir(f"{base}/_published/other.log") else True


def test_what_fails_is_not_seen(spark, put):
    good = spark.range(5).select(F.col("id").cast("string"))
    base = put(good)
    bad = spark.range(0, 40, 1, 4).select(F.when(F.col("id") == 33, F.raise_error(F.lit("stop"))).otherwise(F.col("id").cast("string")).alias("v"))
    with pytest.raises(Exception):
        put(bad)
    assert lines(spark, base) == list("01234")
    # A file that no manifest names does not count, nor does a manifest that was not finished.
    (name,) = {r.name for r in published.published(spark, base, "x.log").limit(1).collect()}
    with open(f"{base}/x-stray.log", "w") as f:
        f.write("stray\n")
    with open(f"{base}/_published/x.log/half.draft", "w") as f:
        json.dump({"files": [{"name": name, "rows": 1, "bytes": 2}]}, f)
    assert lines(spark, base) == list("01234")
    with pytest.raises(Exception):
        good.write.format("published_lines").options(base=base, file="x.log").mode("overwrite").save()


def test_a_batch_that_runs_again(spark, put, tmp_path):
    """The commit of a batch is lost: it runs again and publishes nothing twice."""
    base = f"{tmp_path}/out"

    def run(query="query", state="state"):
        stream = spark.readStream.schema("v string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        q = stream.writeStream.format("published_lines").options(base=base, file="x.log", query=query, checkpointLocation=f"{tmp_path}/{state}").trigger(availableNow=True).start()
        q.awaitTermination()

    for k in range(2):
        spark.range(k * 10, k * 10 + 10).select(F.col("id").cast("string").alias("v")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert lines(spark, base) == sorted(map(str, range(20)))
    files = held(base)
    for name in ("1", ".1.crc"):
        os.remove(f"{tmp_path}/state/commits/{name}")
    run()
    assert lines(spark, base) == sorted(map(str, range(20))) and held(base) == files
    # Another query, with its own name and checkpoint, adds its own.
    run("second", "state2")
    assert lines(spark, base) == sorted([*map(str, range(20))] * 2)


@pytest.mark.parametrize("wire", ["arrow_ipc", "arrow_framed"])
def test_arrow(spark, put, rows, wire):
    df = spark.range(0, 300, 1, 3).select("id", F.col("id").cast("string").alias("s"))
    base = put(df, "published_arrow", "x.arrow", data_format=wire, tag="t")
    put(df.where("id < 0"), "published_arrow", "x.arrow", data_format=wire, tag="t")
    assert rows(published.read_published_arrow(spark, base, "x.arrow", df.schema, wire)) == rows(df)
    assert len(held(base)) == 3


def test_any_file_system():
    """Paths go through Arrow's file systems, by their scheme."""
    system, path = published._at("file:///a/b")
    assert isinstance(system, pa.fs.LocalFileSystem) and path == "/a/b"
    assert published._at("file:/a/b")[1] == published._at("/a/b")[1] == "/a/b"
