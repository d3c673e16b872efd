"""A seeded shuffle of all rows into shards: rows are scattered into buckets that fit in memory, and each bucket is shuffled and written."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from sparklog.llm.common import cut, few, shared_path

#: Bytes of text that a bucket holds on average.
BUCKET_BYTES = 16 << 20
#: A bucket with so many times its share of the rows, and some, holds rows that repeat.
OVERFULL = 4
HOT = 0.01
#: Rows that leave a bucket at once.
OUT_ROWS = 256
OWN = ("shard", "slot")


def row_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text, none for null, and one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def scattered(docs: DataFrame, buckets: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """docs -> (bucket, key, row) by a seeded hash of id and text, and (bucket, n).

    Rows that are alike in both have one hash. Where they make a bucket
    overfull, those of a hash that holds over a HOT share of a bucket are
    scattered again over all buckets, by their place in the input as well.
    """
    rows = docs.select(F.xxhash64(F.lit(seed), "doc_id", "text").alias("key"), F.struct(*docs.columns).alias("row"))
    rows = rows.select(F.pmod("key", F.lit(buckets)).alias("bucket"), "key", "row")
    loads = cut(rows.groupBy("bucket").agg(F.count("*").alias("n")))
    fair = (loads.agg(F.sum("n")).first()[0] or 0) / buckets
    full = cut(loads.where(F.col("n") > OVERFULL * fair + 1000).select("bucket"))
    if buckets == 1 or full.isEmpty():
        return rows, loads
    # At most one bucket in OVERFULL is that full, and at most 1 / HOT hashes for each bucket are hot.
    hot = rows.join(few(full), "bucket", "left_semi").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT * fair)
    rows = rows.withColumn("again", F.xxhash64("key", F.monotonically_increasing_id())).join(few(cut(hot.select("key", F.lit(True).alias("hot")))), "key", "left")
    key = F.when(F.col("hot"), F.col("again")).otherwise(F.col("key"))
    rows = rows.select(F.pmod(key, F.lit(buckets)).alias("bucket"), key.alias("key"), "row")
    return rows, cut(rows.groupBy("bucket").agg(F.count("*").alias("n")))


def _shuffle(seed: int):
    """Rows sorted by bucket and key -> bucket, pos, row: each bucket in a random order of its own.

    One bucket is held at a time; numpy's permutation is a Fisher-Yates
    shuffle, here from a seed of the bucket's own, so a task that runs again
    gives the same order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            bucket = whole.column(0)[0].as_py()
            order = np.random.Generator(np.random.Philox(key=[seed % (1 << 64), bucket])).permutation(whole.num_rows)
            for at in range(0, len(order), OUT_ROWS):
                got = whole.take(pa.array(order[at : at + OUT_ROWS]))
                yield pa.RecordBatch.from_arrays([got.column(0), pa.array(np.arange(at, at + got.num_rows), pa.int64()), got.column(2)], names=["bucket", "pos", "row"])

        for b in batches:
            buckets = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
            for start, end in zip(cuts, cuts[1:]):
                if held and end > start and held[-1].column(0)[0].as_py() != buckets[start]:
                    yield from flush()
                if end > start:
                    held.append(b.slice(start, end - start))
        if held:
            yield from flush()

    return run


def shuffle_into_shards(docs: DataFrame, shards: int = 16, seed: int = 17, bucket_bytes: int = BUCKET_BYTES, path: str | None = None) -> DataFrame:
    """docs(doc_id, text, ...) in a random order, cut into shards whose counts of rows are at most one apart -> the columns of docs, slot, shard.

    The first pass scatters rows into buckets of about bucket_bytes of text by
    a seeded hash; the second shuffles each bucket in memory and writes it, as
    Parquet in a folder for each shard under ``path`` (by default one in the
    shared folder). A bucket's place in the whole follows from the counts of
    those before it, so shard and slot are known as its rows are written.

    Null and empty texts are rows of one byte; a text larger than a bucket
    makes that bucket as large; rows that repeat each have their place, by
    their place in the input where there are very many of them (else no
    layout of the input matters); an empty table gives no rows. Columns of
    docs named shard or slot give way to the new ones.
    """
    docs = docs.select(*(c for c in docs.columns if c.lower() not in OWN))
    spark = docs.sparkSession
    rows_in, bytes_in = docs.agg(F.count("*"), F.sum(row_size())).first()
    buckets = max(1, -(-(bytes_in or 0) // bucket_bytes))
    rows, loads = scattered(docs, buckets, seed)
    # One row for each bucket.
    before = F.coalesce(F.sum("n").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = few(cut(loads.select("bucket", before.alias("before"))))
    out = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("pos", T.LongType()), rows.schema["row"]])
    mixed = rows.repartition("bucket").sortWithinPartitions("bucket", "key").mapInArrow(_shuffle(seed), out)
    place = F.col("before") + F.col("pos")
    placed = mixed.join(starts, "bucket").select("row.*", place.alias("slot"))
    n = max(1, rows_in)
    # Shard k begins at k * n / shards, rounded up.
    placed = placed.withColumn("shard", F.expr(f"CAST(slot * {shards} DIV {n} AS INT)")).withColumn("slot", F.expr(f"slot - (shard * {n}L + {shards - 1}) DIV {shards}"))
    path = path or shared_path(spark, "shards")
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    schema = T.StructType([*docs.schema.fields, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def shard_digest(sharded: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of what shuffle_into_shards returns; a null text's crc32 is that of nothing."""
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return sharded.select("doc_id", row_size().alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
