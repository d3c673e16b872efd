"""Exact deduplication through an extendible-hash index on shared files.

DataFrame functions only. A text's key is the XXH64 of its normalised bytes.
The directory maps the leading bits of a key to a bucket; it starts at one
depth for the whole table and is doubled while any bucket is overfull,
splitting only the overfull ones. Documents then go to their buckets' owners,
tasks that each hold a range of keys: there texts of one key are compared byte
by byte and chained, and the chains are written as bucket files to the shared
folder. Documents probe the index by bucket and key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparklog.llm.common import ascii_lower, cut, hot_join, saved, shared_path

#: Tables of up to so many rows are broadcast.
BROADCAST_ROWS = 1_000_000
#: A key that more than this share of all rows carry has its copies combined before they move. There are 1/share such keys at most.
HOT = 0.002


def _prefix(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def directory(keys: DataFrame, bucket_rows: int) -> DataFrame:
    """keys(h), one row per distinct key -> (prefix, depth, load), one row per bucket.

    A bucket of local depth d holds the keys whose first d bits are prefix.
    Each round doubles the directory: an overfull bucket's keys are told apart
    by one bit more, until every bucket holds bucket_rows keys at most.
    """
    total = keys.count()
    depth = min(63, max(0, math.ceil(math.log2(max(1, total / bucket_rows)))))
    open_, done = keys.select("h"), []
    while True:
        at = open_.groupBy(_prefix(F.col("h"), depth).alias("prefix")).agg(F.count("*").alias("load"))
        at = cut(at.withColumn("depth", F.lit(depth)))
        over = at.where((F.col("load") > bucket_rows) & F.lit(depth < 64)).select("prefix")
        done.append(at.join(over, "prefix", "left_anti"))
        if over.isEmpty():
            break
        open_ = cut(open_.withColumn("prefix", _prefix(F.col("h"), depth)).join(over, "prefix", "left_semi").select("h"))
        depth += 1
    buckets = done[0]
    for more in done[1:]:
        buckets = buckets.unionByName(more)
    return cut(buckets.select("prefix", "depth", "load"))


def with_bucket(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """rows(h) with bucket: the one bucket of the directory whose prefix starts the key. There are few depths, so a row asks once for each."""
    depths = sorted(r["depth"] for r in buckets.select("depth").distinct().collect()) or [0]
    named = buckets.select("depth", "prefix", F.concat_ws("_", "depth", "prefix").alias("bucket"))
    if len(depths) == 1:
        return rows.withColumn("prefix", _prefix(F.col("h"), depths[0])).join(_small(named.drop("depth"), named.count()), "prefix").drop("prefix")
    ask = F.explode(F.array(*(F.struct(F.lit(d).alias("depth"), _prefix(F.col("h"), d).alias("prefix")) for d in depths))).alias("_ask")
    asked = rows.select("*", ask).withColumns({"depth": F.col("_ask.depth"), "prefix": F.col("_ask.prefix")})
    return asked.join(_small(named, named.count()), ["depth", "prefix"]).drop("depth", "prefix", "_ask")


def _keyed(docs: DataFrame, id_col: str, text_col: str, key_bits: int) -> DataFrame:
    text = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("norm")).withColumn("h", F.xxhash64("norm"))
    return keyed.withColumn("h", F.shiftleft(F.shiftrightunsigned("h", 64 - key_bits), 64 - key_bits)) if key_bits < 64 else keyed


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 1 << 16, key_bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(digests, index). digests: row, id, h, sha, bucket, one for each row of docs. index: bucket, h, chain, sha, keep_id, n, one for each distinct text.

    A key that one row alone carries is entered by its digest; the texts of the
    others are fetched, so only texts that may be equal to another one move.
    key_bits under 64 shortens the key (for tests of colliding keys).
    """
    spark, keyed = docs.sparkSession, _keyed(docs, id_col, text_col, key_bits)
    digests = saved(keyed.select(F.monotonically_increasing_id().alias("row"), "id", "h", F.unhex(F.sha2("norm", 256)).alias("sha")), "digests")
    keys = saved(digests.groupBy("h").agg(F.count("*").alias("rows")), "exact-keys")
    buckets = directory(keys, bucket_rows)
    shared = saved(keys.where("rows > 1").select("h", "rows"), "shared-keys")
    known = shared.agg(F.count("*").alias("n"), F.sum("rows").alias("rows")).first()
    hot = [r["h"] for r in shared.where(F.col("rows") > max(1000, HOT * docs.count())).select("h").collect()]

    texts = keyed.join(_small(shared.select("h"), known["n"]), "h", "left_semi").withColumn("n", F.lit(1).cast("long"))
    if hot:
        combined = texts.where(F.col("h").isin(hot)).groupBy("h", "norm").agg(F.max("id").alias("id"), F.count("*").alias("n"))
        texts = texts.where(~F.col("h").isin(hot)).unionByName(combined)
    single = digests.join(_small(shared.select("h"), known["n"]), "h", "left_anti").select("id", F.lit(None).cast("string").alias("norm"), "h", "sha", F.lit(1).cast("long").alias("n"))
    entries = with_bucket(texts.withColumn("sha", F.lit(None).cast("binary")).unionByName(single), buckets)
    # Owner tasks hold ranges of keys. What follows needs no further exchange: grouping compares bytes inside the task, chains are numbered there.
    owners = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    owned = entries.withColumn("range", F.shiftrightunsigned("h", 1)).repartitionByRange(owners, "range", "h")
    chains = owned.groupBy("range", "h", "bucket", "norm").agg(F.max("id").alias("keep_id"), F.sum("n").alias("n"), F.first("sha").alias("sha"))
    chains = chains.withColumn("sha", F.coalesce("sha", F.unhex(F.sha2("norm", 256))))
    chains = chains.withColumn("chain", F.row_number().over(W.partitionBy("range", "h").orderBy("sha")) - 1)
    path = shared_path(spark, "exact-index")
    chains.select("bucket", "h", "chain", "sha", "keep_id", "n").sortWithinPartitions("bucket", "h", "chain").write.partitionBy("bucket").parquet(path)
    schema = "h long, chain int, sha binary, keep_id " + docs.select(id_col).dtypes[0][1] + ", n long, bucket string"
    return with_bucket(digests, buckets), spark.read.schema(schema).parquet(path)


def _probed(docs: DataFrame, id_col: str, text_col: str, bucket_rows: int, key_bits: int) -> DataFrame:
    """id, h, sha, keep_id, group_size, kept, one for each row of docs."""
    digests, index = build_index(docs, id_col, text_col, bucket_rows, key_bits)
    entries = index.select("bucket", "h", "sha", "keep_id", F.col("n").alias("group_size"), "n")
    found = hot_join(digests, entries, "h", "n", "row", "inner", also=("bucket", "sha")).withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))
    found = saved(found.select("row", "id", "h", "sha", "keep_id", "group_size", "kept"), "probed")
    if found.where("kept").count() == index.count():
        return found
    # Rows repeat both id and text: the first of them stays.
    again = found.where("kept").groupBy("h", "sha").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1").select("h", "sha", "first", "n")
    fixed = hot_join(found, saved(again, "repeated"), "h", "n", "row", "left", also=("sha",))
    return fixed.withColumn("kept", F.col("kept") & F.coalesce(F.col("row") == F.col("first"), F.lit(True))).drop("first")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 1 << 16, key_bits: int = 64) -> DataFrame:
    """One row for each row of docs: id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty. Of equal texts the row with the largest id stays (a null id is
    smaller than any); of rows that repeat both id and text, one stays. Texts
    of any length are compared whole; further columns are ignored, whatever
    their names. An empty table gives no rows.
    """
    found = _probed(docs, id_col, text_col, bucket_rows, key_bits)
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay (see exact_duplicates), with their columns. Of rows that repeat id and text one stays."""
    found = _probed(docs, id_col, text_col, 1 << 16, 64)
    same = found.groupBy("h", "sha", "id").agg(F.max("kept").alias("kept"), F.count("*").alias("times"))
    same = saved(same.where("NOT kept OR times > 1").select(F.col("h").alias("__h"), F.col("sha").alias("__sha"), F.col("id").alias("__id"), "kept", "times"), "exact-gone")
    norm = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    at = (F.xxhash64(norm) == F.col("__h")) & F.col(id_col).eqNullSafe(F.col("__id")) & (F.unhex(F.sha2(norm, 256)) == F.col("__sha"))
    gone = same.where("NOT kept").select("__h", "__sha", "__id")
    out = docs.join(_small(gone, gone.count()), at, "left_anti")
    twice = same.where("kept AND times > 1").select("__h", "__sha", "__id")
    if twice.isEmpty():
        return out
    twice = _small(twice, twice.count())
    again = out.join(twice, at, "left_semi").withColumn("__own", norm).dropDuplicates([id_col, "__own"])
    return out.join(twice, at, "left_anti").unionByName(again.select(docs.columns))
