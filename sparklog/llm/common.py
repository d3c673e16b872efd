"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


#: Rows that reach a Python worker at once, so that long texts do not pile up in it.
BATCH_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a temporary one where it is unset and Spark runs in one process (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
            spark.sparkContext.setCheckpointDir(path)
        return path
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise df once in the shared folder and cut its lineage, so that lost executors cost no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: for wide rows, of which later steps read some columns."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    # With the schema given, no job reads it from the files.
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Recent(dict):
    """What make(key) gives, kept for the keys used of late: twice ``most`` of them at the most, however many there are."""

    def __init__(self, make, most: int = 100_000):
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        found = self.older.pop(key, None)
        if found is None:
            found = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Runs of ``[^\\x20\\x09-\\x0D]``; 0 for null."""
    return F.when(text.isNull(), 0).otherwise(
        F.size(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")).cast("long")
    ).cast("long")


#: Narrow tables of up to so many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def few(df: DataFrame) -> DataFrame:
    """df, which has narrow rows and is saved or cut, marked to be broadcast if it is small enough."""
    return side_of(df.count())(df)


def side_of(most: int) -> Callable[[DataFrame], DataFrame]:
    """What marks narrow tables of so many rows at the most to be broadcast, if these are few enough: one count serves for several tables."""
    return F.broadcast if most <= BROADCAST_ROWS else lambda table: table


def hot_join(rows: DataFrame, side: DataFrame, key: str, count: str, spread: str, how: str = "left", share: float = 0.002, also: tuple[str, ...] = (), narrow: bool = False, total: int | None = None) -> DataFrame:
    """rows joined to side, which holds one row per key and in ``count`` how many rows carry it.

    A key that more than ``share`` of all rows carry is dealt over several
    partitions by a hash of column ``spread``, and its row of side is repeated
    once for each. There are at most 1/share such keys whatever the size of
    the input, so the list of them that reaches the driver is bounded.
    ``count`` is left out of the result. ``also`` names further key columns.
    A side that is said to be narrow is broadcast while it is small enough.
    ``total`` is the sum of ``count``, where it is known.
    """
    spark = rows.sparkSession
    if narrow and side.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(side.drop(count)), [key, *also], how)
    total = (side.agg(F.sum(count)).first()[0] or 0) if total is None else total
    hot = total > 1000 and [r[0] for r in side.where((F.col(count) > max(total * share, 1000)) & F.col(key).isNotNull()).select(key).collect()]
    if not hot:
        return rows.join(side.drop(count), [key, *also], how)
    ways = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("_way", F.when(F.col(key).isin(hot), F.pmod(F.xxhash64(spread), F.lit(ways))).otherwise(F.lit(0)))
    side = side.drop(count).withColumn("_way", F.explode(F.when(F.col(key).isin(hot), F.sequence(F.lit(0).cast("long"), F.lit(ways - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))))
    return rows.join(side, [key, *also, "_way"], how).drop("_way")
