"""Records of a stream under the schema of its first record."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparklog.operators.records import records_to_table, schema_of_first


def logged_schema(spark: SparkSession, log: str) -> T.StructType | None:
    """The schema that stands in the folder log, None if none does."""
    try:
        row = spark.read.option("wholetext", True).text(log).first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        row = None
    return T.StructType.fromJson(json.loads(row.value)) if row and row.value.strip() else None


def frozen_schema(batch: DataFrame, log: str, order: str, rec: str = "rec") -> T.StructType:
    """The logged schema; where there is none yet, that of the batch's first record by order, which is logged. One row reaches the driver, once.

    The log is written by Spark, to a folder that must not exist before, so of
    two that begin at once one's schema holds for both.
    """
    spark = batch.sparkSession
    if (known := logged_schema(spark, log)) is not None:
        return known
    found = schema_of_first(batch, order, rec)
    try:
        spark.createDataFrame([(found.json(),)], "value string").coalesce(1).write.mode("errorifexists").text(log)
    except AnalysisException as e:
        if "PATH_ALREADY_EXISTS" not in str(e):
            raise
    return logged_schema(spark, log) or found


def write_records(stream: DataFrame, log: str, order: str, write: Callable[[DataFrame, int], None], checkpoint: str, rec: str = "rec", keep: tuple[str, ...] = (), **trigger: object) -> StreamingQuery:
    """Start a query that gives each micro-batch's records as typed columns to write(rows, batch number).

    The columns are those of the first record of the first micro-batch that
    has one, and stay so over restarts: later records lose fields that it has
    not, and have null for those that they lack. Micro-batches without a
    record are not written.
    """

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.where(f"{rec} IS NOT NULL")
        if not batch.isEmpty():
            write(records_to_table(batch, frozen_schema(batch, log, order, rec), rec, keep), number)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
