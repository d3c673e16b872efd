"""Files to events: text lines, whole files, JSON lines."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from sparklog.functions.payload import ENCODINGS, decode_line
from sparklog.operators.events import shard_key, to_events
from sparklog.operators.ndjson import ndjson_to_table

DATA_FORMATS = ("ndjson", "arrow_ipc", "arrow_framed")
MOST_SHARDS = 32


def data_format(name: str | None) -> str:
    """``ndjson`` where none is given; an unknown one is an error."""
    if name is None:
        return "ndjson"
    if name not in DATA_FORMATS:
        raise ValueError(f"unknown data format {name!r}; one of {DATA_FORMATS}")
    return name


def resolve(file: str, base: str | None = None, **more: object) -> str:
    """Path of a file or glob under base. Wildcards are allowed in file only, and there is no parameter ``path``."""
    if "path" in more:
        raise ValueError("'path' is not a parameter; use 'base' and 'file'")
    if more:
        raise ValueError(f"unknown parameters {sorted(more)}")
    if base and any(c in base for c in "*?["):
        raise ValueError(f"wildcards are allowed in 'file' only, not in base {base!r}")
    return f"{base.rstrip('/')}/{file}" if base else file


#: Tables of a row for each file or block of a file are broadcast up to so many rows.
BROADCAST_ROWS = 1_000_000


def _path() -> Column:
    return F.replace(F.col("_metadata.file_path"), F.lit(":///"), F.lit(":/")).alias("file_path")


def _few(side: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(side) if rows <= BROADCAST_ROWS else side


def listed_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file_path, file_size and file_seq, the file's place by name and then path: a row for each file that matches, from the listing alone."""
    files = spark.read.format("binaryFile").load(path).select(_path(), F.col("_metadata.file_size").alias("file_size"))
    name = F.element_at(F.split("file_path", "/"), -1)
    return files.withColumn("file_seq", F.row_number().over(W.orderBy(name, "file_path")) - 1)


def _without_end(line: Column) -> Column:
    """A line's bytes without carriage returns at its end. Bytes that are no UTF-8 may stand before them, so they are taken one by one."""
    return F.when(F.substring(line, -1, 1) == F.lit(b"\r"), F.encode(F.rtrim(F.decode(line, "ISO-8859-1"), F.lit("\r")), "ISO-8859-1")).otherwise(line)


def _scan(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A row for each line: file_path, file_size, block, line_id, length (in bytes, with its newline), payload."""
    text = spark.read.option("lineSep", "\n").text(path)
    if not text.inputFiles():
        raise FileNotFoundError(f"no file matches {path}")
    return text.select(
        _path(),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_id"),
        (F.octet_length("value").cast("long") + 1).alias("length"),
        _without_end(F.col("value").cast("binary")).alias("payload"),
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """rows with line_no, a line's number in its block of its file, and ahead, the bytes of the block's lines before it. No shuffle: a task reads a block's lines in order."""
    at = [rows.columns.index(c) for c in ("file_path", "block", "length")]

    def run(batches):
        last, n, ahead = None, 0, 0
        for b in batches:
            numbers, bytes_ = [], []
            for *x, length in zip(*(b.column(i).to_pylist() for i in at)):
                if x != last:
                    last, n, ahead = x, 0, 0
                numbers.append(n), bytes_.append(ahead)
                n, ahead = n + 1, ahead + length
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(numbers, pa.int64()), pa.array(bytes_, pa.int64())], names=[*b.schema.names, "line_no", "ahead"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("line_no", T.LongType()), T.StructField("ahead", T.LongType())]))


def with_offsets(rows: DataFrame) -> DataFrame:
    """Lines of _scan -> with offset, the byte of its file at which a line begins, whatever the blocks are.

    Lines share a file out among its blocks, so a block's first line begins
    where the lines of the blocks before it end: a first pass adds up the
    lengths of each block, a second one those within it. A byte order mark,
    which belongs to no line, shifts a file's lines by three.
    """
    # Splits depend on which files a scan reads, so no later filter may reach this scan alone; it does not pass one that is not deterministic.
    blocks = rows.where(F.monotonically_increasing_id() >= 0).groupBy("file_path", "block").agg(F.sum("length").alias("bytes"), F.max("file_size").alias("file_size"))
    of_file = W.partitionBy("file_path")
    before = F.sum("bytes").over(of_file.orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    # Two or three bytes are missing from all lines, the last with or without a newline.
    mark = F.when(F.max("file_size").over(of_file) - F.sum("bytes").over(of_file) >= 2, F.lit(3)).otherwise(F.lit(0))
    blocks = blocks.select("file_path", "block", (F.coalesce(before, F.lit(0)) + mark).alias("begin"))
    # A task has one full block at the most, and a file one that is not full.
    blocks = _few(blocks, len(rows.inputFiles()) + rows.rdd.getNumPartitions())
    return _numbered(rows).join(blocks, ["file_path", "block"]).withColumn("offset", F.col("begin") + F.col("ahead")).drop("begin", "ahead")


def line_range(offset: Column, size: Column, ranges: int) -> Column:
    """Which of up to ``ranges`` (held to 1 to 32) shares of a file a line is in, from 0: each share begins with the first line behind a multiple of its part of the bytes."""
    ranges = max(1, min(MOST_SHARDS, ranges))
    part = F.ceil(size / ranges)
    return F.when((offset > 0) & (part > 0), F.floor((offset - 1) / part)).otherwise(F.lit(0)).cast("int")


def read_lines(spark: SparkSession, file: str, base: str | None = None, ordered: bool = True, offsets: bool = False, **more: object) -> DataFrame:
    """A row for each line: file_path, file_seq (if ordered), block, line_id, offset (if asked for), payload (bytes).

    Lines end with a newline only, and lose every carriage return and newline
    at their end; blank lines and an unfinished last line are rows. Files scan
    in parallel; orderBy(file_seq, block, line_id) gives their order, and so
    does orderBy(file_seq, offset). Offsets take a second pass over the files.
    No file that matches is an error.
    """
    path = resolve(file, base, **more)
    rows = _scan(spark, path)
    if offsets:
        rows = with_offsets(rows)
    if ordered:
        rows = rows.join(_few(listed_files(spark, path).select("file_path", "file_seq"), len(rows.inputFiles())), "file_path")
    return rows.select("file_path", *(["file_seq"] if ordered else []), "block", "line_id", *(["offset"] if offsets else []), "payload")


def lines_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The lines of the files at paths: file_path, payload."""
    return _scan(spark, paths).select("file_path", "payload")


def read_text_events(
    spark: SparkSession, file: str, base: str | None = None, encode: str = "text", name: str = "file", tags: list[str] | None = None, instances: int = 1, on_error: str = "fail"
) -> DataFrame:
    """Lines of files as events.

    With ``instances`` (held to 1 to 32) over 1 the key says in which of so
    many shares of its file's bytes a line is, and the id follows from the
    line's offset, so neither depends on how Spark splits the files.
    """
    if encode not in ENCODINGS:
        raise ValueError(f"unknown encoding {encode!r}; one of {ENCODINGS}")
    shards = max(1, min(MOST_SHARDS, instances))
    rows = _scan(spark, resolve(file, base))
    rows = with_offsets(rows) if shards > 1 else _numbered(rows)
    key: Column = shard_key(name, line_range(F.col("offset"), F.col("file_size"), shards), shards) if shards > 1 else F.lit(name)
    rows = rows.withColumn("tags", F.create_map(F.lit("access_source"), F.col("file_path")))
    rows = rows.withColumn("payload", decode_line(F.col("payload").cast("string"), encode, on_error) if encode != "text" else F.col("payload"))
    return to_events(rows, key, tags=tags, stable_id=("file_path", "offset") if shards > 1 else ("file_path", "block", "line_no"))


def read_whole_files(spark: SparkSession, file: str, base: str | None = None, name: str = "file") -> DataFrame:
    """A row for each file that is not empty: file_path, file_seq, src_key, payload. Files are never split; one is at most 2 GB."""
    return whole_files(spark, resolve(file, base), name)


def whole_files(spark: SparkSession, path: str | list[str], name: str = "file") -> DataFrame:
    listed = listed_files(spark, path).where("file_size > 0").withColumn("n", F.count("*").over(W.partitionBy()))
    listed = listed.select("file_path", "file_seq", shard_key(name, F.col("file_seq"), F.col("n")).alias("src_key"))
    files = spark.read.format("binaryFile").load(path).where("length > 0").select(_path(), F.col("content").alias("payload"))
    return files.join(_few(listed, len(files.inputFiles())), "file_path").select("file_path", "file_seq", "src_key", "payload")


def read_ndjson(spark: SparkSession, file: str, schema: T.StructType, base: str | None = None, on_error: str = "fail") -> DataFrame:
    """Files of JSON lines as typed columns."""
    return ndjson_to_table(_scan(spark, resolve(file, base)), schema, "payload", on_error)
