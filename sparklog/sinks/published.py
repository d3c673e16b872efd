"""Files that count once a manifest names them: for batches and streams, on any store that Arrow can write to.

``published_lines`` writes text lines, ``published_arrow`` Arrow streams or
frames. A task writes a file of a name that nobody else has; committing writes
one small manifest that lists the files of all tasks, and readers take the
files that manifests list. Nothing is renamed but the manifest, so a store
without renames or locks will do, and what a failed or aborted job leaves
behind is invisible.

A stream's manifest is named after the query and the batch. A batch that runs
again finds its manifest there and publishes nothing more. A query with a new
checkpoint needs a new name (option ``query``), for its batches begin at 0.
"""

from __future__ import annotations

import json
import os
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

from sparklog.sinks.options import file_options
from sparklog.sources import arrow, files

MANIFESTS = "_published"


@dataclass
class Piece(WriterCommitMessage):
    name: str | None
    rows: int = 0
    bytes: int = 0


def _at(base: str) -> tuple[pa.fs.FileSystem, str]:
    """(file system, path) of a folder's address."""
    return pa.fs.FileSystem.from_uri(base if "://" in base else "file://" + os.path.abspath(base.removeprefix("file:")))


def manifest_path(folder: str, file: str) -> str:
    return posixpath.join(folder, MANIFESTS, file)


class _Published:
    def __init__(self, options: dict[str, str], overwrite: bool = False):
        if overwrite:
            raise ValueError("published files are added to; mode must be 'append'")
        self.query = options.get("query", "query")
        self.options = file_options({k: v for k, v in options.items() if k not in ("query", "checkpointlocation", "checkpointLocation")})

    def _folder(self) -> tuple[pa.fs.FileSystem, str]:
        return _at(self.options["base"])

    def put(self, write) -> Piece:
        """A file of this task; write(stream) returns its rows, or None for no file. It goes if the task fails."""
        system, folder = self._folder()
        stem, ext = os.path.splitext(self.options["file"])
        name = f"{stem}-{uuid.uuid4().hex}{ext}"
        path = posixpath.join(folder, name)
        system.create_dir(posixpath.dirname(path), recursive=True)
        done = False
        try:
            with system.open_output_stream(path) as out:
                rows = write(out)
                size = out.tell()
            done = rows is not None
        finally:
            if not done:
                system.delete_file(path)
        return Piece(name, rows, size) if done else Piece(None)

    def publish(self, messages, name: str) -> None:
        system, folder = self._folder()
        place = manifest_path(folder, self.options["file"])
        final = posixpath.join(place, f"{name}.json")
        if system.get_file_info(final).type != pa.fs.FileType.NotFound:
            self.discard(messages)
            return
        system.create_dir(place, recursive=True)
        pieces = [vars(m) for m in messages if m is not None and m.name]
        draft = posixpath.join(place, f"{name}.{uuid.uuid4().hex}.draft")
        with system.open_output_stream(draft) as out:
            out.write(json.dumps({"files": pieces}).encode())
        system.move(draft, final)

    def discard(self, messages) -> None:
        system, folder = self._folder()
        for m in messages:
            if m is not None and m.name and system.get_file_info(posixpath.join(folder, m.name)).type == pa.fs.FileType.File:
                system.delete_file(posixpath.join(folder, m.name))


class _Batch(_Published):
    def commit(self, messages) -> None:
        self.publish(messages, f"batch-{uuid.uuid4().hex}")

    def abort(self, messages) -> None:
        self.discard(messages)


class _Stream(_Published):
    def commit(self, messages, batchId: int) -> None:
        self.publish(messages, f"{self.query}-{batchId:020d}")

    def abort(self, messages, batchId: int) -> None:
        self.discard(messages)


class _Lines(_Published):
    def write(self, iterator: Iterator) -> Piece:
        def lines(out):
            rows = 0
            for row in iterator:
                value = row[0] if row[0] is not None else b""
                value = bytes(value) if isinstance(value, (bytes, bytearray)) else value.encode()
                out.write(value if value.endswith(b"\n") else value + b"\n")
                rows += 1
            return rows or None

        return self.put(lines)


class _Arrow(_Published):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> Piece:
        def stream(out):
            batches = (b for b in iterator if b.num_rows)
            if (first := next(batches, None)) is None:
                return None
            if self.options["data_format"] == "arrow_framed":
                out.write(arrow.encode_frame(self.options["tag"], []))
            rows = 0
            with pa.ipc.new_stream(out, first.schema) as writer:
                while first is not None:
                    writer.write_batch(first)
                    rows += first.num_rows
                    first = next(batches, None)
            return rows

        return self.put(stream)


class LineBatch(_Lines, _Batch, DataSourceWriter):
    pass


class LineStream(_Lines, _Stream, DataSourceStreamWriter):
    pass


class ArrowBatch(_Arrow, _Batch, DataSourceArrowWriter):
    pass


class ArrowStream(_Arrow, _Stream, DataSourceStreamArrowWriter):
    pass


class PublishedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "published_lines"

    def _checked(self, schema: T.StructType) -> dict[str, str]:
        if len(schema.fields) != 1:
            raise ValueError("published_lines writes one column; see format_lines")
        return dict(self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return LineBatch(self._checked(schema), overwrite)

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamWriter:
        return LineStream(self._checked(schema), overwrite)


class PublishedArrow(DataSource):
    @classmethod
    def name(cls) -> str:
        return "published_arrow"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ArrowBatch(dict(self.options) | {"protocol": "arrow"}, overwrite)

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return ArrowStream(dict(self.options) | {"protocol": "arrow"}, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PublishedLines)
    spark.dataSource.register(PublishedArrow)


def published(spark: SparkSession, base: str, file: str) -> DataFrame:
    """batch, name, rows, bytes: a row for each file that a manifest names, and how much was written to it. Manifests are read by Spark."""
    place = manifest_path(base.rstrip("/"), file)
    kind = "files array<struct<name: string, rows: long, bytes: long>>"
    found = spark.read.schema(kind).json(f"{place}/*.json").selectExpr("regexp_extract(_metadata.file_name, '(.*)[.]json$', 1) AS batch", "explode(files) AS f")
    return found.select("batch", "f.*")


def _names(spark: SparkSession, base: str, file: str) -> list[str]:
    return [f"{base.rstrip('/')}/{r.name}" for r in published(spark, base, file).select("name").toLocalIterator()]


def read_published_lines(spark: SparkSession, base: str, file: str) -> DataFrame:
    """The lines of all published files: file_path, payload."""
    names = _names(spark, base, file)
    if not names:
        return spark.createDataFrame([], "file_path string, payload binary")
    return files.lines_of(spark, names)


def read_published_arrow(spark: SparkSession, base: str, file: str, schema: T.StructType, wire: str = "arrow_ipc") -> DataFrame:
    """The rows of all published files."""
    names = _names(spark, base, file)
    return arrow.read_arrow(spark, names, wire=wire, schema=schema) if names else spark.createDataFrame([], schema)
