"""Named files: one for each partition, published when the job commits.

``file_lines`` writes text lines, ``file_arrow`` an Arrow stream or frame. The
folder must be one that all executors and the driver share. A task writes to
``<name>.<attempt>.lock`` and deletes it if it fails; the commit renames the
files of the tasks that succeeded, an abort deletes them. One task's file keeps
its plain name, those of several are numbered. A file that is there already is
left as it is: appending publishes a further part beside it (``stem.2.ext``), so
no bytes move and a commit that breaks off leaves whole files only.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import count

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from sparklog.sinks.options import file_options
from sparklog.sources.arrow import encode_frame


def replica_name(path: str, index: int, count: int) -> str:
    """``stem-r{index}.ext`` where there are several replicas; a ``.lock`` stays last."""
    if count <= 1:
        return path
    lock = ".lock" if path.endswith(".lock") else ""
    stem, ext = os.path.splitext(path.removesuffix(".lock"))
    return f"{stem}-r{index}{ext}{lock}"


def output_path(base: str, file: str, work_root: str = ".") -> str:
    """file under base, which is itself under the work root unless it is absolute."""
    return os.path.join(work_root, base, file)


def part_name(path: str, number: int) -> str:
    """path, or for later parts ``stem.number.ext``."""
    stem, ext = os.path.splitext(path)
    return path if number < 2 else f"{stem}.{number}{ext}"


@dataclass
class Written(WriterCommitMessage):
    lock: str | None
    index: int = 0
    append: bool = False


class _Files:
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.options = file_options(options)
        self.overwrite = overwrite
        self.path = output_path(self.options["base"], self.options["file"])

    @contextmanager
    def locked(self) -> Iterator[tuple]:
        """(open file, its name) of a task's file, which goes if the task fails."""
        os.makedirs(os.path.dirname(self.path) or ".", exist_ok=True)
        lock = f"{self.path}.{uuid.uuid4().hex}.lock"
        try:
            with open(lock, "wb") as out:
                yield out, lock
        except BaseException:
            os.remove(lock)
            raise

    def commit(self, messages) -> None:
        for m in messages:
            if m is None or m.lock is None:
                continue
            final = replica_name(self.path, m.index + 1, len(messages))
            if not m.append or self.overwrite:
                os.replace(m.lock, final)
                continue
            for number in count(1):
                try:
                    os.link(m.lock, part_name(final, number))
                    break
                except FileExistsError:
                    continue
            os.remove(m.lock)

    def abort(self, messages) -> None:
        for m in messages:
            if m is not None and m.lock and os.path.exists(m.lock):
                os.remove(m.lock)


class LineWriter(_Files, DataSourceWriter):
    def write(self, iterator: Iterator) -> Written:
        with self.locked() as (out, lock):
            for row in iterator:
                value = row[0] if row[0] is not None else b""
                value = bytes(value) if isinstance(value, (bytes, bytearray)) else value.encode()
                out.write(value if value.endswith(b"\n") else value + b"\n")
        return Written(lock, TaskContext.get().partitionId(), True)


class ArrowWriter(_Files, DataSourceArrowWriter):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        framed = self.options["data_format"] == "arrow_framed"
        batches = (b for b in iterator if b.num_rows)
        first = next(batches, None)
        if first is None and not framed:
            return Written(None)
        with self.locked() as (out, lock):
            if framed:
                out.write(encode_frame(self.options["tag"], []))
            if first is not None:
                with pa.ipc.new_stream(out, first.schema) as writer:
                    writer.write_batch(first)
                    for b in batches:
                        writer.write_batch(b)
        # A frame takes the place of the one before; a further stream is a further part.
        return Written(lock, TaskContext.get().partitionId(), not framed)


class FileLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_lines"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if len(schema.fields) != 1:
            raise ValueError("file_lines writes one column; see format_lines")
        return LineWriter(self.options, overwrite)


class FileArrow(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_arrow"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ArrowWriter(dict(self.options) | {"protocol": "arrow"}, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FileLines)
    spark.dataSource.register(FileArrow)
