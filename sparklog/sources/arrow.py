"""Arrow IPC streams and tagged frames: decode, encode, read."""

from __future__ import annotations

import io
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from sparklog.sources.files import data_format, listed_files, resolve, whole_files

WIRE = ("arrow_ipc", "arrow_framed")


def _spark_type(t: pa.DataType) -> pa.DataType:
    """The nearest type that Spark has: times to microseconds, unsigned numbers to the next wider signed ones."""
    if pa.types.is_timestamp(t):
        return pa.timestamp("us", t.tz)
    if pa.types.is_dictionary(t):
        return _spark_type(t.value_type)
    wider = {pa.uint8(): pa.int16(), pa.uint16(): pa.int32(), pa.uint32(): pa.int64(), pa.uint64(): pa.int64(), pa.float16(): pa.float32(), pa.large_string(): pa.string(), pa.large_binary(): pa.binary()}
    return wider.get(t, t)


def _is_ns(t: pa.DataType) -> bool:
    return pa.types.is_timestamp(t) and t.unit == "ns"


def spark_arrow_schema(schema: pa.Schema, exact_ns: bool = False) -> pa.Schema:
    """The schema in Spark's types; with exact_ns, a column ``name_ns`` behind each time in nanoseconds holds them all, since 1970 in UTC."""
    fields = []
    for f in schema:
        fields.append(pa.field(f.name, _spark_type(f.type), f.nullable))
        if exact_ns and _is_ns(f.type):
            fields.append(pa.field(f"{f.name}_ns", pa.int64(), f.nullable))
    return pa.schema(fields)


def stream_batches(data: bytes, segments: str = "all", on_error: str = "fail") -> Iterator[pa.RecordBatch]:
    """Batches of the streams that data holds, one behind the other; ``first`` reads the first stream only; ``keep_prefix`` ends at an error instead of raising it."""
    source = pa.BufferReader(data)
    while source.tell() < len(data):
        try:
            with pa.ipc.open_stream(source) as reader:
                yield from reader
        except (pa.ArrowInvalid, OSError):
            if on_error == "fail":
                raise
            return
        if segments == "first":
            return


def unframe(data: bytes) -> tuple[str, bytes] | None:
    """(tag, stream) of a frame; None if it is too short for its header."""
    if len(data) < 4 or 4 + (n := int.from_bytes(data[:4], "big")) > len(data):
        return None
    return data[4 : 4 + n].decode("utf-8", "replace"), data[4 + n :]


def encode_stream(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema) as writer:
        for b in batches:
            writer.write_batch(b)
    return sink.getvalue().to_pybytes()


def encode_frame(tag: str, batches: list[pa.RecordBatch]) -> bytes:
    """4 bytes of tag length, high byte first, the tag, and one stream of all batches; the header alone without any."""
    head = tag.encode()
    return len(head).to_bytes(4, "big") + head + (encode_stream(batches) if batches else b"")


def _check(wire: str, segments: str, on_error: str) -> None:
    if wire not in WIRE:
        raise ValueError(f"unknown data format {wire!r}; one of {WIRE}")
    if segments not in ("all", "first") or on_error not in ("fail", "keep_prefix"):
        raise ValueError("segments must be 'all' or 'first', on_error 'fail' or 'keep_prefix'")


def payload_schema(df: DataFrame, payload: str = "payload", wire: str = "arrow_ipc", exact_ns: bool = False) -> T.StructType:
    """Schema of the first payload's stream. Only the schema reaches the driver."""

    def peek(batches):
        for b in batches:
            for x in b.column(0):
                data = x.as_py() or b""
                if wire == "arrow_framed":
                    data = (unframe(data) or ("", b""))[1]
                if data:
                    schema = spark_arrow_schema(pa.ipc.open_stream(pa.BufferReader(data)).schema, exact_ns)
                    yield pa.RecordBatch.from_arrays([pa.array([schema.serialize().to_pybytes()], pa.binary())], names=["schema"])
                    return

    found = df.select(F.col(payload).cast("binary").alias("p")).mapInArrow(peek, "schema binary").first()
    if found is None:
        raise ValueError("no payload to take a schema from")
    return from_arrow_schema(pa.ipc.read_schema(pa.py_buffer(bytes(found[0]))), prefer_timestamp_ntz=True)


def _typed(got: pa.RecordBatch, names: list[str], exact_ns: bool, tag: str | None, label: str | None) -> pa.RecordBatch:
    """A stream's batch as columns of the given names in Spark's types; one that it lacks is null."""
    table = {f.name: got.column(i).cast(_spark_type(f.type), safe=not pa.types.is_timestamp(f.type)) for i, f in enumerate(got.schema)}
    if exact_ns:
        table |= {f"{f.name}_ns": got.column(i).cast(pa.int64()) for i, f in enumerate(got.schema) if _is_ns(f.type)}
    columns = [pa.nulls(got.num_rows) if (c := table.get(n)) is None else c for n in names]
    first = [pa.array([label] * got.num_rows, pa.string())] if tag else []
    return pa.RecordBatch.from_arrays([*first, *columns], names=[*([tag] if tag else []), *names])


def decode_arrow(df: DataFrame, schema: T.StructType | None = None, payload: str = "payload", wire: str = "arrow_ipc", segments: str = "all", on_error: str = "fail", tag: str | None = None, exact_ns: bool = False) -> DataFrame:
    """Binary payloads -> the rows of their streams.

    The stream's own schema counts; ``schema`` spares the look at the first
    payload. A column that a stream lacks is null. Frames too short for their
    header are skipped; ``tag`` names a column for the tags of frames. Times
    are in microseconds; ``exact_ns`` adds ``name_ns`` for those in nanoseconds.
    """
    _check(wire, segments, on_error)
    schema = schema or payload_schema(df, payload, wire, exact_ns)
    names = schema.fieldNames()
    out = T.StructType([*([T.StructField(tag, T.StringType())] if tag else []), *schema.fields])

    def run(batches):
        for b in batches:
            for x in b.column(0):
                data, label = x.as_py(), None
                if data is None:
                    continue
                if wire == "arrow_framed":
                    if (frame := unframe(data)) is None:
                        continue
                    label, data = frame
                for got in stream_batches(data, segments, on_error):
                    yield _typed(got, names, exact_ns, tag, label)

    return df.select(F.col(payload).cast("binary").alias("p")).mapInArrow(run, out)


def arrow_failures(df: DataFrame, payload: str = "payload", wire: str = "arrow_ipc") -> DataFrame:
    """The payloads that decode_arrow fails on -> the other columns, error_class, position, raw.

    ``end``: the stream breaks off within a message. ``decode``: what stands
    there is no message, or one whose columns cannot be read. ``connect``:
    nothing came, the payload is null. position is the byte of the message at
    fault, and raw what stands from there on. A frame too short for its header
    is skipped, as it is when decoded. Rows that are read with keep_prefix
    stand in the batches before position.
    """
    _check(wire, "all", "fail")
    others = [c for c in df.columns if c != payload]
    fields = [*(df.schema[c] for c in others), T.StructField("error_class", T.StringType()), T.StructField("position", T.LongType()), T.StructField("raw", T.BinaryType())]

    def failure(data: bytes | None) -> tuple | None:
        if data is None:
            return "connect", None, None
        at = 0
        try:
            for _, head, at, end in stream_ranges(io.BytesIO(data), len(data), wire, range_bytes=1):
                for _ in stream_batches(b"".join([*(data[x : x + n] for x, n in head), data[at:end], _END]), "first"):
                    pass
        except StreamError as e:
            return e.kind, e.at, data[e.at :]
        except (pa.ArrowInvalid, OSError):
            return "decode", at, data[at:]
        return None

    def run(batches):
        for b in batches:
            found = [failure(x.as_py()) for x in b.column(b.num_columns - 1)]
            bad = [i for i, f in enumerate(found) if f]
            columns = zip(*(found[i] for i in bad)) if bad else [()] * 3
            kept = [c.take(pa.array(bad, pa.int64())) for c in b.columns[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.binary())))], names=[f.name for f in fields])

    return df.select(*others, F.col(payload).cast("binary").alias("p")).mapInArrow(run, T.StructType(fields))


def count_skipped_frames(df: DataFrame, payload: str = "payload") -> DataFrame:
    """frames and skipped: how many payloads there are, and how many are too short for a frame's header."""
    n = F.conv(F.hex(F.substring(F.col(payload), 1, 4)), 16, 10).cast("long")
    bad = (F.octet_length(payload) < 4) | (n + 4 > F.octet_length(payload))
    return df.agg(F.count(payload).alias("frames"), F.count(F.when(bad, 1)).alias("skipped"))


def encode_arrow(df: DataFrame, wire: str = "arrow_ipc", tag: str = "") -> DataFrame:
    """Rows -> payload: a binary value for each Arrow batch, as a stream or a frame with the tag."""
    _check(wire, "all", "fail")

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([encode_stream([b]) if wire == "arrow_ipc" else encode_frame(tag, [b])], pa.binary())], names=["payload"])

    return df.mapInArrow(run, "payload binary")


#: Bytes of record batches that one read takes.
RANGE_BYTES = 64 << 20
_END = b"\xff\xff\xff\xff\0\0\0\0"
_SCHEMA, _DICTIONARY, _RECORDS = 1, 2, 3


def _opened(file_path: str):
    """(file system, path) of a file's address, if Arrow knows its scheme."""
    return pa.fs.FileSystem.from_uri(re.sub("^([A-Za-z0-9+.-]+):/(?!/)", r"\1:///", file_path) if ":" in file_path else file_path)


def _message(meta: bytes) -> tuple[int, int]:
    """(kind, bytes of the body) of a message, from the table of its fields: kind is the second, the body's length the fourth."""
    at = struct.unpack_from("<I", meta)[0]
    fields = at - struct.unpack_from("<i", meta, at)[0]
    size = struct.unpack_from("<H", meta, fields)[0]

    def field(k: int, kind: str) -> int:
        place = struct.unpack_from("<H", meta, fields + 4 + 2 * k)[0] if 4 + 2 * k < size else 0
        return struct.unpack_from(kind, meta, at + place)[0] if place else 0

    return field(1, "<B"), field(3, "<q")


class StreamError(ValueError):
    """What is wrong with a stream, and at which of its bytes: ``end`` where it breaks off, else ``decode``."""

    def __init__(self, at: int, kind: str, said: str):
        super().__init__(f"at byte {at}: {said}")
        self.at, self.kind = at, kind


def stream_ranges(file, size: int, wire: str = "arrow_ipc", segments: str = "all", on_error: str = "fail", range_bytes: int = RANGE_BYTES) -> Iterator[tuple]:
    """(tag, head, begin, end) for each run of about range_bytes of record batches; head is [offset, length] of the schema and the dictionaries that a run needs.

    Only the messages' own headers are read, never their bodies. A message
    that is not whole or no message is an error, or with keep_prefix the end.
    """
    at, tag = 0, None
    if wire == "arrow_framed":
        file.seek(0)
        n = int.from_bytes(file.read(4), "big")
        if size < 4 or 4 + n > size:
            return
        tag, at = file.read(n).decode("utf-8", "replace"), 4 + n
    while at < size:
        head: list[list[int]] = []
        begin, end, needs, ended = None, 0, None, False
        while at < size and not ended:
            try:
                file.seek(at)
                mark, *more = struct.unpack("<Ii", (file.read(8) + b"\0" * 8)[:8])
                lead, length = (8, more[0]) if mark == 0xFFFFFFFF else (4, mark)
                if length == 0:
                    at, ended = at + lead, True
                    break
                if not 0 < length <= size - at - lead:
                    raise StreamError(at, "end" if lead == 8 and length > 0 else "decode", "a message that is not whole")
                file.seek(at + lead)
                kind, body = _message(file.read(length))
                total = lead + length + body
                if kind not in (_SCHEMA, _DICTIONARY, _RECORDS) or (kind == _SCHEMA) != (not head) or body < 0:
                    raise StreamError(at, "decode", "no message where one is due")
                if at + total > size:
                    raise StreamError(at, "end", "a message whose body is not whole")
            except (ValueError, struct.error) as e:
                if on_error == "fail":
                    raise e if isinstance(e, StreamError) else StreamError(at, "decode", str(e)) from e
                if begin is not None:
                    yield tag, needs, begin, end
                return
            if kind == _RECORDS and begin is None:
                begin, needs = at, [list(x) for x in head]
            if kind != _RECORDS:
                head.append([at, total])
            at += total
            if kind == _RECORDS:
                end = at
                if end - begin >= range_bytes:
                    yield tag, needs, begin, end
                    begin = None
        if begin is not None:
            yield tag, needs, begin, end
        if segments == "first":
            return


_RANGES = "file_path string, tag string, head array<array<long>>, begin long, end long"


def _ranges(listed: DataFrame, wire: str, segments: str, on_error: str, range_bytes: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for path, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                system, name = _opened(path)
                with system.open_input_file(name) as file:
                    rows = list(stream_ranges(file, size, wire, segments, on_error, range_bytes))
                columns = zip(*rows) if rows else [()] * 4
                kinds = (pa.string(), pa.list_(pa.list_(pa.int64())), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["file_path", "tag", "head", "begin", "end"])

    return listed.select("file_path", "file_size").mapInArrow(run, _RANGES)


def read_arrow(
    spark: SparkSession, file: str | list[str], base: str | None = None, wire: str = "arrow_ipc", schema: T.StructType | None = None, segments: str = "all", on_error: str = "fail", tag: str | None = None, exact_ns: bool = False, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Files of Arrow streams or frames as rows, by a pattern or a list of paths; the options are those of decode_arrow.

    A file's messages are indexed by their headers, and runs of record batches
    are read as tasks of their own, so a file may be of any size; a single
    batch is held in memory. Where Arrow has no access to a file's scheme,
    files are read whole, of up to 2 GB each.
    """
    data_format(wire)
    _check(wire, segments, on_error)
    path = file if isinstance(file, list) else resolve(file, base)
    listed = listed_files(spark, path)
    total, files, some = listed.agg(F.sum("file_size"), F.count("*"), F.min("file_path")).first()
    if not files:
        raise FileNotFoundError(f"no file matches {path}")
    try:
        _opened(some)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ValueError, OSError):
        return decode_arrow(whole_files(spark, path), schema, wire=wire, segments=segments, on_error=on_error, tag=tag, exact_ns=exact_ns)
    # Files are dealt out to be indexed, and their runs to be read.
    ranges = _ranges(listed.repartition(min(files, 1000), "file_path"), wire, segments, on_error, range_bytes)
    if schema is None:
        first = ranges.first()
        if first is None:
            # Streams without a row have a schema still.
            return decode_arrow(whole_files(spark, path), schema, wire=wire, segments=segments, on_error=on_error, tag=tag, exact_ns=exact_ns)
        schema = _schema_of(first, exact_ns)
    names = schema.fieldNames()
    out = T.StructType([*([T.StructField(tag, T.StringType())] if tag else []), *schema.fields])

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                for got in stream_batches(_bytes_of(row), "first", on_error):
                    yield _typed(got, names, exact_ns, tag, row["tag"])

    return ranges.repartition(files + (total or 0) // range_bytes, "file_path", "begin").mapInArrow(run, out)


def _bytes_of(row: dict) -> bytes:
    """The stream of one run: its schema and dictionaries, its batches, and an end."""
    system, name = _opened(row["file_path"])
    with system.open_input_file(name) as file:
        return b"".join([*(file.read_at(n, at) for at, n in row["head"]), file.read_at(row["end"] - row["begin"], row["begin"]), _END])


def _schema_of(row, exact_ns: bool) -> T.StructType:
    system, name = _opened(row["file_path"])
    with system.open_input_file(name) as file:
        at, n = row["head"][0]
        found = pa.ipc.open_stream(pa.BufferReader(file.read_at(n, at) + _END)).schema
    return from_arrow_schema(spark_arrow_schema(found, exact_ns), prefer_timestamp_ntz=True)
