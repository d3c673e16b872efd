"""Rows to TCP and syslog receivers.

``tcp_lines`` sends text (or with ``protocol`` arrow, streams and frames);
``syslog_out`` sends RFC 3164 messages. Each partition has one connection. A
send that fails waits and connects anew, 1 s at first and twice as long each
time up to 30 s; after the given attempts the task fails and Spark runs it
again, so delivery is at least once.
"""

from __future__ import annotations

import socket
import time
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from sparklog.functions.syslog import encode_rfc3164
from sparklog.sinks.options import syslog_options, tcp_options
from sparklog.sources.arrow import encode_frame, encode_stream

MOST_ROWS, MOST_BYTES, MOST_WAIT = 128, 64 * 1024, 30.0


@dataclass
class Sent(WriterCommitMessage):
    rows: int
    bytes: int


def frame(payload: bytes, framing: str) -> bytes:
    if framing == "len":
        return b"%d " % len(payload) + payload
    return payload if payload.endswith(b"\n") else payload + b"\n"


class Connection:
    """A TCP connection, or a UDP socket, that connects anew after an error."""

    def __init__(self, addr: str, port: int, udp: bool = False, attempts: int = 6, first_wait: float = 1.0):
        self.to, self.udp, self.attempts, self.first_wait = (addr, port), udp, attempts, first_wait
        self.socket: socket.socket | None = None

    def send(self, data: bytes) -> None:
        wait = self.first_wait
        for left in range(self.attempts, 0, -1):
            try:
                if self.socket is None:
                    if self.udp:
                        family, kind, proto, _, to = socket.getaddrinfo(*self.to, type=socket.SOCK_DGRAM)[0]
                        self.socket = socket.socket(family, kind, proto)
                        self.socket.connect(to)
                    else:
                        self.socket = socket.create_connection(self.to, 30)
                self.socket.sendall(data)
                return
            except OSError:
                self.close()
                if left == 1:
                    raise
                time.sleep(wait)
                wait = min(2 * wait, MOST_WAIT)

    def close(self) -> None:
        if self.socket is not None:
            self.socket.close()
            self.socket = None


def batches_of(payloads: Iterator[bytes], most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES) -> Iterator[list[bytes]]:
    """Greedy batches; one that is over the budget goes alone."""
    batch, size = [], 0
    for p in payloads:
        if batch and (len(batch) >= most_rows or size + len(p) > most_bytes):
            yield batch
            batch, size = [], 0
        batch.append(p)
        size += len(p)
    if batch:
        yield batch


def wire_batches(df: DataFrame, key: str, order: str, payload: str = "payload", framing: str = "line") -> DataFrame:
    """What a connection for each key would send, in order: key, batch_no, n (rows), data (bytes)."""
    rows = df.select(F.col(key).alias("key"), F.col(order).alias("order"), F.col(payload).cast("binary").alias("p"))
    rows = rows.repartition("key").sortWithinPartitions("key", "order")

    def run(batches: Iterator[pa.RecordBatch]):
        found = ((k, p.as_py() or b"") for b in batches for k, p in zip(b.column(0).to_pylist(), b.column(2)))
        for k, of_key in groupby(found, lambda x: x[0]):
            for i, batch in enumerate(batches_of(frame(p, framing) for _, p in of_key)):
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([i]), pa.array([len(batch)]), pa.array([b"".join(batch)], pa.binary())], names=["key", "batch_no", "n", "data"])

    return rows.mapInArrow(run, f"key {rows.dtypes[0][1]}, batch_no long, n long, data binary")


def arrow_data(b: pa.RecordBatch, data_format: str, tag: str = "", tag_column: str | None = None) -> Iterator[tuple[int, bytes]]:
    """(rows, bytes) of each message for a batch: one, or one for each tag."""
    if not b.num_rows:
        return
    parts = [(tag, b)]
    if tag_column:
        tags = b.column(b.schema.get_field_index(tag_column)).to_pylist()
        rest = b.select([n for n in b.schema.names if n != tag_column])
        parts = [(t or "", rest.filter(pa.array([x == t for x in tags]))) for t in dict.fromkeys(tags)]
    for t, part in parts:
        yield part.num_rows, frame(encode_frame(t, [part]), "len") if data_format == "arrow_framed" else encode_stream([part])


def arrow_messages(df: DataFrame, data_format: str = "arrow_ipc", tag: str = "", tag_column: str | None = None) -> DataFrame:
    """What Arrow connections would send for df: data (bytes), a row for each message."""

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for _, data in arrow_data(b, data_format, tag, tag_column):
                yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["data"])

    return df.mapInArrow(run, "data binary")


def _bytes(value) -> bytes:
    return b"" if value is None else bytes(value) if isinstance(value, (bytes, bytearray)) else value.encode()


class _Text:
    def __init__(self, options: dict, udp: bool = False, framing: str = "line"):
        self.options, self.udp, self.framing = options, udp, framing

    def write(self, iterator: Iterator) -> Sent:
        o, rows, total = self.options, 0, 0
        conn = Connection(o["addr"], o["port"], self.udp, o["attempts"], o["first_wait"])
        try:
            payloads = (_bytes(row[0]) for row in iterator)
            if self.udp:
                for p in payloads:
                    conn.send(p)
                    rows, total = rows + 1, total + len(p)
            else:
                for batch in batches_of(frame(p, self.framing) for p in payloads):
                    conn.send(b"".join(batch))
                    rows, total = rows + len(batch), total + sum(map(len, batch))
        finally:
            conn.close()
        return Sent(rows, total)

    def commit(self, messages, batchId=None) -> None:
        pass

    def abort(self, messages, batchId=None) -> None:
        pass


class TextWriter(_Text, DataSourceWriter):
    pass


class TextStreamWriter(_Text, DataSourceStreamWriter):
    pass


class _Arrow(_Text):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> Sent:
        o, rows, total = self.options, 0, 0
        conn = Connection(o["addr"], o["port"], False, o["attempts"], o["first_wait"])
        try:
            for b in iterator:
                for n, data in arrow_data(b, o["data_format"], o["tag"], o["tag_column"]):
                    conn.send(data)
                    rows, total = rows + n, total + len(data)
        finally:
            conn.close()
        return Sent(rows, total)


class ArrowTcpWriter(_Arrow, DataSourceArrowWriter):
    pass


class ArrowTcpStreamWriter(_Arrow, DataSourceStreamArrowWriter):
    pass


class TcpLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tcp_lines"

    def _make(self, schema: StructType, text, arrow):
        o = tcp_options(dict(self.options))
        if o["protocol"] == "arrow":
            if [f.dataType.simpleString() for f in schema.fields] == ["string"] and schema.fieldNames() == ["value"]:
                raise ValueError("protocol arrow sends typed columns, not lines of text")
            return arrow(o)
        if len(schema.fields) != 1:
            raise ValueError("tcp_lines sends one column of text or bytes; see format_lines")
        return text(o, False, o["framing"])

    def writer(self, schema: StructType, overwrite: bool):
        return self._make(schema, TextWriter, ArrowTcpWriter)

    def streamWriter(self, schema: StructType, overwrite: bool):
        return self._make(schema, TextStreamWriter, ArrowTcpStreamWriter)


class SyslogOut(DataSource):
    """One column of encoded messages; see to_syslog."""

    @classmethod
    def name(cls) -> str:
        return "syslog_out"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        o = syslog_options(dict(self.options))
        return TextWriter(o, o["protocol"] == "udp")

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        o = syslog_options(dict(self.options))
        return TextStreamWriter(o, o["protocol"] == "udp")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TcpLines)
    spark.dataSource.register(SyslogOut)


def to_syslog(df: DataFrame, message: str, ts: str, app_name: str = "sparklog", pri: int = 13, host: str = "localhost", keep: tuple[str, ...] = ()) -> DataFrame:
    """value: the rows' messages as RFC 3164 lines, behind the columns to keep."""
    return df.select(*keep, encode_rfc3164(F.col(message).cast("string"), F.col(ts), pri, host, app_name).alias("value"))


def write_syslog(df: DataFrame, message: str, ts: str, **options: str | int) -> None:
    """Encode and send; options are those of syslog_out."""
    texts = {k: str(v) for k, v in options.items()}
    register(df.sparkSession)
    to_syslog(df, message, ts, syslog_options(texts)["app_name"]).write.format("syslog_out").options(**texts).mode("append").save()
