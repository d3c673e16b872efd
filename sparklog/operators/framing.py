"""Byte streams to messages, and messages to byte streams.

Modes: ``auto`` (the default), ``line`` and ``len`` are strict; ``auto_live``,
``line_live`` and ``len_live`` follow what a running TCP reader does. They
differ in what they trim, in empty messages, and in a length frame that is
not whole yet: strict waits for the rest, live cuts at a newline.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklog.operators import long_streams, slices

MODES = ("auto", "line", "len", "auto_live", "line_live", "len_live")
MOST_BYTES = 10_000_000
#: Rows of a key from which on it may be packed in slices.
SLICE_ROWS = 1_000_000
#: Bytes of a slice of such a key.
PACK_BYTES = 1 << 26
_PREFIX = re.compile(rb"([0-9]{1,10}) ")


class FrameOverflow(ValueError):
    """More than MOST_BYTES without a whole frame."""


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"unknown framing {mode!r}; one of {MODES}")
    return mode


def split_frames(data: bytes, mode: str = "auto", on_overflow: str = "fail") -> tuple[list[bytes], bytes]:
    """(whole messages, what is left for the next bytes)."""
    live, by_length, by_line = mode.endswith("live"), not mode.startswith("line"), not mode.startswith("len")
    out, at, size = [], 0, len(data)
    while at < size:
        if by_length and (m := _PREFIX.match(data, at)):
            n = int(m[1])
            fits = live or 0 < n < MOST_BYTES
            if fits and m.end() + n <= size:
                out.append(data[m.end() : m.end() + n])
                at = m.end() + n
                continue
            if fits and not live:
                break
        if not by_line:
            break
        end = data.find(b"\n", at)
        if end < 0:
            break
        line = data[at:end].replace(b"\r", b"") if live else data[at:end].rstrip(b"\r \t")
        at = end + 1
        if line or live or mode == "line":
            out.append(line)
    rest = data[at:]
    if mode == "auto" and len(rest) > MOST_BYTES and not _waits(rest):
        if on_overflow == "fail":
            raise FrameOverflow(f"{len(rest)} bytes without a frame")
        rest = b""
    return out, rest


def _waits(rest: bytes) -> bool:
    m = _PREFIX.match(rest)
    return bool(m) and 0 < int(m[1]) < MOST_BYTES


class Walk:
    """The messages of one connection, chunk by chunk.

    Chunks are gathered until the length that a frame has announced is there,
    or else a newline, so no byte is looked at more than a few times. Over
    MOST_BYTES that wait are an error in every mode, or with ``drop`` go.

    ``marks`` and ``stored`` take up a walk where another one stopped: stored
    gives the chunks that wait, and is asked for them only if they are needed.
    """

    def __init__(self, mode: str = "auto", on_overflow: str = "fail", marks: tuple[int, int, bool] | None = None, stored: Callable[[], list[bytes]] = list):
        self.mode, self.on_overflow, self.stored = mode, on_overflow, stored
        self.parts: list[bytes] = []
        self.scans = 0
        self.size, self.need, self.idle = marks or (0, 0, mode.startswith("line"))

    @property
    def marks(self) -> tuple[int, int, bool]:
        """Bytes that wait, bytes that a frame needs, and whether only a newline can end what waits."""
        return self.size, self.need, self.idle

    def rest(self) -> bytes:
        return b"".join([*self.stored(), *self.parts])

    def _keep(self, rest: bytes) -> None:
        self.stored, self.parts, self.size, self.need = list, [rest] if rest else [], len(rest), 0
        prefix = None if self.mode.startswith("line") else _PREFIX.match(rest)
        # Strict frames that are too long are lines.
        if prefix and (self.mode.endswith("live") or _waits(rest)):
            self.need = prefix.end() + int(prefix[1])
        # Bytes that can't be a length any more are a line, which only a newline ends, or nothing does.
        self.idle = self.mode.startswith("line") or (not prefix and len(rest) > 11)

    def _overflow(self) -> list[bytes]:
        size = self.size
        self._keep(b"")
        self.scans += 1
        if self.on_overflow == "fail":
            raise FrameOverflow(f"{size} bytes without a frame; the most is {MOST_BYTES}")
        return []

    def feed(self, chunk: bytes) -> list[bytes]:
        self.parts.append(chunk)
        self.size += len(chunk)
        # A length frame that is not whole waits; in auto_live a newline in the new bytes ends it too.
        waits = self.size < self.need and not (self.mode == "auto_live" and b"\n" in chunk)
        if waits or (self.idle and (self.mode.startswith("len") or b"\n" not in chunk)):
            return self._overflow() if self.size > MOST_BYTES + 11 else []
        self.scans += 1
        out, rest = split_frames(self.rest(), self.mode, self.on_overflow)
        self._keep(rest)
        return out + self._overflow() if self.size > MOST_BYTES + 11 else out


def line_frames(df: DataFrame, payload: str = "payload", strict: bool = False) -> DataFrame:
    """Rows of text blobs -> a row for each whole line: msg_no, payload; an unfinished last line is dropped.

    Live lines lose every carriage return, strict ones their trailing carriage
    returns, blanks and tabs. Column expressions only, so blobs must be UTF-8.
    """
    text = F.col(payload).cast("string")
    lines = F.split(text if strict else F.translate(text, "\r", ""), "\n", -1)
    lines = F.slice(lines, F.lit(1), F.size(lines) - 1)
    out = df.select(*(c for c in df.columns if c != payload), F.posexplode(lines).alias("msg_no", payload))
    return out.withColumn(payload, F.regexp_replace(payload, r"[\r \t]+$", "")) if strict else out


def frames(df: DataFrame, payload: str = "payload", mode: str = "auto", on_overflow: str = "fail") -> DataFrame:
    """Rows of whole streams -> a row for each message: the other columns, msg_no, payload (bytes)."""
    check_mode(mode)
    at = df.columns.index(payload)
    rows = df.withColumn(payload, F.col(payload).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]):
        return _split_batches(batches, at, mode, on_overflow)

    fields = [f for f in rows.schema.fields if f.name != payload]
    return rows.mapInArrow(run, T.StructType([*fields, T.StructField("msg_no", T.LongType()), T.StructField(payload, T.BinaryType())]))


#: Bytes of messages that leave a Python worker at once, so that those of a whole batch do not pile up in it.
PART_BYTES = 1 << 22


def _split_batches(batches: Iterator[pa.RecordBatch], at: int, mode: str, on_overflow: str) -> Iterator[pa.RecordBatch]:
    """Batches with whole streams in column ``at`` -> the other columns, msg_no and the messages, some PART_BYTES at once."""
    for b in batches:
        names = b.schema.names
        others, names = [c for j, c in enumerate(b.columns) if j != at], [*(n for j, n in enumerate(names) if j != at), "msg_no", names[at]]
        take, number, found, held = [], [], [], 0

        def part() -> pa.RecordBatch:
            index = pa.array(take, pa.int64())
            return pa.RecordBatch.from_arrays([*(c.take(index) for c in others), pa.array(number, pa.int64()), pa.array(found, pa.binary())], names=names)

        for i, x in enumerate(b.column(at)):
            # Many short messages weigh by their number.
            for k, m in enumerate(split_frames(x.as_py() or b"", mode, on_overflow)[0]):
                take.append(i), number.append(k), found.append(m)
                held += len(m) + 64
                if held >= PART_BYTES:
                    yield part()
                    take, number, found, held = [], [], [], 0
        if found:
            yield part()


def reframe(df: DataFrame, conn: str = "conn", seq: str = "seq", payload: str = "bytes", mode: str = "auto", on_overflow: str = "fail", tail: bool = False, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Chunks of connections, ordered by seq -> conn, msg_no, payload; what is unfinished at a connection's end is dropped, or with ``tail`` a row with msg_no null.

    Partitions hold whole connections, sorted by seq, and are walked through
    batch by batch: what is kept is the unfinished frame, however long a
    connection is. An empty frame stays a message where the mode keeps it. A
    connection of over slice_rows chunks, which are more than a task's share of
    all, is framed in slices (see ``long_streams``), unless seq is no number
    or time, the mode is ``auto_live``, whose frames depend on the chunks, or
    what overflows is to be dropped.
    """
    check_mode(mode)
    kind = dict(df.dtypes)[conn]
    rows = df.select(F.col(conn).alias("conn"), F.col(seq).alias("seq"), F.col(payload).cast("binary").alias("bytes"))
    if mode != "auto_live" and on_overflow == "fail" and not kind.startswith(("struct", "array", "map")) and (large := slices.large_keys(rows, "conn", "seq", F.octet_length("bytes"), slice_rows, long_streams.SLICE_BYTES)):
        mine = F.coalesce(F.col("conn").isin([k for k, _ in large if k is not None]), F.lit(None in [k for k, _ in large]))
        long_ = long_streams.reframe_long(rows.where(mine), large, mode, MOST_BYTES, functools.partial(split_frames, mode=mode), tail)
        return _reframed(rows.where(~mine), kind, mode, on_overflow, tail).unionByName(long_)
    return _reframed(rows, kind, mode, on_overflow, tail)


def _reframed(rows: DataFrame, kind: str, mode: str, on_overflow: str, tail: bool) -> DataFrame:
    rows = rows.repartition("conn").sortWithinPartitions("conn", "seq")

    def run(batches: Iterator[pa.RecordBatch]):
        current, walk, number, begun = None, Walk(mode, on_overflow), 0, False
        for b in batches:
            conns, numbers, found = [], [], []

            def end():
                if tail and begun and (rest := walk.rest()):
                    conns.append(current), numbers.append(None), found.append(rest)

            for c, x in zip(b.column(0).to_pylist(), b.column(2)):
                if not begun or c != current:
                    end()
                    current, walk, number, begun = c, Walk(mode, on_overflow), 0, True
                for g in walk.feed(x.as_py() or b""):
                    conns.append(current), numbers.append(number), found.append(g)
                    number += 1
            yield pa.RecordBatch.from_arrays([pa.array(conns, b.column(0).type), pa.array(numbers, pa.int64()), pa.array(found, pa.binary())], names=["conn", "msg_no", "payload"])
        if tail and begun and (rest := walk.rest()):
            yield pa.RecordBatch.from_arrays([pa.array([current], b.column(0).type), pa.array([None], pa.int64()), pa.array([rest], pa.binary())], names=["conn", "msg_no", "payload"])

    return rows.mapInArrow(run, f"conn {kind}, msg_no long, payload binary")


PACK_RULES = {"before": "close a batch before the event that would exceed it", "after": "close it after the event that reaches the budget"}


def pack_batches(df: DataFrame, key: str, order: str, payload: str = "payload", max_rows: int = 128, max_bytes: int = 64 * 1024, rule: str = "before", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """df with batch_no, greedy batches of at most max_rows and about max_bytes within each key, by order.

    ``before`` closes a batch before the event that would exceed it; an event
    over the budget has a batch to itself. ``after`` closes it once the budget
    is reached. Partitions of whole keys are walked through batch by batch,
    and what is kept is one count and one sum. A key with over slice_rows rows
    that holds more than a task's share of all rows is packed in slices, see
    ``slices``; order must then be a number or a time.
    """
    if rule not in PACK_RULES:
        raise ValueError(f"unknown rule {rule!r}; one of {sorted(PACK_RULES)}")
    rows = df.withColumn("_size", F.octet_length(payload))
    # Slices are much longer than a batch, so that few batches span one.
    if large := slices.large_keys(rows, key, order, F.col("_size"), slice_rows, max(PACK_BYTES, 16 * max_bytes), 16 * max_rows):
        names = [k for k, _ in large if k is not None]
        mine = F.coalesce(F.col(key).isin(names), F.lit(None in [k for k, _ in large]))
        packed = slices.pack_large(rows.where(mine), key, order, "_size", large, max_rows, max_bytes, rule)
        return _packed(rows.where(~mine), df, key, order, max_rows, max_bytes, rule).unionByName(packed.select(*df.columns, "batch_no"))
    return _packed(rows, df, key, order, max_rows, max_bytes, rule)


def _packed(rows: DataFrame, df: DataFrame, key: str, order: str, max_rows: int, max_bytes: int, rule: str) -> DataFrame:
    rows = rows.repartition(key).sortWithinPartitions(key, order)
    key_at, size_at = rows.columns.index(key), rows.columns.index("_size")

    def run(batches: Iterator[pa.RecordBatch]):
        begun, current, batch, n, total = False, None, 0, 0, 0
        for b in batches:
            out = []
            for k, size in zip(b.column(key_at).to_pylist(), b.column(size_at).to_pylist()):
                size = size or 0
                if not begun or k != current:
                    begun, current, batch, n, total = True, k, 0, 0, 0
                full = n >= max_rows or (n and (total + size > max_bytes if rule == "before" else total >= max_bytes))
                if full:
                    batch, n, total = batch + 1, 0, 0
                n, total = n + 1, total + size
                out.append(batch)
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(b.columns) if i != size_at), pa.array(out, pa.int64())], names=[*(c for c in b.schema.names if c != "_size"), "batch_no"])

    return rows.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("batch_no", T.LongType())]))


def merge_batches(df: DataFrame, key: str, order: str, payload: str = "payload", framing: str = "line") -> DataFrame:
    """Rows with batch_no -> key, batch_no, payload: the framed payloads of a batch in order, one after the other."""
    from sparklog.functions.payload import frame_length, frame_line

    framed = {"line": frame_line, "len": frame_length}[framing](F.col(payload).cast("string"))
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), framed.alias("p"))))
    return df.groupBy(key, "batch_no").agg(F.array_join(F.transform(parts, lambda x: x["p"]), "").alias(payload))


def with_reader(df: DataFrame, conn: str, order: str, readers: int) -> DataFrame:
    """A table of one row for each connection -> with reader: the number of the reader it goes to, in turn by arrival.

    Connections are numbered in ranges of the order; a range's rows follow
    those of the ranges before it, of which a row each is counted together.
    """
    from pyspark.sql import Window as W

    if not 1 <= readers <= 16:
        raise ValueError("readers must be 1 to 16")
    ranges = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = df.agg(F.percentile_approx(order, [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0] if ranges > 1 else []
    span = F.size(F.filter(F.array(*map(F.lit, sorted(set(cuts or [])))).cast(f"array<{dict(df.dtypes)[order]}>"), lambda c: c < F.col(order)))
    rows = df.withColumn("_span", F.when(F.col(order).isNull(), F.lit(-1)).otherwise(span))
    before = rows.groupBy("_span").agg(F.count("*").alias("_n"))
    before = before.select("_span", F.coalesce(F.sum("_n").over(W.orderBy("_span").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    number = F.row_number().over(W.partitionBy("_span").orderBy(order, conn)) - 1
    return rows.withColumn("_no", number).join(F.broadcast(before), "_span").withColumn("reader", F.pmod(F.col("_no") + F.col("_before"), F.lit(readers)).cast("long")).select(*df.columns, "reader")


