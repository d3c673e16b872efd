"""Framing and header operators on streams."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sparklog.operators.framing import Walk, check_mode

FRAME = Row("conn", "msg_no", "payload")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State with lists and timers needs Spark's RocksDB store; another store that was chosen is left."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if "HDFSBackedStateStoreProvider" in spark.conf.get(key, "HDFSBackedStateStoreProvider"):
        spark.conf.set(key, ROCKSDB)


class Reframer(StatefulProcessor):
    """State of a connection: the chunks that wait, each an element of a list, and the marks of the walk over them."""

    def __init__(self, mode: str, on_overflow: str, idle_ms: int | None, tail: bool):
        self.mode, self.on_overflow, self.idle_ms, self.tail = mode, on_overflow, idle_ms, tail

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getListState("chunks", "bytes binary")
        self.marks = handle.getValueState("marks", "size long, need long, idle boolean, number long, last long")

    def _stored(self) -> list[bytes]:
        return [bytes(x[0]) for x in self.chunks.get()]

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # Each call of the store is a message to Spark, and most connections are short: none is made that can be spared.
        size, need, idle, number, last = self.marks.get() or (0, 0, self.mode.startswith("line"), 0, None)
        walk = Walk(self.mode, self.on_overflow, (size, need, idle), self._stored if size else list)
        chunks = [(r[1], bytes(r[2] or b"")) for r in rows]
        if any(x[0] > y[0] for x, y in zip(chunks, chunks[1:])):
            chunks.sort(key=lambda x: x[0])
        found = []
        for s, b in chunks:
            if last is not None and s < last:
                raise ValueError(f"chunk {s} of connection {key[0]!r} came after chunk {last}")
            last = s
            for g in walk.feed(b):
                found.append(FRAME(key[0], number, g))
                number += 1
        # What still waits is added to; it is written anew only after a frame was taken from it.
        if walk.scans and size:
            self.chunks.clear()
        if walk.parts:
            self.chunks.appendList([(p,) for p in walk.parts])
        self.marks.update((*walk.marks, number, last))
        if self.idle_ms is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield from found

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        rest = b"".join(self._stored())
        self.chunks.clear()
        self.marks.clear()
        if rest and self.tail:
            yield FRAME(key[0], None, rest)

    def close(self) -> None:
        pass


def reframe_stream(
    chunks: DataFrame, conn: str = "conn", seq: str = "seq", payload: str = "bytes", mode: str = "auto", on_overflow: str = "fail", idle_seconds: float | None = None, tail: bool = False
) -> DataFrame:
    """Stream of chunks -> conn, msg_no, payload. The unfinished frame of each connection is its state, across micro-batches and restarts.

    Chunks of a micro-batch are put in the order of seq. A chunk that comes
    with a smaller seq than one already taken is an error: a connection's
    bytes have one order, and what was emitted cannot be taken back. What
    waits is bounded as in reframe.

    A connection from which nothing came for ``idle_seconds`` is forgotten;
    with ``tail`` what it left unfinished is a row with msg_no null. If it
    comes back it is a new one. Such a query runs until it is stopped: Spark
    looks for what has expired for ever, with trigger(availableNow) too.
    """
    check_mode(mode)
    use_rocksdb(chunks.sparkSession)
    kind = dict(chunks.dtypes)[conn]
    rows = chunks.select(F.col(conn).alias("conn"), F.col(seq).cast("long").alias("seq"), F.col(payload).cast("binary").alias("bytes"))
    idle_ms = None if idle_seconds is None else int(idle_seconds * 1000)
    return rows.groupBy("conn").transformWithState(
        Reframer(mode, on_overflow, idle_ms, tail), f"conn {kind}, msg_no long, payload binary", "Append", "None" if idle_ms is None else "ProcessingTime"
    )
