"""Framing of connections that are too long for one task.

Where a frame begins depends on all bytes before it. So a long connection is
cut into slices by the order of its chunks, and each slice works out, for every
byte at which a frame might begin, where the chain of frames from there leaves
the slice. Frames soon fall into step, so few such places differ; the next
slices answer for those, and the true ones are found by following them from the
connection's start, a step for each slice. Then all slices cut their frames at
once. A frame that lies in several slices is put together at the end.

This holds for the modes whose frames do not depend on how the bytes came in
chunks: all but ``auto_live``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_type

from sparklog.operators import slices

#: Bytes behind a slice that may belong to a length that begins in it.
AHEAD = 11


#: Bytes of a slice; one takes some twenty times as much while it is worked on.
SLICE_BYTES = 1 << 21


class Piece:
    """The bytes of a slice, and where the frames that begin in it end.

    From all bytes between two newlines that announce no length the same line
    end is next. So only the ends of frames and the bytes that announce a
    length are told apart.
    """

    def __init__(self, data: bytes, begin: int, total: int, ahead: bytes, newline: int | None, mode: str, most_bytes: int):
        self.data, self.begin, self.n = data, begin, len(data)
        live, by_length, by_line = mode.endswith("live"), not mode.startswith("line"), not mode.startswith("len")
        raw = np.frombuffer(data + ahead, np.uint8)
        none = np.zeros(0, np.int64)
        self.lines = np.append(np.flatnonzero(raw[: self.n] == 10) + begin + 1 if by_line else none, -1 if newline is None or not by_line else newline + 1)
        self.headed, self.ends = none, none
        if by_length:
            found = []
            # The digits before each space, from the last one backwards.
            space, size = np.flatnonzero(raw == 32), 0
            at = space
            for k in range(10):
                at = at - 1
                digit = (at >= 0) & (raw[np.maximum(at, 0)] >= 48) & (raw[np.maximum(at, 0)] <= 57)
                space, at, size = space[digit], at[digit], np.broadcast_to(size, digit.shape)[digit]
                size = size + (raw[at].astype(np.int64) - 48) * 10**k
                valid = at < self.n if live else (at < self.n) & (size > 0) & (size < most_bytes)
                found.append((at[valid], begin + space[valid] + 1 + size[valid]))
            heads, ends = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(heads)
            self.headed, self.ends = heads[order], np.where(ends[order] <= total, ends[order], -1)
        inner = np.concatenate((self.lines[:-1], self.ends)) - begin
        self.marks = np.unique(np.concatenate((inner[(inner >= 0) & (inner < self.n)], self.headed)))
        # From each mark along the frames to the last one that begins in the slice.
        self.to = self.next(self.marks)
        inside = self.to - begin
        inside_ = (inside >= 0) & (inside < self.n)
        at = np.arange(len(self.marks))
        at[inside_] = np.searchsorted(self.marks, inside[inside_])
        while not np.array_equal(further := at[at], at):
            at = further
        self.last = at

    def next(self, at: np.ndarray) -> np.ndarray:
        """Where the frame from each byte ends; -1 where it is not whole."""
        out = self.lines[np.searchsorted(self.lines[:-1], at + self.begin, "right")]
        if len(self.headed):
            k = np.minimum(np.searchsorted(self.headed, at), len(self.headed) - 1)
            out = np.where(self.headed[k] == at, self.ends[k], out)
        return out

    def leaves(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last frame that begins in the slice, of the chain from each byte, and where it ends; -1 where it is not whole."""
        to = self.next(at)
        inside = (to >= self.begin) & (to - self.begin < self.n)
        head, k = at.copy(), self.last[np.searchsorted(self.marks, to[inside] - self.begin)]
        head[inside], to[inside] = self.marks[k], self.to[k]
        return head, to

    def exits(self) -> np.ndarray:
        """Where the chain of frames from each byte leaves the slice; -1 where it ends in a frame that is not whole."""
        return self.leaves(np.arange(self.n))[1]

    def distinct_exits(self) -> np.ndarray:
        """What exits holds, each once."""
        # A byte that is no mark leads to one, or to what the last byte but those that announce a length leads to.
        found = np.unique(np.concatenate((self.to[self.last], self.lines[-1:])))
        return found[found >= 0]


def reframe_long(rows: DataFrame, cuts: list[tuple], mode: str, most_bytes: int, split, tail: bool) -> DataFrame:
    """rows(conn, seq, bytes) of the connections that cuts names -> conn, msg_no, payload; split(bytes) takes whole frames apart."""
    key = T.StructField("key", rows.schema["conn"].dataType)
    n = sum(len(c) + 1 for _, c in cuts)
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // 4)
    named = slices.with_slice(rows, "conn", "seq", cuts).select(F.col("r.conn").alias("key"), F.col("at").alias("slice"), F.col("r.seq").alias("order"), F.coalesce("r.bytes", F.lit(b"")).alias("bytes"))

    def of(head: T.StructField, more: str) -> T.StructType:
        return T.StructType([head, *T.StructType.fromDDL(more).fields])

    def joined(b: pa.RecordBatch):
        data = b"".join(x.as_py() or b"" for x in b.column(3))
        first = data.find(b"\n")
        yield pa.RecordBatch.from_arrays([b.column(0).slice(0, 1), b.column(1).slice(0, 1), pa.array([len(data)], pa.int64()), pa.array([data[:AHEAD]], pa.binary()), pa.array([first if first >= 0 else None], pa.int64()), pa.array([data], pa.binary())], names=["key", "slice", "size", "first", "line", "data"])

    # A row for each slice from here on; its bytes are moved and sorted once.
    sorted_ = named.repartition(parts, "key", "slice").sortWithinPartitions("key", "slice", "order")
    whole = slices._walked(sorted_, "key", joined, of(key, "slice int, size long, first binary, line long, data binary")).persist(StorageLevel.DISK_ONLY)
    by = W.partitionBy("key").orderBy("slice")
    before = by.rowsBetween(W.unboundedPreceding, -1)
    summary = whole.drop("data").withColumn("begin", F.coalesce(F.sum("size").over(before), F.lit(0))).withColumn("total", F.sum("size").over(W.partitionBy("key")))
    following = F.concat(*(F.coalesce(F.lead("first", k).over(by), F.lit(b"")) for k in range(1, AHEAD + 1)))
    summary = summary.withColumn("ahead", F.substring(following, 1, AHEAD)).withColumn("newline", F.first(F.col("begin") + F.col("line"), ignorenulls=True).over(by.rowsBetween(1, W.unboundedFollowing))).persist()

    def known(side: DataFrame, *more: str) -> DataFrame:
        """Slices with what side knows of them: key, slice, data, more."""
        return whole.alias("a").join(F.broadcast(side).alias("b"), slices._same("a", "b", ["key", "slice"])).select("a.key", "a.slice", "a.data", *(f"b.{c}" for c in more))

    def mapped(df: DataFrame, more: str, run) -> DataFrame:
        """run(the other columns of a row) -> rows, to which the key is added."""
        out = of(key, more)
        names, types = out.names, [to_arrow_type(f.dataType) for f in out.fields[1:]]

        def each(batches):
            for b in batches:
                for i in range(b.num_rows):
                    found = run(*(c[i].as_py() for c in b.columns[1:]))
                    columns = zip(*found) if found else [()] * len(types)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([i] * len(found), pa.int64())), *(pa.array(c, t) for c, t in zip(columns, types))], names=names)

        return df.mapInArrow(each, out)

    def left(_, data, begin, total, ahead, newline):
        return [(int(x),) for x in Piece(data, begin, total, ahead, newline, mode, most_bytes).distinct_exits()]

    facts = ("begin", "total", "ahead", "newline")
    exits = mapped(known(summary, *facts), "at long", left)
    starts = summary.select("key").distinct().select("key", F.lit(0).cast("long").alias("at"))
    asked = exits.unionByName(starts).distinct().select("key", "at", F.lit(None).cast("int").alias("slice"), F.lit(None).cast("long").alias("end"))
    # Each place lies in the slice that begins last before it.
    places = asked.unionByName(summary.where("size > 0").select("key", F.col("begin").alias("at"), "slice", (F.col("begin") + F.col("size")).alias("end")))
    held = F.last(F.when(F.col("slice").isNotNull(), F.struct("slice", "end")), ignorenulls=True).over(W.partitionBy("key").orderBy("at", F.col("slice").isNull()).rowsBetween(W.unboundedPreceding, 0))
    entries = places.withColumn("in", held).where(F.col("slice").isNull() & (F.col("at") < F.col("in.end"))).groupBy("key", "in.slice").agg(F.collect_set("at").alias("entries"))
    asked = summary.alias("s").join(entries.alias("e"), slices._same("s", "e", ["key", "slice"])).select("s.*", "e.entries")

    def answered(_, data, begin, total, ahead, newline, given):
        p = Piece(data, begin, total, ahead, newline, mode, most_bytes)
        heads, to = p.leaves(np.array(given, np.int64) - begin)
        return list(zip(given, (heads + begin).tolist(), to.tolist()))

    edges = mapped(known(asked, *facts, "entries"), "at long, last long, to long", answered)
    chained = of(key, "slice int, begin long, entry long, last long, to long, owner int, until long")
    chain = summary.select("key", "slice", "begin", "size", "total").groupBy("key").cogroup(edges.groupBy("key")).applyInPandas(_chain, chained).persist()

    def own(data, begin, entry, last, to) -> tuple[bytes, bytes]:
        """The frames that begin and end in a slice, and what it has of the one that goes on."""
        if entry < 0:
            return b"", b""
        at = len(data) if 0 <= to <= begin + len(data) else last - begin
        return data[entry - begin : at], data[at:]

    def ended(slice_, data, begin, entry, last, to, owner, until):
        mine, rest = own(data, begin, entry, last, to)
        out = [(slice_, slice_, len(split(mine)[0]), None, None)]
        # What a frame of an earlier slice has here.
        if owner >= 0 and until > begin:
            out.append((slice_, owner, None, data[: until - begin], None))
        if rest:
            out.append((slice_, slice_, None, rest, to >= 0))
        return out

    marks = ("begin", "entry", "last", "to")
    found = mapped(known(chain, *marks, "owner", "until"), "slice int, owner int, own long, payload binary, whole boolean", ended).persist()
    parts_ = found.where("own IS NULL").groupBy("key", "owner").agg(F.sort_array(F.collect_list(F.struct("slice", "payload"))).alias("parts"), F.max("whole").alias("whole"))

    def finished(owner, parts, whole):
        data = b"".join(x["payload"] for x in parts)
        return [(owner, True, m) for m in split(data)[0]] if whole else [(owner, False, data)]

    across = mapped(parts_, "slice int, whole boolean, payload binary", finished).persist()
    counts = found.where("own IS NOT NULL").select("key", "slice", "own", F.lit(0).cast("long").alias("more"))
    counts = counts.unionByName(across.where("whole").groupBy("key", "slice").agg(F.count("*").alias("more")).withColumn("own", F.lit(0).cast("long")))
    counts = counts.groupBy("key", "slice").agg(F.sum("own").alias("own"), F.sum("more").alias("more"))
    counts = counts.withColumn("before", F.coalesce(F.sum(F.col("own") + F.col("more")).over(before), F.lit(0))).persist()
    same = slices._same("m", "c", ["key", "slice"])

    def numbered(_, data, begin, entry, last, to, first):
        return list(enumerate(split(own(data, begin, entry, last, to)[0])[0], first))

    told = chain.alias("m").join(counts.alias("c"), same).where("c.own > 0").select("m.*", "c.before")
    out = mapped(known(told, *marks, "before"), "msg_no long, payload binary", numbered).withColumnRenamed("key", "conn")
    out = out.unionByName(across.where("whole").alias("m").join(F.broadcast(counts).alias("c"), same).select(F.col("m.key").alias("conn"), (F.col("c.own") + F.col("c.before")).alias("msg_no"), "m.payload"))
    if tail:
        out = out.unionByName(across.where("NOT whole AND octet_length(payload) > 0").select(F.col("key").alias("conn"), F.lit(None).cast("long").alias("msg_no"), "payload"))
    return out


def _chain(parts: pd.DataFrame, steps: pd.DataFrame) -> pd.DataFrame:
    """The slices of one connection and their answers -> where the first and the last frame of each slice begin, where the latter ends, and up to where the slice holds the rest of a frame of an earlier one."""
    known = {x[0]: x[1:] for x in steps[["at", "last", "to"]].itertuples(index=False)}
    parts = parts.sort_values("slice")
    at, owner, until, out = 0, -1, 0, []
    for s, begin, size, total in parts[["slice", "begin", "size", "total"]].itertuples(index=False):
        entry = at if begin <= at < begin + size else -1
        last, to = known[at] if entry >= 0 else (-1, -1)
        out.append((s, begin, entry, last, to, owner if until > begin else -1, until))
        if entry >= 0:
            owner, at = s, to
            until = total if at < 0 else at
    columns = ("slice", "begin", "entry", "last", "to", "owner", "until")
    return pd.DataFrame({"key": pd.Series([parts["key"].iloc[0]] * len(out), dtype=parts["key"].dtype), **{c: [x[k] for x in out] for k, c in enumerate(columns)}})
