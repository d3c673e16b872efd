"""Greedy batches of keys that hold too many rows for one task.

Whether a row opens a batch depends on all rows before it. So a large key is
cut into slices by its order, and each slice says what it would hand on to the
next one (the rows and bytes of the batch that is open at its end) for every
state that it may be handed itself. Those are few, for one batch's rows at the
most are open. Following them from a key's start takes a step for each slice;
then each slice knows the state that it begins with.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W


class Slice:
    """Where batches open in a run of rows, for any state at its start."""

    def __init__(self, sizes: np.ndarray, max_rows: int, max_bytes: int, rule: str):
        self.n = len(sizes)
        self.sums = np.concatenate(([0], np.cumsum(sizes.astype(np.int64))))
        self.max_rows, self.max_bytes, self.before = max_rows, max_bytes, rule == "before"
        at = np.arange(self.n)
        self.next = np.maximum(at + 1, np.minimum(self._by_bytes(self.sums[:-1] + max_bytes), np.minimum(at + max_rows, self.n)))

    def _by_bytes(self, reach: np.ndarray) -> np.ndarray:
        """The row before which bytes up to ``reach`` close a batch."""
        return np.searchsorted(self.sums, reach, "right") - 1 if self.before else np.searchsorted(self.sums, reach, "left")

    def first(self, rows: int, bytes_: int) -> int:
        """The first row that opens a batch, with so much in the batch that is open; n if none does."""
        if rows == 0:
            return 0
        return min(max(0, min(int(self._by_bytes(np.array(self.max_bytes - bytes_))), self.max_rows - rows)), self.n)

    def last_heads(self) -> np.ndarray:
        """For each row, if it opens a batch, the row whose batch is open at the end."""
        last = np.arange(self.n)
        steps = self.next.tolist()
        out = last.tolist()
        for i in range(self.n - 1, -1, -1):
            if steps[i] < self.n:
                out[i] = out[steps[i]]
        return np.array(out, np.int64)

    def state(self, head: int) -> tuple[int, int]:
        return self.n - head, int(self.sums[-1] - self.sums[head])

    def end(self, rows: int, bytes_: int, last: np.ndarray) -> tuple[int, int]:
        """The state at the end for one at the start."""
        i = self.first(rows, bytes_)
        return (rows + self.n, bytes_ + int(self.sums[-1])) if i >= self.n else self.state(int(last[i]))

    def heads(self, rows: int, bytes_: int) -> np.ndarray:
        """Whether each row opens a batch."""
        out = np.zeros(self.n, bool)
        i, steps = self.first(rows, bytes_), self.next.tolist()
        while i < self.n:
            out[i] = True
            i = steps[i]
        return out


#: Cuts are looked through in blocks of so many.
_BLOCK = 64


def large_keys(rows: DataFrame, key: str, order: str, size: Column, slice_rows: int, slice_bytes: int, least_rows: int = 1) -> list[tuple] | None:
    """(key, cuts of its order) of the keys with over slice_rows rows and over their share of all rows for one task; so there are at most as many as tasks. None if order has no quantiles.

    Slices hold about slice_bytes, so they grow in number and not in size, but
    there are no more of them than lots of least_rows rows, nor fewer than tasks.
    """
    parts = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if not isinstance(rows.schema[order].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return None
    counts = rows.groupBy(key).agg(F.count("*").alias("_n"), F.sum(size).alias("_bytes")).persist()
    total, most = counts.agg(F.sum("_n"), F.max("_n")).first()
    share = max(slice_rows, (total or 0) // parts)
    large = counts.where(F.col("_n") > share).collect() if (most or 0) > share else []
    counts.unpersist()
    if not large:
        return []
    names = [r[0] for r in large]
    n = max(parts, *(min((r[2] or 0) // slice_bytes + 1, r[1] // least_rows) for r in large))
    mine = rows.where(F.col(key).isin([k for k in names if k is not None]) | (F.col(key).isNull() if None in names else F.lit(False)))
    found = mine.groupBy(key).agg(F.percentile_approx(order, [i / n for i in range(1, n)], 20 * n)).collect()
    return [(r[0], sorted(set(r[1] or []))) for r in found]


def with_slice(rows: DataFrame, key: str, order: str, cuts: list[tuple]) -> DataFrame:
    """Rows as ``r`` of the keys that cuts names -> with ``at``, the number of cuts of its key below each row's order."""
    fields = T.StructType([T.StructField("key", rows.schema[key].dataType), T.StructField("blocks", T.ArrayType(T.ArrayType(rows.schema[order].dataType)))])
    blocks = [(k, [c[i : i + _BLOCK] for i in range(0, len(c), _BLOCK)]) for k, c in cuts]
    named = F.broadcast(rows.sparkSession.createDataFrame(blocks, fields).alias("c"))
    x = F.col(f"r.{order}")
    below = lambda cut: cut < x
    both = rows.alias("r").join(named, F.col(f"r.{key}").eqNullSafe(F.col("c.key")))
    # A block whose first cut is below is whole below unless it is the last such one.
    both = both.withColumn("_block", F.size(F.filter("c.blocks", lambda b: b[0] < x)))
    at = (F.col("_block") - 1) * _BLOCK + F.size(F.filter(F.get("c.blocks", F.col("_block") - 1), below))
    return both.withColumn("at", F.when(x.isNull() | (F.col("_block") == 0), F.lit(0)).otherwise(at).cast("int"))


def _walked(rows: DataFrame, key: str, run: Callable[[list, pa.RecordBatch], Iterator], out: T.StructType | str) -> DataFrame:
    """Rows of whole slices, sorted -> what run makes of each slice, which is held at once: its rows as one batch."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None

        def whole() -> pa.RecordBatch:
            return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for b in batches:
            at = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            cuts = [0, *(i for i in range(1, len(at)) if at[i] != at[i - 1]), len(at)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                if held and at[start] != current:
                    yield from run(whole())
                    held = []
                current = at[start]
                held.append(b.slice(start, end - start))
        if held:
            yield from run(whole())

    return rows.mapInArrow(walk, out)


_STATES = "key {kind}, slice int, rows long, bytes long"


def _exits(sliced: DataFrame, kind: str, max_rows: int, max_bytes: int, rule: str) -> DataFrame:
    """sliced(key, slice, order, size) -> the states that may enter each slice but the first: those that the one before it may end with."""

    def run(b: pa.RecordBatch):
        s = Slice(b.column(3).to_numpy(), max_rows, max_bytes, rule)
        found = [s.state(h) for h in np.unique(s.last_heads()).tolist()]
        k, n = b.column(0).slice(0, 1), len(found)
        yield pa.RecordBatch.from_arrays([k.take(pa.array([0] * n, pa.int64())), pa.array([b.column(1)[0].as_py() + 1] * n, pa.int32()), *(pa.array(c, pa.int64()) for c in zip(*found))], names=["key", "slice", "rows", "bytes"])

    return _walked(sliced, "key", run, _STATES.format(kind=kind))


def _steps(sliced: DataFrame, states: DataFrame, kind: str, max_rows: int, max_bytes: int, rule: str) -> DataFrame:
    """The state that each slice ends with for each of states(key, slice, rows, bytes): the latter with to_rows, to_bytes. A slice's states come before its rows."""
    none = lambda t: F.lit(None).cast(t)
    order = sliced.schema["order"].dataType
    both = sliced.select("key", "slice", "order", "size", none("long").alias("rows"), none("long").alias("bytes")).unionByName(states.select("key", "slice", none(order).alias("order"), none("long").alias("size"), "rows", "bytes"))
    both = both.repartition("key", "slice").sortWithinPartitions("key", "slice", F.col("rows").isNull(), "order")

    def run(b: pa.RecordBatch):
        rows, bytes_ = b.column(4).to_pylist(), b.column(5).to_pylist()
        n = sum(x is not None for x in rows)
        if n == 0 or n == b.num_rows:
            return
        s = Slice(b.column(3).slice(n).to_numpy(), max_rows, max_bytes, rule)
        last = s.last_heads()
        ends = [s.end(r, x, last) for r, x in zip(rows[:n], bytes_[:n])]
        head = b.slice(0, n)
        yield pa.RecordBatch.from_arrays([head.column(0), head.column(1), head.column(4), head.column(5), *(pa.array(c, pa.int64()) for c in zip(*ends))], names=["key", "slice", "rows", "bytes", "to_rows", "to_bytes"])

    return _walked(both, "key", run, _STATES.format(kind=kind) + ", to_rows long, to_bytes long")


_NODE = ["key", "slice", "rows", "bytes"]


def _same(a: str, b: str, names: list[str] = _NODE):
    return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names]


def entry_states(sliced: DataFrame, max_rows: int, max_bytes: int, rule: str) -> DataFrame:
    """sliced(key, slice, order, size), sorted slices -> key, slice, rows, bytes: the state that each slice begins with."""
    kind = dict(sliced.dtypes)["key"]
    rule_ = (kind, max_rows, max_bytes, rule)
    ordered = sliced.repartition("key", "slice").sortWithinPartitions("key", "slice", "order")
    # Slices are numbered without gaps, so that each has the one before it as its neighbour.
    start = sliced.select("key").distinct().select("key", F.lit(0).alias("slice"), F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("bytes"))
    there = sliced.select("key", "slice").distinct().persist()
    fresh = start.unionByName(_exits(ordered, *rule_)).alias("s").join(there.alias("t"), _same("s", "t", ["key", "slice"]), "left_semi").distinct().persist()
    edges = None
    while True:
        found = _steps(sliced, fresh, *rule_).persist()
        edges = found if edges is None else edges.unionByName(found)
        # A batch that spans a whole slice ends in a state that nobody had foreseen.
        ends = found.select("key", (F.col("slice") + 1).alias("slice"), F.col("to_rows").alias("rows"), F.col("to_bytes").alias("bytes")).distinct()
        ends = ends.alias("s").join(there.alias("t"), _same("s", "t", ["key", "slice"]), "left_semi")
        fresh = ends.alias("s").join(edges.alias("e"), _same("s", "e"), "left_anti").persist()
        if fresh.isEmpty():
            break
    return edges.groupBy("key").applyInPandas(_followed, _STATES.format(kind=kind))


def _followed(steps: pd.DataFrame) -> pd.DataFrame:
    """The steps of one key, some for each of its slices -> those that lead on from its start."""
    to = {tuple(x[:3]): tuple(x[3:]) for x in steps[["slice", "rows", "bytes", "to_rows", "to_bytes"]].itertuples(index=False)}
    at, found = (0, 0, 0), []
    while at in to:
        found.append(at)
        at = (at[0] + 1, *to[at])
    return pd.DataFrame({"key": pd.Series([steps["key"].iloc[0]] * len(found), dtype=steps["key"].dtype), **{c: [x[k] for x in found] for k, c in enumerate(("slice", "rows", "bytes"))}})


def pack_large(rows: DataFrame, key: str, order: str, size: str, cuts: list[tuple], max_rows: int, max_bytes: int, rule: str) -> DataFrame:
    """The rows of the keys that cuts names -> rows with batch_no; each key is walked in slices of its order, all at once."""
    held = F.struct(*(F.col(f"r.{c}") for c in rows.columns if c != size)).alias("row")
    mine = with_slice(rows, key, order, cuts).select(F.col(f"r.{key}").alias("key"), "at", F.col(f"r.{order}").alias("order"), F.coalesce(F.col(f"r.{size}"), F.lit(0)).cast("long").alias("size"), held)
    # Cuts between which no row lies leave no gap in the numbers.
    seen = mine.groupBy("key", "at").agg(F.count("*").alias("n")).withColumn("slice", F.row_number().over(W.partitionBy("key").orderBy("at")) - 1).select("key", "at", "slice").persist()
    sliced = mine.alias("m").join(F.broadcast(seen).alias("s"), _same("m", "s", ["key", "at"])).select("m.key", "s.slice", "m.order", "m.size", "m.row")
    states = entry_states(sliced.select("key", "slice", "order", "size"), max_rows, max_bytes, rule).persist()
    kind = sliced.schema["row"]

    def opened(b: pa.RecordBatch):
        rows_, bytes_ = b.column(4)[0].as_py(), b.column(5)[0].as_py()
        heads = Slice(b.column(3).to_numpy(), max_rows, max_bytes, rule).heads(rows_, bytes_)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.cumsum(heads), pa.int64()), b.column(6)], names=["key", "slice", "opened", "row"])

    full = sliced.alias("a").join(F.broadcast(states).alias("b"), _same("a", "b", ["key", "slice"])).select("a.key", "a.slice", "a.order", "a.size", "b.rows", "b.bytes", "a.row")
    full = full.repartition("key", "slice").sortWithinPartitions("key", "slice", "order")
    found = _walked(full, "key", opened, T.StructType([sliced.schema["key"], sliced.schema["slice"], T.StructField("opened", T.LongType()), kind]))
    narrow = sliced.select("key", "slice", "order", "size").alias("a").join(F.broadcast(states).alias("b"), _same("a", "b", ["key", "slice"])).select("a.key", "a.slice", "a.order", "a.size", "b.rows", "b.bytes").repartition("key", "slice").sortWithinPartitions("key", "slice", "order")

    def counted(b: pa.RecordBatch):
        heads = Slice(b.column(3).to_numpy(), max_rows, max_bytes, rule).heads(b.column(4)[0].as_py(), b.column(5)[0].as_py())
        yield pa.RecordBatch.from_arrays([b.column(0).slice(0, 1), b.column(1).slice(0, 1), pa.array([int(heads.sum())], pa.int64())], names=["key", "slice", "heads"])

    counts = _walked(narrow, "key", counted, T.StructType([sliced.schema["key"], sliced.schema["slice"], T.StructField("heads", T.LongType())]))
    ahead = F.coalesce(F.sum("heads").over(W.partitionBy("key").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("key", "slice", ahead.alias("ahead")).persist()
    joined = found.alias("f").join(F.broadcast(counts).alias("n"), _same("f", "n", ["key", "slice"]))
    return joined.select("f.row.*", (F.col("f.opened") + F.col("n.ahead") - 1).alias("batch_no"))
