"""Distributed union-find over a table of links."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklog.llm.common import BROADCAST_ROWS, cut

#: Links that a task unites.
PART_LINKS = 125_000


def _jump(pointers: DataFrame, side: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Pointer doubling until every pointer ends at a root."""
    while True:
        up = side(pointers.select(F.col("node").alias("root"), F.col("root").alias("_up")))
        pointers = cut(
            pointers.join(up, "root", "left").select("node", F.coalesce("_up", "root").alias("root"), F.col("_up").isNotNull().alias("moved"))
        )
        if pointers.where("moved").isEmpty():
            return pointers.drop("moved")


def _forest(batches):
    """Links (hi, lo) of a part -> (hi, lo): every node that has a link to a smaller one in this part, directly or not, and the smallest of these."""
    parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
    if not parts:
        return
    ends = [np.concatenate(c) for c in zip(*parts)]
    nodes, at = np.unique(np.concatenate(ends), return_inverse=True)
    x, y = at[: len(ends[0])], at[len(ends[0]) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[x], root[y]
        apart = x != y
        if not apart.any():
            break
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    for k in range(0, len(moved), 1 << 16):
        own = moved[k : k + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[root[own]])], names=["hi", "lo"])


def components(links: DataFrame) -> DataFrame:
    """links(a, b) -> (node, root): every node that has a link to another one, and the smallest node of its component.

    Parts of some PART_LINKS links are united each by itself, which ends it
    where there is one part. Otherwise each round hooks every node to its
    smallest neighbour, shortens the pointers to their roots, and contracts
    the links to links between roots. The root itself is not listed (its own
    root is itself). Links of a node to itself and nulls are ignored. Rounds
    are logarithmic in the size of the largest component; each is materialised
    in the shared folder, and no task holds more than a part. Up to
    BROADCAST_ROWS links, pointers are broadcast instead of shuffled, lie in
    fewer parts, and are marked to be broadcast when they are returned.
    """
    live = cut(
        links.where("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    )
    kind = live.dtypes[0][1]
    n = live.count()
    side = F.broadcast if n <= BROADCAST_ROWS else (lambda df: df)
    forest = None
    while n:
        parts = 1 + n // PART_LINKS
        united = live.coalesce(parts).mapInArrow(_forest, f"hi {kind}, lo {kind}")
        if parts == 1:
            step = cut(united.select(F.col("hi").alias("node"), F.col("lo").alias("root")))
        else:
            live = cut(united)
            step = live.groupBy("hi").agg(F.min("lo").alias("root")).withColumnRenamed("hi", "node")
            step = _jump(step.coalesce(parts) if n <= BROADCAST_ROWS else step, side)
        if forest is None:
            forest = step
        else:
            up = side(step.select(F.col("node").alias("root"), F.col("root").alias("_up")))
            forest = cut(forest.join(up, "root", "left").select("node", F.coalesce("_up", "root").alias("root")).unionByName(step))
        if parts == 1:
            break
        of_hi = side(step.select(F.col("node").alias("hi"), F.col("root").alias("_hi")))
        of_lo = side(step.select(F.col("node").alias("lo"), F.col("root").alias("_lo")))
        live = cut(
            live.join(of_hi, "hi")
            .join(of_lo, "lo", "left")
            .select(F.col("_hi").alias("x"), F.coalesce("_lo", "lo").alias("y"))
            .where("x != y")
            .select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo"))
            .distinct()
        )
        n = live.count()
    if forest is None:
        return live.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return side(forest)
