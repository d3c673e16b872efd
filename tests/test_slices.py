"""Greedy batches of one large key in slices against a plain loop."""

import bisect
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparklog.operators import framing, slices


def greedy(sizes, max_rows, max_bytes, rule):
    out, batch, n, total = [], 0, 0, 0
    for size in sizes:
        if n >= max_rows or (n and (total + size > max_bytes if rule == "before" else total >= max_bytes)):
            batch, n, total = batch + 1, 0, 0
        n, total = n + 1, total + size
        out.append(batch)
    return out


@pytest.mark.parametrize("rule", ["before", "after"])
def test_states_of_slices(rule):
    """Any cut of the rows: states handed on give the same batches."""
    rng = random.Random(rule)
    for _ in range(300):
        sizes = [rng.choice([0, 1, 5, 9, 30, 100]) for _ in range(rng.randrange(1, 80))]
        max_rows, max_bytes = rng.choice([1, 2, 7, 1000]), rng.choice([1, 10, 50, 10**6])
        got, state, batch, at = [], (0, 0), -1, 0
        while at < len(sizes):
            n = rng.randrange(1, 20)
            s = slices.Slice(np.array(sizes[at : at + n]), max_rows, max_bytes, rule)
            heads = s.heads(*state)
            got += (batch + np.cumsum(heads)).tolist()
            batch += int(heads.sum())
            state = s.end(*state, s.last_heads())
            at += n
        assert got == greedy(sizes, max_rows, max_bytes, rule)


@pytest.mark.parametrize("max_rows,max_bytes,rule", [(8, 1 << 40, "before"), (128, 300, "before"), (128, 300, "after"), (10**6, 1500, "after")])
def test_one_key_in_slices(spark, max_rows, max_bytes, rule):
    rng = random.Random(7)
    rows = [(k, i, "x" * rng.choice([0, 3, 20, 400])) for k, n in (("hot", 900), (None, 700), ("cold", 30)) for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, o long, payload string")
    got = {(r.k, r.o): r.batch_no for r in framing.pack_batches(df, "k", "o", max_rows=max_rows, max_bytes=max_bytes, rule=rule, slice_rows=100).collect()}
    for key in ("hot", None, "cold"):
        mine = sorted((o, len(p)) for k, o, p in rows if k == key)
        assert [got[key, o] for o, _ in mine] == greedy([n for _, n in mine], max_rows, max_bytes, rule)
    assert len(got) == len(rows)


def test_slices_grow_in_number_not_in_size(spark):
    """Cuts follow from the bytes of a key, and each row's slice from the cuts, however many there are."""
    df = spark.range(6000).select(F.lit("k").alias("key"), (F.col("id") * 7 % 6000).alias("order"), F.lit(100).alias("size"))
    few, many = (slices.large_keys(df, "key", "order", F.col("size"), 1000, size) for size in (1 << 30, 3000))
    assert len(few[0][1]) == 7 and 150 <= len(many[0][1]) <= 200
    assert len(slices.large_keys(df, "key", "order", F.col("size"), 1000, 3000, 100)[0][1]) <= 60
    got = slices.with_slice(df, "key", "order", many).select("r.order", "at").collect()
    assert all(r.at == bisect.bisect_left(many[0][1], r.order) for r in got) and len(got) == 6000
