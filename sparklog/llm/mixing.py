"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparklog.llm.common import cut, hot_join, word_count

WEIGHTS = (5, 2, 1)
MOST = 3
#: Documents of a source that are rounded together.
BLOCK_ROWS = 2_000
ROUNDS = 60


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """sizes(source, size, n) -> (source, source_size, n_docs, target), a row for each source.

    Sources by code point, null last, have the weights in turn and share all
    words; what a target exceeds ``most`` times its source goes to the others
    by weight. So target = least(most * size, weight * level), with one level
    for all, which follows from running sums over the sources in the order in
    which they fill up. One task orders the sources: one row for each.
    """
    by = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int"))
    by = by.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(most)))
    filling = W.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    # The first source in filling order that stays below its most has the level; those before it are full.
    by = by.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= F.col("most"))
    by = by.withColumn("level", F.max(F.when(F.col("open"), F.col("level"))).over(everything))
    return by.select("source", "source_size", "n_docs", F.least("most", F.col("weight") * F.coalesce("level", F.lit(float("inf")))).alias("target"))


def balance(sizes: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """(source, tilt, mean): the dual variable of each source's word constraint.

    The rates r minimise the sum of m (r log r - r) with m = mean + size,
    subject to sum(size r) = target and 0 <= r <= most; so
    r = least(most, exp(tilt * size / (mean + size))). The dual is convex in
    tilt; a Newton step that leaves the bracket known so far is replaced by
    its middle. Documents of one size and source have one rate, so each round
    sums over the distinct (source, size) only.
    """
    top = F.log(F.lit(float(most)))
    hist = cut(sizes.where("size > 0"))
    state = cut(
        targets.select(
            "source",
            "target",
            (F.col("source_size") / F.col("n_docs")).alias("mean"),
            F.lit(0.0).alias("tilt"),
            F.lit(-1e4).alias("lo"),
            (top * (F.col("source_size") / F.col("n_docs") + 2)).alias("hi"),
            F.lit(False).alias("done"),
        )
    )
    f = F.col("size") / (F.col("mean") + F.col("size"))
    power = F.least(top, F.col("tilt") * f)
    words = F.col("size") * F.col("n")
    for _ in range(ROUNDS):
        at = (
            hist.join(state, hist.source.eqNullSafe(state.source))
            .drop(hist.source)
            .groupBy("source", "target", "mean", "tilt", "lo", "hi")
            .agg(F.sum(words * F.exp(power)).alias("got"), F.sum(F.when(power < top, words * f * F.exp(power)).otherwise(0.0)).alias("slope"))
        )
        miss = F.col("target") - F.col("got")
        lo = F.when(miss >= 0, F.col("tilt")).otherwise(F.col("lo"))
        hi = F.when(miss <= 0, F.col("tilt")).otherwise(F.col("hi"))
        done = F.abs(miss) <= 1e-12 * F.greatest("target", F.lit(1.0))
        at = at.select("source", "target", "mean", "tilt", lo.alias("lo"), hi.alias("hi"), done.alias("done"), F.when(F.col("slope") > 0, F.col("tilt") + miss / F.col("slope")).alias("newton"))
        step = F.when((F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi")), F.col("newton")).otherwise((F.col("lo") + F.col("hi")) / 2)
        state = cut(at.select("source", "target", "mean", F.when(F.col("done"), F.col("tilt")).otherwise(step).alias("tilt"), "lo", "hi", "done"))
        if state.where(~F.col("done") & (F.col("hi") - F.col("lo") > 1e-12)).isEmpty():
            break
    # Sums in another order differ in their last digits; rounding keeps that from the rates.
    return state.select("source", F.round("tilt", 6).alias("tilt"), "mean")


#: A document, or several rows that repeat one in full, and the copies of it.
UNIT = "key string, id {id}, hash long, size long, rows long, source_size double, target double, rate double, copies long"


def _round(group: pd.DataFrame) -> pd.DataFrame:
    """Copies of the documents of a block, from the largest; each takes over the words that the one before it left open."""
    group = group.sort_values(["size", "id", "hash"], ascending=[False, True, True], kind="stable")
    copies, owed = [], 0.0
    for size, rows, rate, most in zip(group["size"].tolist(), group["rows"].tolist(), group["rate"].tolist(), group["most"].tolist()):
        owed += size * rate * rows
        k = 0 if size == 0 else int(min(most * rows, max(0, (owed + size / 2) // size)))
        owed -= k * size
        copies.append(k)
    return group.assign(copies=copies)[["key", "id", "hash", "size", "rows", "source_size", "target", "rate", "copies"]]


def _hashed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list:
    """(name, column) of what tells documents apart."""
    text, source = F.col(text_col).cast("string"), F.col(source_col).cast("string")
    return [F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("key"), F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("hash")]


def _units(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], most: int) -> DataFrame:
    """UNIT, one row for each (source, id, text)."""
    size = word_count(F.col(text_col).cast("string")).alias("size")
    units = cut(docs.select(*_hashed(docs, id_col, text_col, source_col), size).groupBy("key", "id", "hash", "size").agg(F.count("*").alias("rows")))
    source = F.when(F.col("key") != "", F.expr("substr(key, 2)")).alias("source")
    sizes = cut(units.groupBy(source, "size").agg(F.sum("rows").alias("n")))
    targets = cut(source_targets(sizes, weights, most))
    tilts = balance(sizes, targets, most)
    n_units = units.groupBy("key").agg(F.count("*").alias("n"))
    plan = targets.join(tilts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
    plan = plan.select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("key"), F.col("source_size").cast("double").alias("source_size"), "target", "tilt", "mean")
    plan = cut(plan.join(n_units, "key").withColumn("n_units", F.col("n")))
    top = F.lit(float(most))
    rate = F.least(top, F.exp(F.least(F.log(top), F.col("tilt") * F.col("size") / (F.col("mean") + F.col("size")))))
    rated = hot_join(units, plan, "key", "n", "hash", "inner").withColumn("rate", F.when(F.col("size") == 0, F.lit(0.0)).otherwise(rate))
    # The block follows from what the document is, not from where it stands.
    rated = rated.withColumn("block", F.pmod(F.xxhash64("id", "size", "hash"), F.ceil(F.col("n_units") / BLOCK_ROWS))).withColumn("most", F.lit(most))
    return rated.drop("n_units", "tilt", "mean").groupBy("key", "block").applyInPandas(_round, UNIT.format(id=docs.select(id_col).dtypes[0][1]))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row for each row of docs: id, size, source_size, target, rate, copies, taken.

    The mix depends on the rows alone, not on their order, files or
    partitions. A null or empty text or one of white space only has size 0,
    rate 0 and is not taken; a null source is a source of its own. Rows that
    repeat id, text and source are counted first and share their copies, as
    evenly as whole copies can. Documents of one size in one source have one
    rate; which of them are rounded up follows from a hash of id and text.
    Texts of any length are counted whole; further columns are ignored,
    whatever their names. An empty table gives no rows.
    """
    units = _units(docs, id_col, text_col, source_col, weights, most)
    rows = units.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    copies = F.floor(F.col("copies") / F.col("rows")) + (F.col("i") <= F.col("copies") % F.col("rows")).cast("long")
    return rows.select(F.col("id").alias(id_col), "size", F.col("source_size").cast("long").alias("source_size"), "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, with its columns. See mix."""
    units = cut(_units(docs, id_col, text_col, source_col, WEIGHTS, MOST).where("copies > 0"))
    units = units.select(*(F.col(c).alias(f"__{c}") for c in ("key", "id", "hash", "rows", "copies")))
    key, of, text = _hashed(docs, id_col, text_col, source_col)
    found = docs.withColumns({"_mix_key": key, "_mix_hash": text})
    same = (F.col("_mix_hash") == F.col("__hash")) & (F.col("_mix_key") == F.col("__key")) & F.col(id_col).eqNullSafe(F.col("__id"))

    def taken(some: DataFrame) -> DataFrame:
        return found.join(some, same)

    out = taken(units.where("__rows = 1"))
    if not units.where("__rows > 1").isEmpty():
        order = W.partitionBy("_mix_hash", "_mix_key", id_col).orderBy("_mix_hash")
        again = taken(units.where("__rows > 1")).withColumn("_mix_no", F.row_number().over(order))
        share = F.floor(F.col("__copies") / F.col("__rows")) + (F.col("_mix_no") <= F.col("__copies") % F.col("__rows")).cast("long")
        out = out.unionByName(again.withColumn("__copies", share).drop("_mix_no").where("__copies > 0"))
    return out.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(docs.columns)
