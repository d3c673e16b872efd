"""Spelling variants: words at one edit from a much more frequent one, found by Gram matrices of letter counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklog.llm.common import ascii_lower, cut, few, hot_join, saved

#: Words of a block that meet in one matrix; larger blocks are dealt over pairs of tiles of about this size.
TILE = 1024
#: Small blocks share a matrix of so many words.
SHARED = 512
#: Columns of a letter count: a to z, then the letters U+00C0 to U+00FF.
LETTERS = 26 + 64
_PAIRS = "word string, near string, near_n long"


def word_runs(docs: DataFrame, damage: int | None = None) -> DataFrame:
    """docs(doc_id, text) -> word for each run of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased.

    With ``damage`` a run whose crc32 of ``<doc_id>:<run>`` that number
    divides loses the code point at crc32 % length; a null id is written as
    nothing. Null texts have no runs.
    """
    run = F.col("word")
    words = docs.select("doc_id", F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit("([a-zÀ-ÿ]+)"))).alias("word"))
    if damage is None:
        return words.select("word")
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    words = words.withColumn("h", h)
    at = (F.col("h") % F.char_length("word")).cast("int")
    shorter = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return words.select(F.when(F.col("h") % damage == 0, shorter).otherwise(run).alias("word"))


def vocabulary(docs: DataFrame, min_length: int, min_count: int, damage: int | None = None) -> DataFrame:
    """(word, n): the words of at least min_length code points, which occur at least min_count times, and how often."""
    words = word_runs(docs, damage).where(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _blocks(words: DataFrame) -> DataFrame:
    """words(word, n) -> a row for each block that a word is in: base, side, block, word, n.

    Block ``base`` holds words of base and of base + 1 code points. One edit
    leaves either the first base // 2 code points of both words alike or the
    other half, so words that are near meet in a block of their length and
    the next by one of the halves.
    """
    size = F.char_length("word").cast("int")

    def of(base: Column, side: int) -> Column:
        half = F.floor(base / 2).cast("int")
        part = F.left("word", half) if side == 0 else F.right("word", base - half)
        return F.struct(base.alias("base"), F.lit(side).alias("side"), F.xxhash64(base, F.lit(side), part).alias("block"))

    keys = F.array(*(of(size - less, side) for less in (0, 1) for side in (0, 1)))
    return words.select(F.explode(keys).alias("k"), "word", "n").select("k.*", "word", "n")


def _tiled(blocks: DataFrame, tile: int) -> DataFrame:
    """blocks with tile, i and j: blocks of over ``tile`` words are dealt over tiles, and each pair (i, j) of tiles meets once."""
    sizes = blocks.groupBy("base", "side", "block").agg(F.count("*").alias("m")).where(F.col("m") > tile)
    # At most four blocks in ``tile`` words are that large.
    sizes = few(cut(sizes.select("base", "side", "block", F.ceil(F.col("m") / tile).cast("int").alias("tiles"))))
    rows = blocks.join(sizes, ["base", "side", "block"], "left").withColumn("tile", F.coalesce(F.pmod(F.xxhash64("word"), "tiles").cast("int"), F.lit(0)))
    other = F.explode(F.when(F.col("tiles").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.withColumn("other", other)
    return rows.select("base", "side", "block", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "word", "n")


def letter_counts(words: list[str]) -> np.ndarray:
    """A row for each word: how often each letter stands in it."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    column = np.where(codes < 0xC0, codes - ord("a"), codes - 0xC0 + 26)
    return np.bincount(row * LETTERS + column, minlength=len(words) * LETTERS).reshape(-1, LETTERS).astype(np.float32)


def one_edit(a: str, b: str) -> bool:
    """Whether one replaced, inserted or deleted code point leads from a to b."""
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) == len(b):
        return i < len(a) and a[i + 1 :] == b[i + 1 :]
    return len(a) + 1 == len(b) and a[i:] == b[i + 1 :]


def close_pairs(group: np.ndarray, tile: np.ndarray, split: np.ndarray, longer: np.ndarray, words: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs of rows of one group whose letter counts are at a squared distance of at most two.

    Of a group that is ``split`` only rows of different tiles meet; two
    ``longer`` words meet in the block of their own length instead. Counts are
    small whole numbers, so products of single precision are exact.
    """
    x = letter_counts(words)
    square = (x * x).sum(1)
    for at in range(0, len(words), SHARED):
        rows = slice(at, at + SHARED)
        distance = square[rows, None] + square[None, at:] - 2 * (x[rows] @ x[at:].T)
        a, b = np.nonzero(distance <= 2)
        a, b = a + at, b + at
        ok = (a < b) & (group[a] == group[b]) & ~(longer[a] & longer[b]) & ((tile[a] != tile[b]) | ~split[a])
        yield from zip(a[ok].tolist(), b[ok].tolist())


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by base, side, block, i, j -> the near pairs of each such group, in both directions."""
    held: list[tuple] = []

    def pairs(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        key = [r[:5] for r in rows]
        group = np.cumsum([0, *(x != y for x, y in zip(key, key[1:]))])
        # A word alone in its group meets nobody.
        alone = np.bincount(group)[group] == 1
        rows = [r for r, one in zip(rows, alone.tolist()) if not one]
        if not rows:
            return
        group = group[~alone]
        base, side, _, i, j, tile, words, n = zip(*rows)
        longer = np.array([len(w) > b for w, b in zip(words, base)])
        split = np.array(i) != np.array(j)
        out: tuple[list, list, list] = ([], [], [])
        for a, b in close_pairs(group, np.array(tile), split, longer, list(words)):
            half = base[a] // 2
            # A pair that shares both halves counts in the block of the first.
            if (words[a][:half] == words[b][:half]) == (side[a] == 0) and one_edit(words[a], words[b]):
                for c, x in zip(out, (words[a], words[b], n[b])):
                    c.append(x)
                for c, x in zip(out, (words[b], words[a], n[a])):
                    c.append(x)
            if len(out[0]) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], names=["word", "near", "near_n"])
                out = ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], names=["word", "near", "near_n"])

    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            # A matrix takes whole groups, of two tiles at the most.
            if len(held) >= SHARED and row[:5] != held[-1][:5]:
                yield from pairs(held)
                held = []
            held.append(row)
    if held:
        yield from pairs(held)


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """words(word, n), distinct words of ``[a-z\\u00C0-\\u00FF]`` -> word, near, near_n: all pairs at one edit, in both directions.

    Words are blocked by length and shared half; the Gram matrix of a block's
    letter counts gives all squared distances, and edits are verified for
    pairs at two or less. Blocks of over ``tile`` words are dealt over pairs
    of tiles, so that no matrix is larger than two tiles.
    """
    rows = _tiled(_blocks(words), tile)
    keys = ["base", "side", "block", "i", "j"]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_near, _PAIRS)


def _roots(forms: DataFrame) -> DataFrame:
    """forms(word, form) -> (word, root): the end of each chain of forms, by pointer doubling."""
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        # A form that many words lead to is dealt over several tasks.
        uses = at.groupBy("root").agg(F.count("*").alias("uses")).withColumnRenamed("root", "word")
        up = cut(at.join(uses, "word").select(F.col("word").alias("root"), F.col("root").alias("up"), "uses"))
        if up.isEmpty():
            return at
        at = cut(hot_join(at, up, "root", "uses", "word", narrow=True).select("word", F.coalesce("up", "root").alias("root")))


def spelling_variants(docs: DataFrame, min_length: int = 6, min_count: int = 5, ratio: int = 5, damage: int | None = None, tile: int = TILE) -> DataFrame:
    """docs(doc_id, text) -> word, form, root, n, n_near, form_n for each word of the vocabulary.

    A word's form is its near word, at one edit, of largest n (ties: the
    smallest), if that is at least ``ratio`` times the word's own n; root is
    the end of the chain of forms. Null, empty and wordless texts give
    nothing, rows that repeat count each, very long texts are read whole, an
    empty table gives no rows, and further columns are ignored.
    """
    words = saved(vocabulary(docs, min_length, min_count, damage), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    near = saved(near_words(words, tile).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best")), "spelling-near")
    of = words.join(near, "word", "left")
    n = -F.col("best.less")
    is_form = n >= ratio * F.col("n")
    of = saved(of.select("word", F.when(is_form, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, n).alias("form_n")), "spelling-forms")
    roots = few(_roots(of.where("form IS NOT NULL").select("word", "form")))
    return of.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
