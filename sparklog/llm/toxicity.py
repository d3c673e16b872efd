"""Toxicity from class-conditional Kneser-Ney word models."""

from __future__ import annotations

import math
import re
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklog.llm.common import Recent, saved

WORD = re.compile(r"[^\W_]+")
#: The discount of a count is its sampling error, the square root, and this at least.
DISCOUNT = 0.75
#: A text is judged by the most telling fiftieth of its words, one at least.
SHARE = 50
#: A model of up to so many words (20 bytes each) is broadcast; a larger one is joined by a shuffle.
BROADCAST_WORDS = 4_000_000
BROADCAST_LABELS = 1_000_000
#: The curve is fitted on a sample of labelled rows, by hash of their ids, of this size at most in the mean.
CALIBRATION_ROWS = 30_000
START = 0
#: Word pairs that a task holds before it drops repeated ones and passes them on.
HELD_PAIRS = 400_000
#: The three models: of all labelled rows, and of the rows of either fold.
MODELS = {"all": 0b1111, "fold0": 0b0011, "fold1": 0b1100}


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _key(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) - (1 << 63)


def _contexts(rows: DataFrame) -> DataFrame:
    """rows(toxic, fold, text) -> (word, before, seen), each part's distinct word pairs; bit 2 * fold + toxic of seen is set."""

    def flush(parts: list[np.ndarray], bit: int) -> pa.RecordBatch:
        pair = np.concatenate(parts)
        parts.clear()
        pair = pair[np.lexsort((pair[:, 1], pair[:, 0]))]
        pair = pair[np.concatenate([[True], (pair[1:] != pair[:-1]).any(1)])]
        return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(np.full(len(pair), 1 << bit, np.int32))], names=["word", "before", "seen"])

    def emit(batches):
        keys = Recent(_key)
        of, n = [[], [], [], []], [0] * 4
        for b in batches:
            for toxic, fold, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                w, bit = np.fromiter(map(keys.__getitem__, words(t.as_py())), np.int64), 2 * fold + toxic
                if len(w):
                    of[bit].append(np.stack([w, np.concatenate([[START], w[:-1]])], 1))
                    n[bit] += len(w)
                if n[bit] > HELD_PAIRS:
                    yield flush(of[bit], bit)
                    n[bit] = 0
        for bit, parts in enumerate(of):
            if parts:
                yield flush(parts, bit)

    return rows.mapInArrow(emit, "word long, before long, seen int")


def word_model(rows: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """rows(toxic 0/1, fold 0/1, text) -> (word, a log-ratio for each of MODELS), and the log-ratios of a word never seen.

    log P(word | toxic) - log P(word | ordinary), each by interpolated
    Kneser-Ney: of the distinct words that a word follows in the class, less a
    discount, its share among all such counts of the class; what the discounts
    leave goes to the word's share of the distinct words it follows in either
    class, which is discounted and backed off to equal shares in turn. So a
    rare word has near equal odds, whatever class it was seen in, and every
    word has both probabilities.
    """
    pairs = _contexts(rows).groupBy("word", "before").agg(F.bit_or("seen").alias("seen"))
    held = lambda mask: F.sum(((F.col("seen").bitwiseAND(mask)) != 0).cast("long"))
    counts = pairs.groupBy("word").agg(*(held(m & k).alias(f"{name}_{c}") for name, m in MODELS.items() for c, k in (("1", 0b1010), ("0", 0b0101), ("any", 0b1111))))
    counts = saved(counts, "continuations")
    taken = lambda c: F.least(F.col(c), F.greatest(F.sqrt(c), F.lit(DISCOUNT)))
    sums = [F.sum(f"{n}_{c}").alias(f"n_{n}_{c}") for n in MODELS for c in ("1", "0", "any")]
    sums += [F.sum(taken(f"{n}_{c}")).alias(f"d_{n}_{c}") for n in MODELS for c in ("1", "0")] + [F.sum((F.col(f"{n}_any") > 0).cast("long")).alias(f"v_{n}") for n in MODELS]
    total = counts.agg(*sums).first()
    ratios: dict[str, Column] = {}
    unseen: dict[str, float] = {}
    for name in MODELS:
        if not total[f"n_{name}_1"] or not total[f"n_{name}_0"]:
            ratios[name], unseen[name] = F.lit(0.0), 0.0
            continue
        n, v = total[f"n_{name}_any"], total[f"v_{name}"]
        shared = (F.greatest(F.col(f"{name}_any") - DISCOUNT, F.lit(0.0)) + DISCOUNT * v / (v + 1)) / n
        left = {c: total[f"d_{name}_{c}"] / total[f"n_{name}_{c}"] for c in "10"}
        p = {c: (F.col(f"{name}_{c}") - taken(f"{name}_{c}")) / total[f"n_{name}_{c}"] + left[c] * shared for c in "10"}
        ratios[name], unseen[name] = F.log(p["1"] / p["0"]), math.log(left["1"] / left["0"])
    return counts.select("word", *(r.cast("float").alias(name) for name, r in ratios.items())), unseen


def likeness(ratios: np.ndarray) -> float:
    """How much more a text's most telling words are alike to the toxic class: their mean log-ratio, less that of the text's median word, which its language and topic make up for."""
    n = len(ratios)
    if not n:
        return 0.0
    k = -(-n // SHARE)
    return float(np.partition(ratios, n - k)[n - k :].mean() - np.median(ratios))


def _sent(model: DataFrame):
    """The model as a broadcast of arrays, in the order of the words' keys."""
    found = model.toArrow()
    keys = found.column("word").to_numpy()
    order = np.argsort(keys)
    return model.sparkSession.sparkContext.broadcast((keys[order], np.stack([found.column(name).to_numpy()[order] for name in MODELS], 1)))


def with_likeness(docs: DataFrame, model: DataFrame, unseen: dict[str, float], text_col: str, which: str | None = None) -> DataFrame:
    """docs with __like (see likeness) and __n (its number of words). Column ``which`` names the model for each row."""
    spark, names = docs.sparkSession, list(MODELS)
    at, by = docs.columns.index(text_col), docs.columns.index(which) if which else None
    if model.count() <= BROADCAST_WORDS:
        table = _sent(model)

        def ratio(name: str, word: str) -> float:
            keys, values = table.value
            k = _key(word)
            i = int(np.searchsorted(keys, k))
            return float(values[i, names.index(name)]) if i < len(keys) and keys[i] == k else unseen[name]

        def emit(batches):
            of = {name: Recent(partial(ratio, name)) for name in names}
            for b in batches:
                like, n = [], []
                chosen = b.column(by).to_pylist() if which else ["all"] * b.num_rows
                for name, t in zip(chosen, b.column(at)):
                    w = words(t.as_py())
                    like.append(likeness(np.fromiter(map(of[name].__getitem__, w), np.float64, len(w))))
                    n.append(len(w))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(like, pa.float64()), pa.array(n, pa.int64())], names=[*b.schema.names, "__like", "__n"])

        return docs.mapInArrow(emit, T.StructType([*docs.schema.fields, T.StructField("__like", T.DoubleType()), T.StructField("__n", T.LongType())]))

    def count(batches):
        for b in batches:
            rows, keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                w, c = np.unique(np.fromiter(map(_key, words(t.as_py())), np.int64), return_counts=True)
                rows.append(np.full(len(w), i, np.int64)), keys.append(w), times.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (rows, keys, times)], names=["__row", "word", "times"])

    def judge(batches):
        for b in batches:
            like, n = [], []
            for found in b.column(1).to_pylist():
                x = np.repeat([f["r"] for f in found], [f["times"] for f in found])
                like.append(likeness(x))
                n.append(len(x))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(like, pa.float64()), pa.array(n, pa.int64())], names=["__row", "__like", "__n"])

    numbered = saved(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    name = F.col(which) if which else F.lit("all")
    pick = lambda c: F.coalesce(*(F.when(F.col("__which") == m, c(m)) for m in names))
    found = numbered.select("__row", text_col).mapInArrow(count, "__row long, word long, times long").join(model, "word", "left").join(numbered.select("__row", name.alias("__which")), "__row")
    found = found.select("__row", "times", F.coalesce(pick(lambda m: F.col(m).cast("double")), pick(lambda m: F.lit(unseen[m]))).alias("r"))
    sums = found.groupBy("__row").agg(F.collect_list(F.struct("r", "times")).alias("found")).mapInArrow(judge, "__row long, __like double, __n long")
    return numbered.join(sums, "__row", "left").drop("__row").fillna(0, ["__like", "__n"])


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a light ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (p - y) + 1e-2 * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", calibration_rows: int = CALIBRATION_ROWS) -> DataFrame:
    """docs with __held_out, __like, __score and __predicted; see toxicity_scores."""
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    marks = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    known = marks.count()
    if known <= BROADCAST_LABELS:
        marks = F.broadcast(marks)
    h = F.xxhash64("id")
    taught = docs.where(~held).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(marks, "id").withColumn("fold", F.pmod(h, F.lit(2)).cast("int"))
    model, unseen = word_model(taught.select("toxic", "fold", "text"))
    model = saved(model, "word-model")
    # The curve is fitted on texts that the model of the other fold has not seen.
    sample = taught.where(F.pmod(F.shiftright(h, 1), F.lit(1 << 20)) < min(1 << 20, int(calibration_rows / max(1, known) * (1 << 20))))
    other = F.when(F.col("fold") == 0, "fold1").otherwise("fold0")
    seen = with_likeness(sample.select("toxic", "text", other.alias("which")), model, unseen, "text", "which").select("toxic", "__like", "__n").toPandas()
    y = seen["toxic"].to_numpy(float)
    if 0 < y.sum() < len(y):
        w = _fit(np.stack([seen["__like"], np.log1p(seen["__n"]), np.ones(len(y))], 1), y)
    else:
        share = float(np.clip(y.mean(), 1e-9, 1 - 1e-9)) if len(y) else 1e-9
        w = np.array([0.0, 0.0, math.log(share / (1 - share))])
    z = F.col("__like") * float(w[0]) + F.log1p("__n") * float(w[1]) + float(w[2])
    out = with_likeness(docs.withColumn(text_col, F.col(text_col).cast("string")), model, unseen, text_col)
    out = out.withColumn("__held_out", held).withColumn("__score", 1 / (1 + F.exp(-z)))
    return out.withColumn("__predicted", (F.col("__score") >= 0.5).cast("int")).drop("__n")


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", calibration_rows: int = CALIBRATION_ROWS) -> DataFrame:
    """One row for each row of docs: id, held_out, score, predicted, likeness.

    Learns from labelled rows whose crc32(id as text) mod 5 is not 0; a label
    other than 0 and 1 is ignored, and of several labels of one id the larger
    holds. Every word of a text has a Kneser-Ney likelihood in the toxic and in
    the ordinary class (see word_model); likeness is the difference of their
    logs, per word, over the most telling fiftieth of the text's words, less
    that of its median word. A logistic curve of it and of the log of the
    length gives the score. The curve is fitted on texts that the model had not
    seen: each half of the labelled rows is scored by a model of the other.

    Null and empty texts have no words: likeness 0, and the score that the
    curve gives such a text. Texts of any length are read whole. Rows that
    repeat count as often as they stand there in docs, and get one score;
    further columns are ignored, whatever their names. Without rows of both
    classes to learn from, every score is the share of ones (0 if there are no
    labels). An empty table gives no rows.
    """
    out = scored(docs.select(id_col, text_col), labels, id_col, text_col, label_col, calibration_rows)
    return out.select(id_col, F.col("__held_out").alias("held_out"), F.col("__score").alias("score"), F.col("__predicted").alias("predicted"), F.col("__like").alias("likeness"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are not predicted toxic, with their columns."""
    return scored(docs, labels).where("__predicted = 0").select(docs.columns)
