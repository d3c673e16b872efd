"""Language identification by inferring a mixture of languages for each text."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Character trigrams are counted in so many cells for each language, so the model's size is bounded by the number of languages. Trigrams that share a cell blur rare words: in mixed texts of some 80 words proportions differed by up to 0.07 from those of exact trigrams.
CELLS = 1 << 16
SMOOTHING = 0.5
#: Penalty for a further language, in units of log(words).
PENALTY = 2.0
#: Cells of the whole model, of 4 bytes each on the driver and in each task. With more than 200 languages each has fewer cells, so all are learnt and the model's size is bounded.
MODEL_CELLS = 200 * CELLS
#: Fewest cells of a language. Only of more values of lang than MODEL_CELLS / LEAST_CELLS, some 200,000, are the rarest no languages.
LEAST_CELLS = 64


def cells_for(languages: int) -> int:
    """Cells of each language: the largest power of two, up to CELLS, with which the model keeps to MODEL_CELLS."""
    cells = CELLS
    while cells > LEAST_CELLS and cells * languages > MODEL_CELLS:
        cells //= 2
    return cells


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def trigram_cells(text: str | None, n_cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the trigrams that end on each letter (a word is preceded by two blanks), and where each word starts among them."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[c]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = np.where(letter, c, 32).astype(np.uint64)
    one = np.concatenate([[np.uint64(32)], c[:-1]])
    two = np.where(one == 32, np.uint64(32), np.concatenate([[np.uint64(32)] * 2, c[:-2]])[: len(c)])
    h = ((two * np.uint64(0x9E3779B97F4A7C15) + one) * np.uint64(0xC2B2AE3D27D4EB4F) + c) * np.uint64(0x165667B19E3779F9)
    starts = letter & (one == 32)
    at = np.cumsum(letter) - 1
    return (h[letter] >> np.uint64(48)).astype(np.int64) % n_cells, at[starts]


def train(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """rows(lang, text) -> languages, and log-probabilities by cell and language. See MODEL_CELLS."""
    values = rows.groupBy("lang").count()
    languages, most = values.count(), MODEL_CELLS // LEAST_CELLS
    if languages > most:
        kept = values.orderBy(F.desc("count"), "lang").limit(most).select("lang")
        rows = rows.join(F.broadcast(kept), "lang", "left_semi")
    n_cells = cells_for(languages)

    def count(batches):
        of: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1)):
                cells, _ = trigram_cells(t.as_py(), n_cells)
                if len(cells):
                    of.setdefault(lang, np.zeros(n_cells, np.int64))
                    np.add.at(of[lang], cells, 1) if len(cells) < 64 else np.add(of[lang], np.bincount(cells, minlength=n_cells), out=of[lang])
        for lang, n in of.items():
            at = np.nonzero(n)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], names=["lang", "cell", "n"])

    counts = rows.mapInArrow(count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    langs = sorted(counts["lang"].unique())
    n = np.zeros((n_cells, len(langs)))
    n[counts["cell"], counts["lang"].map({x: i for i, x in enumerate(langs)})] = counts["n"]
    return langs, np.log((n + SMOOTHING) / (n.sum(0) + SMOOTHING * n_cells)).astype(np.float32)


def _em(likelihood: np.ndarray, share: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Proportions of the columns, and the log of the likelihood."""
    last = -np.inf
    for _ in range(rounds):
        mixed = likelihood @ share
        total = float(np.log(mixed).sum())
        share = share * ((1 / mixed) @ likelihood) / len(likelihood)
        if total - last < 1e-3:
            break
        last = total
    return share, total


def infer(text: str | None, model: np.ndarray) -> dict[int, float]:
    """Language -> proportion, for the languages that a penalised likelihood selects; empty for a text without letters."""
    cells, starts = trigram_cells(text, len(model))
    if not len(cells):
        return {}
    logs = np.add.reduceat(model[cells], starts, axis=0, dtype=np.float64)
    alone = logs.sum(0)
    best = int(alone.argmax())
    if len(alone) == 1:
        return {0: 1.0}
    top = logs.max(1)
    cost = PENALTY * math.log(len(starts) + 1)
    if top.sum() - alone[best] <= cost:  # no mixture can gain more than that
        return {best: 1.0}
    likelihood = np.maximum(np.exp(logs - top[:, None]), 1e-30)
    one = float(alone[best] - top.sum())
    langs = np.arange(len(alone))
    share, total = _em(likelihood, np.full(len(langs), 1 / len(langs)))
    keep = share * len(starts) >= 0.5
    keep[share.argmax()] = True
    if not keep.all():
        langs = langs[keep]
        share, total = _em(likelihood[:, langs], share[keep] / share[keep].sum())
    while len(langs) > 1:
        fewer = np.delete(np.arange(len(langs)), share.argmin())
        s, t = _em(likelihood[:, langs[fewer]], share[fewer] / share[fewer].sum()) if len(fewer) > 1 else (np.ones(1), float(np.log(likelihood[:, langs[fewer[0]]]).sum()))
        if total - t > cost:
            break
        langs, share, total = langs[fewer], s, t
    if len(langs) > 1 and total - cost * (len(langs) - 1) <= one or len(langs) == 1:
        return {best: 1.0}
    return {int(i): float(x) for i, x in zip(langs, share)}


def predict_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row for each row of docs: id, held_out, lang_pred, score, langs (the selected languages with their proportions).

    Learns from rows with a language whose crc32(id as text) mod 3 is not 1.
    ``und`` with score 0 for a text that is null or has no letter, or if there
    is nothing to learn from. score is the proportion of the language
    predicted, the first in the alphabet of those that tie. Texts of any length
    are read whole. Rows that repeat are each predicted by themselves and count
    as often when they are learnt from; further columns are ignored, whatever
    their names. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    held = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    langs, logs = train(rows.where(~held & F.col("lang").isNotNull()).select("lang", "text"))
    model = docs.sparkSession.sparkContext.broadcast(logs)

    def emit(batches):
        for b in batches:
            found = [infer(t.as_py(), model.value) if langs else {} for t in b.column(1)]
            best = [max(sorted(f), key=f.get) if f else None for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(2),
                    pa.array([langs[i] if i is not None else "und" for i in best], pa.string()),
                    pa.array([min(1.0, f[i]) if i is not None else 0.0 for f, i in zip(found, best)], pa.float64()),
                    pa.array([[(langs[k], v) for k, v in sorted(f.items())] for f in found], pa.map_(pa.string(), pa.float64())),
                ],
                names=["id", "held_out", "lang_pred", "score", "langs"],
            )

    out = rows.select("id", "text", held.alias("held_out")).mapInArrow(emit, f"id {rows.dtypes[0][1]}, held_out boolean, lang_pred string, score double, langs map<string,double>")
    return out.withColumnRenamed("id", id_col)
