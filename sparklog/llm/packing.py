"""Packing token sequences by fitting few-document patterns to the histogram of lengths."""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparklog.llm.common import Recent, saved

ROOM = 4096
END = 1
#: Lengths are rounded up to multiples of this for the patterns.
STEP = 32
#: Pieces whose places in the order of a length are found by one task.
BLOCK_ROWS = 50_000
#: Words whose ids a Python worker keeps, those used of late.
CACHED_WORDS = 400_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """How the tokenizer writes each byte: a printable one as itself, the others as letters from U+0100 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class _Ids(Recent):
    """Word (its bytes, A-Z in lower case) -> its ids as bytes.

    The tokenizer drops white space, lowers letters and joins nothing across
    them, so a text's ids are those of its words in turn. A punctuation mark
    behind a letter or digit is a token of its own, and a word of letters is
    one piece for the tokenizer's merges. Everything else goes through the
    whole tokenizer, a text that may hold a special token as a whole.
    """

    def __init__(self, path: str):
        import os

        super().__init__(self._of_word, CACHED_WORDS // 2)

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.short = path.endswith("word_bpe_49k.json")

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _of_word(self, word: bytes) -> bytes:
        if len(word) > 1 and word[-1:] in b".,;:!?" and word[-2:-1].isalnum():
            ids = self[word[:-1]] + self[word[-1:]]
        else:
            text = word.decode("utf-8", "surrogatepass")
            if text.isalpha() and max(text) < "\u0250" and text == text.lower():
                ids = array("I", [t.id for t in self.model.tokenize("".join([self.letters[b] for b in word]))]).tobytes()
            else:
                ids = self.whole(text)
        return ids

    def of(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids, with the end-of-document id."""
        end = END.to_bytes(4, "little")
        data = (text or "").encode("utf-8", "surrogatepass").lower()
        if not self.short or b"<|" in data:
            return self.whole(text or "") + end
        return b"".join(map(self.__getitem__, data.split())) + end


@lru_cache(1)
def _loaded(path: str) -> _Ids:
    """One for each Python worker, which outlives a task."""
    return _Ids(path)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, room: int = ROOM, keep_ids: bool = False) -> DataFrame:
    """(id, row, piece, start, length, ids_crc32[, ids]): each document's ids, cut into pieces of room tokens; row tells repeated documents apart."""
    tokenizer = tokenizer or default_tokenizer()
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text"))

    def emit(batches):
        of = _loaded(tokenizer)
        for b in batches:
            at, piece, length, crc, ids = [], [], [], [], []
            for i, t in enumerate(b.column(2)):
                tokens = of.of(t.as_py())
                for k in range(0, len(tokens), 4 * room):
                    part = tokens[k : k + 4 * room]
                    at.append(i), piece.append(k // (4 * room)), length.append(len(part) // 4), crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            take = pa.array(at, pa.int64())
            columns = [b.column(0).take(take), b.column(1).take(take), pa.array(piece, pa.int32()), pa.array(np.array(piece, np.int64) * room), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "row", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32()))), names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(emit, f"id {rows.dtypes[0][1]}, row long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids)


def patterns(sizes: list[int], room: int) -> np.ndarray:
    """Rows: how often each of sizes (rising) is in a pattern: each alone, and all of two or three that leave no room for a longer one in place of their shortest."""
    found = {(i,) for i in range(len(sizes))}
    for i in range(len(sizes) - 1, -1, -1):
        for j in range(i, -1, -1):
            left = room - sizes[i] - sizes[j]
            if left < 0:
                continue
            k = bisect_right(sizes, left, 0, j + 1) - 1
            longer = bisect_right(sizes, room - sizes[i], 0, i + 1) - 1
            if j == longer:
                found.add((i, j))
            if k >= 0:
                found.add((i, j, k))
    out = np.zeros((len(found), len(sizes)), np.float32)
    for row, pattern in enumerate(sorted(found)):
        for i in pattern:
            out[row, i] += 1
    return out


def nonnegative_fit(a: np.ndarray, b: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by an active set: at most as many entries are positive as a has rows."""
    x, inside = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    close = 1e-9 * max(1.0, np.abs(a.T @ b).max())
    for _ in range(rounds):
        slope = np.where(inside, -np.inf, a.T @ (b - a @ x))
        j = int(slope.argmax())
        if slope[j] <= close:
            break
        inside[j] = True
        while True:
            p = np.nonzero(inside)[0]
            gram = a[:, p].T @ a[:, p]
            s = np.linalg.solve(gram + 1e-10 * np.trace(gram) / len(p) * np.eye(len(p)), a[:, p].T @ b)
            if (s > 0).all():
                break
            bad = s <= 0
            x[p] += np.min(x[p][bad] / (x[p][bad] - s[bad])) * (s - x[p])
            inside[p[(x[p] <= 1e-12) | (bad & (x[p] <= close))]] = False
            x[~inside] = 0
        x[p] = s
    return x


def plan(histogram: dict[int, int], room: int = ROOM, step: int = STEP) -> list[tuple[tuple[int, ...], int]]:
    """length -> count, to (lengths of a sequence, number of such sequences), together all of the pieces.

    Works on counts of lengths, of which there are at most room whatever the
    number of pieces. Patterns of few documents are fitted to the histogram in
    steps; the repeat counts are rounded down and given the longest pieces of
    each step that are left; what remains, shortest last, is put by best fit
    into the room that the patterns' sequences leave, or into new ones. Up to
    room / step distinct lengths each is a step of its own; a step's patterns
    then are of exact lengths, and as many.
    """
    left = {n: c for n, c in histogram.items() if c}
    out: list[tuple[tuple[int, ...], int]] = []
    if left.get(room):
        out.append(((room,), left.pop(room)))
    # Lengths by step; a bin counts as its longest length. Pieces of under a thirtieth of the room fit in anywhere, so no pattern is spent on them.
    exact = len(left) <= room // step
    by_bin: dict[int, list[int]] = {}
    for n in sorted(left):
        if n > room // 32:
            by_bin.setdefault(n if exact else -(-n // step), []).append(n)
    bins = list(by_bin.values())
    open_: dict[tuple[int, ...], int] = {}
    if bins:
        want = np.array([sum(left[n] for n in b) for b in bins], float)
        shape = patterns([b[-1] for b in bins], room)
        # A long piece can't be placed later, a short one can: its misfit weighs less.
        weight = 0.2 + 0.8 * np.array([b[-1] for b in bins]) / room
        # One more equation asks for as few sequences as the lengths allow in all.
        least = sum(n * c for n, c in left.items()) / room
        a = np.vstack([(shape * weight).T, np.full(len(shape), 0.3)])
        x = nonnegative_fit(a.astype(float), np.append(want * weight, 0.3 * least))
        for i in np.argsort(-x):
            repeat = int(x[i] + 1e-6)
            parts = [k for k in np.nonzero(shape[i])[0].tolist() for _ in range(int(shape[i, k]))]
            if sum(bins[k][-1] for k in parts) < room - room // 64:
                continue  # what is not filled well is left to the best fit
            while repeat > 0:
                # The longest length left in each of the pattern's bins; as many repeats as they allow.
                chosen: list[int] = []
                for k in parts:
                    n = next((n for n in reversed(bins[k]) if left.get(n, 0) > chosen.count(n)), None)
                    if n is None:
                        break
                    chosen.append(n)
                if len(chosen) < len(parts):
                    break
                m = min([repeat, *(left[n] // chosen.count(n) for n in chosen)])
                for n in chosen:
                    left[n] -= m
                repeat -= m
                key = tuple(sorted(chosen, reverse=True))
                open_[key] = open_.get(key, 0) + m
    # Best fit of the rest by falling length, many of a length at once.
    rooms: list[int] = []
    at: dict[int, dict[tuple[int, ...], int]] = {}

    def put(key: tuple[int, ...], m: int) -> None:
        free = room - sum(key)
        if free not in at:
            at[free] = {}
            insort(rooms, free)
        at[free][key] = at[free].get(key, 0) + m

    for key, m in open_.items():
        put(key, m)
    for n in sorted((n for n, c in left.items() if c), reverse=True):
        todo = left[n]
        while todo:
            i = bisect_left(rooms, n)
            if i == len(rooms):
                k = room // n
                if todo >= k:
                    put((n,) * k, todo // k)
                    todo %= k
                if todo and (not rooms or bisect_left(rooms, n) == len(rooms)):
                    put((n,) * todo, 1)
                    todo = 0
                continue
            free = rooms[i]
            key, m = at[free].popitem()
            fit = min(free // n, todo)
            times = min(m, max(1, todo // fit))
            if m > times:
                at[free][key] = m - times
            if not at[free]:
                del at[free]
                rooms.pop(i)
            put(key + (n,) * fit, times)
            todo -= fit * times
    out += [(key, m) for same in at.values() for key, m in same.items()]
    return out


def pack(parts: DataFrame, room: int = ROOM, step: int = STEP) -> DataFrame:
    """parts with length -> with sequence_id and offset: sequences of at most room tokens, gapless from 0.

    Only the histogram of lengths reaches the driver (at most room rows) and
    only the plan (runs of like places for each length) goes out. A piece's
    place is its number among the pieces of its length, counted in blocks.
    """
    spark = parts.sparkSession
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for key, m in plan(counts, room, step):
        # The places of one length in these m sequences: piece number first + j goes to sequence + j % m, at the (j // m)-th of this length's offsets.
        offset = 0
        for n in sorted(set(key), reverse=True):
            first = taken.get(n, 0)
            runs.setdefault(n, []).append((first, m, sequence, offset))
            taken[n] = first + m * key.count(n)
            offset += n * key.count(n)
        sequence += m
    table = spark.sparkContext.broadcast({n: np.array(r, np.int64) for n, r in runs.items()})

    blocks = [-(-counts.get(n, 0) // BLOCK_ROWS) or 1 for n in range(1, room + 1)]
    spread = F.expr(f"element_at(array({', '.join(map(str, blocks))}), cast(length AS int))") if max(blocks) > 1 else F.lit(1)
    parts = parts.withColumn("_block", F.pmod(F.xxhash64("row", "piece"), spread))
    before = parts.groupBy("length", "_block").agg(F.count("*").alias("c")).withColumn(
        "_before", F.coalesce(F.sum("c").over(W.partitionBy("length").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).cast("long")
    )
    numbered = parts.withColumn("_no", F.row_number().over(W.partitionBy("length", "_block").orderBy("row", "piece")) - 1)
    numbered = numbered.join(before.drop("c"), ["length", "_block"]).withColumn("_no", F.col("_no") + F.col("_before")).drop("_block", "_before")
    fields = numbered.schema.fields

    def place(batches):
        for b in batches:
            length, no = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "_no"))
            seq, off = np.zeros(len(no), np.int64), np.zeros(len(no), np.int64)
            for n in np.unique(length):
                at = np.nonzero(length == n)[0]
                run = table.value[int(n)]
                r = run[np.searchsorted(run[:, 0], no[at], side="right") - 1]
                j = no[at] - r[:, 0]
                seq[at] = r[:, 2] + j % r[:, 1]
                off[at] = r[:, 3] + j // r[:, 1] * n
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(seq), pa.array(off)], names=[*b.schema.names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", sequence_id long, offset long"
    return numbered.mapInArrow(place, schema).drop("_no")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, room: int = ROOM) -> DataFrame:
    """One row for each piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is empty and has the end-of-document id alone; rows that
    repeat are packed each by itself. Texts of any length are tokenised whole
    and cut into pieces of room ids; further columns are ignored, whatever
    their names. An empty table gives no rows.
    """
    parts = saved(pieces(docs, id_col, text_col, tokenizer, room), "pieces")
    return pack(parts, room).select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
