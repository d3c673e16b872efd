"""Phrases that occur often, and how tightly their words hold together: Rabin-Karp fingerprints of all n-grams.

Texts are hashed by prefix polynomials, first the bytes of words, then the
words of n-grams. What is shuffled are fingerprints and counts; the words of a
phrase are looked up at one of its occurrences, once it is known to be frequent.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparklog.llm.common import few, hot_join, saved

MOST_WORDS = 3
#: Bytes of text that are hashed at once; a longer text is cut between words.
SEGMENT = 1 << 20
#: N-grams that a task counts in memory before it sends them on.
HELD = 2_000_000
#: Bits of the table that rules out rare n-grams: some for each frequent one, and the most there are. More frequent n-grams than that cost rows, not results.
BITS_EACH, MOST_BITS = 16, 1 << 28

_U = np.uint64
_SPACE = b" \t"
_BREAK = b".,;:!?\n\x0b\x0c\r"
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(_SPACE)] = 1
_CLASS[list(_BREAK)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_GAP = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
_GAPS = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]*")
#: The two words behind a cut, whatever stands between them.
_TAIL = re.compile(rb"(?:[ \t.,;:!?\n\x0b\x0c\r]*[^ \t.,;:!?\n\x0b\x0c\r]+){0,2}")


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits, well mixed (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@dataclass
class Polynomial:
    """Rabin-Karp hashes of all slices of a sequence, modulo 2**64, from one prefix sum. The base is odd, so it has an inverse."""

    base: int
    up: np.ndarray = field(default_factory=lambda: np.ones(1, _U))
    down: np.ndarray = field(default_factory=lambda: np.ones(1, _U))

    def of(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of values[start:end] for each pair."""
        if len(self.up) < len(values) + 1:
            n = 2 * len(values) + 1
            self.up, self.down = (np.cumprod(np.where(np.arange(n) == 0, _U(1), _U(b)), dtype=_U) for b in (self.base, pow(self.base, -1, 1 << 64)))
        prefix = np.zeros(len(values) + 1, _U)
        np.cumsum(values * self.down[: len(values)], out=prefix[1:])
        return (prefix[ends] - prefix[starts]) * self.up[starts]


#: Bases of the fingerprint and of the second one that tells its collisions: bytes, then words.
_BASES = ((0x9E3779B97F4A7C15, 0xD1342543DE82EF95), (0xAF251AF3B0F025B5, 0x2545F4914F6CDD1D))


class Hasher:
    """Fingerprints of the n-grams of a run of segments."""

    def __init__(self, bits: int = 64):
        self.polynomials = [tuple(Polynomial(b) for b in pair) for pair in _BASES]
        self.mask = _U((1 << bits) - 1)
        self.langs: dict[str, int] = {}

    def lang(self, name: str) -> int:
        if name not in self.langs:
            self.langs[name] = int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")
        return self.langs[name]

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(lower-cased bytes, start and end of each word, whether the next word follows in the same piece)."""
        raw = np.frombuffer(data, np.uint8)
        kind = _CLASS[raw]
        inside = np.concatenate(([False], kind == 0, [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edge[::2], edge[1::2]
        breaks = np.cumsum(kind == 2, dtype=np.int32)
        piece = breaks[starts]
        follows = np.zeros(len(starts), bool)
        follows[:-1] = piece[1:] == piece[:-1]
        return _LOWER[raw], starts, ends, follows

    def grams(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray, langs: np.ndarray, which: int = 0) -> list[np.ndarray]:
        """For n = 1, 2, 3 the fingerprints of the n-grams from each word on; those that leave their piece are to be ignored."""
        of_bytes, of_words = self.polynomials[which]
        code = mixed(of_bytes.of(low.astype(_U) + _U(1), starts, ends) + (ends - starts).astype(_U))
        at = np.arange(len(starts))
        out = []
        for n in range(1, MOST_WORDS + 1):
            h = of_words.of(code, at, np.minimum(at + n, len(at)))
            out.append(mixed(h ^ mixed(langs + _U(n))) & (self.mask if which == 0 else _U(0xFFFFFFFF)))
        return out


@dataclass
class Segment:
    """Some of the texts of a batch, one behind the other, or a part of a long one."""

    data: bytes
    #: Where each text begins in data, where that is in the text itself, and its row.
    begins: list[int]
    offset: list[int]
    rows: list[int]
    #: Words that begin behind it belong to the next segment.
    own: int


def segments(texts: pa.Array, size: int = SEGMENT) -> Iterator[Segment]:
    parts: list[bytes] = []
    begins: list[int] = []
    offset: list[int] = []
    rows: list[int] = []
    total = 0
    for i, x in enumerate(texts):
        data = x.as_py()
        if not data:
            continue
        data = data.encode()
        at = 0
        while len(data) - at > size:
            gap = _GAP.search(data, at + size)
            if gap is None:
                break
            end = gap.start()
            tail = _TAIL.match(data, end).end()
            yield Segment(data[at:tail], [0], [at], [i], end - at)
            at = _GAPS.match(data, end).end()
        rest = data[at:]
        begins.append(total), offset.append(at), rows.append(i)
        parts.append(rest + b"\n")
        total += len(rest) + 1
        if total >= size:
            yield Segment(b"".join(parts), begins, offset, rows, total)
            parts, begins, offset, rows, total = [], [], [], [], 0
    if parts:
        yield Segment(b"".join(parts), begins, offset, rows, total)


class Counts:
    """Fingerprints seen so far; what is held is counted and sent on when there is much of it."""

    def __init__(self, names: list[str]):
        self.names, self.parts, self.held = names, [], 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(columns[0]):
            self.parts.append(columns)
            self.held += len(columns[0])
        if self.held >= HELD:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        """fp, n and, where there are further columns, the least and largest check and the least place of each fingerprint."""
        if not self.parts:
            return
        fp, *more = (np.concatenate(c) for c in zip(*self.parts))
        self.parts, self.held = [], 0
        if not more:
            found, n = np.unique(fp, return_counts=True)
            columns = [found.view(np.int64), n.astype(np.int64)]
        else:
            order = np.argsort(fp, kind="stable")
            fp = fp[order]
            first = np.flatnonzero(np.concatenate(([True], fp[1:] != fp[:-1])))
            n = np.diff(np.concatenate((first, [len(fp)])))
            check, place = (c[order] for c in more)
            columns = [fp[first].view(np.int64), n.astype(np.int64), *(f.reduceat(c, first).astype(np.int64) for f, c in ((np.minimum, check), (np.maximum, check), (np.minimum, place)))]
        for at in range(0, len(columns[0]), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 50_000]) for c in columns], names=self.names)


@dataclass
class Filter:
    """One bit for each fingerprint's place. What is in it may be frequent, what is not is rare."""

    bits: np.ndarray

    def has(self, fp: np.ndarray) -> np.ndarray:
        at = fp & _U(len(self.bits) * 8 - 1)
        return (self.bits[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1


def filter_of(frequent: DataFrame) -> np.ndarray:
    """The bits of a Filter of frequent(fp): they are set in blocks of 2**16, of which there are at most MOST_BITS / 2**16."""
    n = frequent.count()
    size = 1 << 16
    while size < min(MOST_BITS, n * BITS_EACH):
        size *= 2
    place = F.col("fp").bitwiseAND(F.lit(size - 1))
    at = frequent.select(F.shiftright(place, 16).alias("block"), place.bitwiseAND(F.lit((1 << 16) - 1)).cast("int").alias("bit"))

    def run(batches):
        bits: dict[int, np.ndarray] = {}
        for b in batches:
            block, bit = (c.to_numpy() for c in b.columns)
            for k in np.unique(block).tolist():
                mine = bits.setdefault(k, np.zeros(1 << 16, np.uint8))
                mine[bit[block == k]] = 1
        for k, v in bits.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([np.packbits(v, bitorder="little").tobytes()], pa.binary())], names=["block", "bits"])

    out = np.zeros(size // 8, np.uint8)
    for r in at.repartition("block").mapInArrow(run, "block long, bits binary").collect():
        out[r.block * 8192 : (r.block + 1) * 8192] |= np.frombuffer(bytes(r.bits), np.uint8)
    return out


def _with_langs(s: Segment, hasher: Hasher, langs: list[str], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text (by its place in the segment) and the language's code of each word."""
    text = np.searchsorted(np.array(s.begins), starts, "right") - 1
    codes = np.array([hasher.lang(langs[r]) for r in s.rows], _U)
    return text, codes[text]


def _counted(docs: DataFrame, ns: tuple[int, ...], bits: int, size: int, filter_: np.ndarray | None = None) -> DataFrame:
    """docs(key, lang, text) -> (fp, n) of all n-grams of the given lengths; with a filter, of those whose shorter n-grams it all holds."""
    shared = None if filter_ is None else docs.sparkSession.sparkContext.broadcast(filter_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts = Hasher(bits), Counts(["fp", "n"])
        passes = None if shared is None else Filter(shared.value)
        for b in batches:
            langs = b.column(1).to_pylist()
            for s in segments(b.column(2), size):
                low, starts, ends, follows = hasher.words(s.data)
                if not len(starts):
                    continue
                _, of = _with_langs(s, hasher, langs, starts)
                grams = hasher.grams(low, starts, ends, of)
                whole = starts < s.own
                for n in range(1, MOST_WORDS + 1):
                    if n > 1:
                        whole = whole & np.concatenate((follows[n - 2 :], np.zeros(n - 2, bool)))[: len(whole)]
                    if n not in ns:
                        continue
                    take = whole
                    if passes is not None:
                        shorter = passes.has(grams[n - 2])
                        take = whole & shorter & np.concatenate((shorter[1:], [False]))
                    yield from counts.add(grams[n - 1][take])
        yield from counts.flush()

    parts = docs.mapInArrow(run, "fp long, n long")
    # Tasks send each fingerprint once, so there is nothing more to add up before the shuffle.
    return parts.repartition("fp").groupBy("fp").agg(F.sum("n").alias("n"))


def _pointed(docs: DataFrame, bits: int, size: int, filter_: np.ndarray) -> DataFrame:
    """docs(key, lang, text) -> fp, n, least and largest check, and place, an occurrence of it, of all n-grams that the filter holds.

    An n-gram of no words, one for each language, counts its words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filter_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, passes = Hasher(bits), Filter(shared.value)
        counts = [Counts(["fp", "n", "least", "most", "place"]) for _ in range(MOST_WORDS + 1)]
        named = lambda n, found: (pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, n, np.int8)), *b.columns], names=["words", *b.schema.names]) for b in found)
        for b in batches:
            langs = b.column(1).to_pylist()
            keys = b.column(0).to_numpy().astype(_U)
            for s in segments(b.column(2), size):
                low, starts, ends, follows = hasher.words(s.data)
                if not len(starts):
                    continue
                text, of = _with_langs(s, hasher, langs, starts)
                begins, offset, row = (np.array(x, np.int64)[text] for x in (s.begins, s.offset, s.rows))
                place = (keys[row] << _U(31)) | (starts - begins + offset).astype(_U)
                grams, checks = (hasher.grams(low, starts, ends, of, k) for k in (0, 1))
                whole = starts < s.own
                yield from named(0, counts[0].add(mixed(of)[whole] & hasher.mask, np.zeros(int(whole.sum()), _U) + (of[whole] & _U(0xFFFFFFFF)), place[whole]))
                for n in range(1, MOST_WORDS + 1):
                    if n > 1:
                        whole = whole & np.concatenate((follows[n - 2 :], np.zeros(n - 2, bool)))[: len(whole)]
                    take = whole & passes.has(grams[n - 1])
                    yield from named(n, counts[n].add(grams[n - 1][take], checks[n - 1][take], place[take]))
        for n, c in enumerate(counts):
            yield from named(n, c.flush())

    rows = docs.mapInArrow(run, "words byte, fp long, n long, least long, most long, place long")
    return rows.repartition("words", "fp").groupBy("words", "fp").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.min("place").alias("place"))


def _phrase(data: bytes, at: int, words: int) -> str | None:
    """The phrase of so many words that begins at a byte of a text; None if there is none."""
    found = []
    for m in re.compile(rb"[ \t]*([^ \t.,;:!?\n\x0b\x0c\r]+)").finditer(data, at):
        if len(found) == words or (found and m.start() != end):
            break
        found.append(m[1])
        end = m.end()
    return b" ".join(x.lower() for x in found[:words]).decode("utf-8", "replace") if len(found) >= words else None


def fingerprints_of(hasher: Hasher, phrases: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and check of each (language, phrase)."""
    langs = np.array([hasher.lang(name) for name, _ in phrases], _U)
    out = mixed(langs) & hasher.mask, langs & _U(0xFFFFFFFF)
    data = [p.encode() for _, p in phrases]
    low, starts, ends, _ = hasher.words(b"\n".join(data))
    begins = np.cumsum([0, *(len(d) + 1 for d in data)])[:-1]
    of = langs[np.searchsorted(begins, starts, "right") - 1]
    counts = np.array([d.count(b" ") + 1 if d else 0 for d in data])
    first = np.searchsorted(starts, begins)
    for k in (0, 1):
        grams = hasher.grams(low, starts, ends, of, k)
        for n in range(1, MOST_WORDS + 1):
            out[k][counts == n] = grams[n - 1][first[counts == n]]
    return out[0].view(np.int64), out[1].view(np.int64)


def _looked_up(docs: DataFrame, rows: DataFrame, bits: int) -> DataFrame:
    """rows(words, fp, n, least, place) of one phrase each -> lang, phrase, n: the words at their places, whose fingerprint and check must be theirs.

    Only texts that a row points at move, and meet the rows that point at
    them: a text comes before its rows, which stream past it.
    """
    rows = rows.withColumn("key", F.shiftrightunsigned("place", 31))
    keys = saved(rows.select("key").distinct(), "phrase-keys")
    # Of copies one is enough, also where very many share a key.
    texts = docs.join(few(keys), "key", "left_semi").groupBy("key", "lang", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"))
    empty = lambda kind: F.lit(None).cast(kind)
    both = texts.select("key", F.lit(-1).cast("long").alias("at"), "lang", "text", empty("byte").alias("words"), empty("long").alias("fp"), empty("long").alias("n"), empty("long").alias("least"))
    both = both.unionByName(rows.select("key", F.col("place").bitwiseAND(F.lit((1 << 31) - 1)).alias("at"), empty("string").alias("lang"), empty("string").alias("text"), "words", "fp", "n", "least"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, hasher = None, [], Hasher(bits)
        for b in batches:
            seen: list[tuple] = []
            for k, at, lang, text, words, fp, n, least in zip(*(c.to_pylist() for c in b.columns)):
                if k != key:
                    key, held = k, []
                if at < 0:
                    held.append((lang, text.encode()))
                    continue
                for name, data in held:
                    phrase = "" if words == 0 else _phrase(data, at, words)
                    if phrase is not None:
                        seen.append((name, phrase, words, n, fp, least))
            # Several texts may share a key; the fingerprints say whose phrase it is.
            fps, checks = fingerprints_of(hasher, [(r[0], r[1]) for r in seen]) if seen else ((), ())
            out = {r for r, fp, check in zip(seen, fps, checks) if (fp, check) == r[4:]}
            columns = list(zip(*out))[:4] if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int8(), pa.int64()))], names=["lang", "phrase", "words", "n"])

    return both.repartition("key").sortWithinPartitions("key", "at").mapInArrow(run, "lang string, phrase string, words byte, n long")


def _by_text(docs: DataFrame, rows: DataFrame, bits: int, size: int) -> DataFrame:
    """Phrases whose fingerprint stands for several: rows(words, fp) -> lang, phrase, words, n, counted by their text."""
    shared = docs.sparkSession.sparkContext.broadcast(filter_of(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, passes = Hasher(bits), Filter(shared.value)
        for b in batches:
            langs = b.column(1).to_pylist()
            for s in segments(b.column(2), size):
                low, starts, ends, follows = hasher.words(s.data)
                if not len(starts):
                    continue
                text, of = _with_langs(s, hasher, langs, starts)
                grams, data = hasher.grams(low, starts, ends, of), low.tobytes()
                whole = starts < s.own
                fps = [mixed(of) & hasher.mask, *grams]
                for n in range(MOST_WORDS + 1):
                    if n > 1:
                        whole = whole & np.concatenate((follows[n - 2 :], np.zeros(n - 2, bool)))[: len(whole)]
                    take = np.flatnonzero(whole & passes.has(fps[n]))
                    names = [langs[s.rows[t]] for t in text[take].tolist()]
                    found = [b" ".join(data[starts[j] : ends[j]] for j in range(i, i + n)).decode("utf-8", "replace") for i in take.tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(take), n, np.int8)), pa.array(fps[n][take].view(np.int64)), pa.array(names, pa.string()), pa.array(found, pa.string())], names=["words", "fp", "lang", "phrase"])

    found = docs.mapInArrow(run, "words byte, fp long, lang string, phrase string").groupBy("words", "fp", "lang", "phrase").agg(F.count("*").alias("n"))
    return found.join(few(rows.select("words", "fp")), ["words", "fp"], "left_semi").select("lang", "phrase", "words", "n")


def frequent_phrases(docs: DataFrame, min_count: int = 10, bits: int = 64, segment: int = SEGMENT) -> DataFrame:
    """docs(doc_id, lang, text) -> lang, phrase, words, n: all phrases of up to three words that occur min_count times, and for each language one of no words that counts all its words.

    Words and pairs are counted first, then triples of which both pairs may be
    frequent; a table of bits tells which may, and lets none of them go. A
    further pass over the texts adds, to each fingerprint that may be
    frequent, an occurrence and the span of a second fingerprint. Where that
    is one value, the phrase is read at the occurrence; where not, several
    phrases have met in one fingerprint and are counted by their text.
    """
    lang = F.coalesce("lang", F.lit("und"))
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.xxhash64(lang, text).bitwiseAND(F.lit(0xFFFFFFFF)).alias("key"), lang.alias("lang"), text.alias("text")).where("text != ''")
    frequent = saved(_counted(docs, (1, 2), bits, segment).where(F.col("n") >= min_count).select("fp"), "phrase-pairs")
    triples = saved(_counted(docs, (3,), bits, segment, filter_of(frequent)).where(F.col("n") >= min_count).select("fp"), "phrase-triples")
    found = _pointed(docs, bits, segment, filter_of(frequent.unionByName(triples)))
    found = saved(found.where((F.col("n") >= min_count) | (F.col("words") == 0)), "phrase-places")
    one = _looked_up(docs, found.where("least = most"), bits)
    several = saved(found.where("least != most").select("words", "fp"), "phrase-collisions")
    if several.isEmpty():
        return saved(one, "phrases")
    return saved(one.unionByName(_by_text(docs, several, bits, segment).where((F.col("n") >= min_count) | (F.col("words") == 0))), "phrases")


def phrase_scores(found: DataFrame) -> DataFrame:
    """found(lang, phrase, words, n) of frequent_phrases -> lang, phrase, words, a, l, r, score for its phrases of two words and more.

    score is floor(1000000 * a * a / (l * r)) of the lowest-scoring cut, in
    exact decimal arithmetic; l and r are how often its parts occur.
    """
    parts = found.where("words BETWEEN 1 AND 2").select("lang", F.col("phrase").alias("part"), F.col("n").alias("m"))
    words = F.split("phrase", " ")
    cuts = found.where("words >= 2").select("lang", "phrase", "words", F.col("n").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("words").cast("int") - 1)).alias("k"))
    first, rest = F.array_join(F.slice("w", F.lit(1), F.col("k")), " "), F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ")
    rows = cuts.select("lang", "phrase", "words", "a", "k", first.alias("first"), rest.alias("rest"))
    for part, count in (("first", "l"), ("rest", "r")):
        uses = saved(rows.groupBy("lang", part).agg(F.count("*").alias("uses")).join(parts.withColumnRenamed("part", part), ["lang", part]).withColumnRenamed("m", count), "phrase-parts")
        rows = hot_join(rows, uses, part, "uses", "phrase", "inner", also=("lang",), narrow=True)
    rows = rows.withColumn("score", F.expr("CAST(CAST(1000000 AS DECIMAL(7,0)) * (CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0))) DIV (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0))) AS LONG)"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return rows.groupBy("lang", "phrase", "words", "a").agg(best).select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def collocations(docs: DataFrame, min_count: int = 10, share: int = 50, top: int = 2000, bits: int = 64, segment: int = SEGMENT) -> DataFrame:
    """docs(doc_id, lang, text) -> lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of two and three words.

    Phrases that stand in a longer one with at least share % of their
    occurrences are left out. Ranks go by score, then a, both descending,
    then the phrase. A null language is ``und``; null and empty texts have no
    words; rows that repeat count each; long texts are hashed in segments that
    overlap, whole; an empty table gives no rows; further columns are ignored.
    """
    found = frequent_phrases(docs, min_count, bits, segment)
    scored = saved(phrase_scores(found), "phrase-scores")
    words = F.split("phrase", " ")
    inner = F.explode(F.array_distinct(F.array(*(F.array_join(F.slice(words, k, 2), " ") for k in (1, 2))))).alias("phrase")
    around = scored.where("words = 3").select("lang", inner, F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    totals = found.where("words = 0").select("lang", "n")
    best = kept.withColumn("rank", rank).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
