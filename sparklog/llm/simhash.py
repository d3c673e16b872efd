"""SimHash near-duplicates, found through Golay-code fuzzy hashing."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparklog.llm.buckets import Sets, bucket_links
from sparklog.llm.common import cut, few, hot_join, saved, side_of
from sparklog.llm.components import components
from sparklog.llm.prefix import bitmaps

WORDS = 3
SEED = 42
#: Buckets of up to so many fingerprints are joined with themselves; larger ones go by way of midpoints.
SMALL_BUCKET = 48
#: The 64 bits in three segments (first bit, width), each of which fits the 23 bits of a Golay word.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1

#: Near copies: shingles of so many words at this Jaccard similarity. Their two fingerprints differ in 19 of 128 bits on average at 0.8, and in BITS at most: four standard deviations more.
COPY_WORDS = 5
SIMILARITY = 0.8
BITS = 36
#: Each of ORDERS orders of the 64 bits gives keys: WHOLE bits as they are, and for the 23 after them the indices of the NEARBY nearest codewords (of the six at most that lie within 4 bits).
#: Of fingerprints that differ in 8 bits 0.99 share a key of 96 orders, in 10 bits 0.9, in 12 bits 0.6. Two bits more of WHOLE for each fourfold number of documents keep chance meetings as rare.
ORDERS, WHOLE, NEARBY = 96, 10, 2
_ORDER = np.stack([np.random.default_rng(k).permutation(64)[: WHOLE + 23] for k in range(ORDERS)])


def _shingle_hashes(text: str | None, n_words: int, chunk: int):
    """XXH64 of each shingle, in arrays of up to chunk; none for a text with no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > n_words:
        starts, ends = starts[: len(words) - n_words + 1], ends[n_words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), chunk):
        s, e = starts[at : at + chunk].tolist(), ends[at : at + chunk].tolist()
        yield np.array([digest(line[i:j], SEED) for i, j in zip(s, e)], dtype=np.uint64)


def _ones(h: np.ndarray) -> np.ndarray:
    """How often each bit is set, the first one first."""
    return np.add.reduce(np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1), axis=0, dtype=np.int64)


def _majority(ones: np.ndarray, n: int) -> int:
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def text_fingerprint(text: str | None, chunk: int = 1 << 16, n_words: int = WORDS) -> int:
    """64 bits: a bit is 1 if it is set in the hashes of over half the shingles; 0 for a text with no word."""
    ones, n = np.zeros(64, np.int64), 0
    for h in _shingle_hashes(text, n_words, chunk):
        ones += _ones(h)
        n += len(h)
    return _majority(ones, n) if n else 0


def two_fingerprints(text: str | None, n_words: int = COPY_WORDS) -> tuple[int, int]:
    """text_fingerprint, and a second one of other bits of the same shingles."""
    ones, n = np.zeros((2, 64), np.int64), 0
    for h in _shingle_hashes(text, n_words, 1 << 14):
        other = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        ones += [_ones(h), _ones(other ^ (other >> np.uint64(32)))]
        n += len(h)
    return (_majority(ones[0], n), _majority(ones[1], n)) if n else (0, 0)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fp (64 bits as a long), one row for each row of docs."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def make(batches):
        for b in batches:
            fp = pa.array([_signed(text_fingerprint(t.as_py())) for t in b.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fp], names=["id", "fp"])

    return rows.mapInArrow(make, f"id {rows.dtypes[0][1]}, fp long")


def _remainder(v: np.ndarray) -> np.ndarray:
    v = v.copy()
    for bit in range(22, 10, -1):
        v ^= np.where((v >> bit) & 1, GENERATOR << (bit - 11), 0)
    return v


@lru_cache(1)
def _near_table() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the errors that lead to nearby codewords, and how many there are.

    The code is perfect: each syndrome has one error of at most 3 bits. Where
    that has 3 bits, a word one bit away may decode to another codeword, which
    is then 4 bits from this one; there are five such codewords.
    """
    errors = np.zeros((2048, 6), np.int64)
    count = np.zeros(2048, np.int64)
    for weight in range(5):
        words = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.int64)
        for e, s in zip(words.tolist(), _remainder(words).tolist()):
            if weight < 4 or bin(int(errors[s, 0])).count("1") == 3:
                errors[s, count[s]] = e
                count[s] += 1
    return errors, count


def codeword_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 23-bit words: six columns of 12-bit codeword indices, and how many of them count.

    Two words that differ in at most one bit have an index in common.
    """
    errors, count = _near_table()
    s = _remainder(words)
    return (words[:, None] ^ errors[s]) >> 11, count[s]


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in fp, key) of every key.

    Two or fewer errors over three segments leave one segment whole, and the
    segment after it (in a circle) has at most one. So a key is the whole of
    one segment and a codeword index of the next.
    """
    u = fp.view(np.uint64)
    part = [((u >> np.uint64(64 - at - width)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    where, keys = [], []
    for i in range(3):
        index, count = codeword_indices(part[(i + 1) % 3])
        row, col = np.nonzero(np.arange(6)[None, :] < count[:, None])
        where.append(row)
        keys.append((np.int64(i) << 34) | (part[i][row] << 12) | index[row, col])
    return np.concatenate(where), np.concatenate(keys)


def near_links(fps: DataFrame) -> DataFrame:
    """fps(fp), distinct -> (a, b): links whose components are those of all pairs at 2 or fewer differing bits."""

    def emit(batches):
        for b in batches:
            if b.num_rows:
                fp = b.column(0).to_numpy(zero_copy_only=False)
                row, key = golay_keys(fp)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])], names=["key", "fp"])

    keys = fps.select("fp").mapInArrow(emit, "key long, fp long")
    keys = cut(keys)
    size = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1")
    size = cut(size)
    full = cut(hot_join(keys, size.where("n > 2").select("key", "n", F.col("n").alias("times")), "key", "times", "fp", "inner"))
    small = full.where(F.col("n") <= SMALL_BUCKET).select("key", "fp")
    pairs = size.where("n = 2").select("a", "b").unionByName(
        small.select("key", F.col("fp").alias("a")).join(small.select("key", F.col("fp").alias("b")), "key").where("a < b").select("a", "b")
    )
    pairs = pairs.where("bit_count(a ^ b) <= 2")
    # Two fingerprints differ in at most 2 bits exactly if some word is at most one bit from both, and a word has 65 such neighbours: bounded groups, and no pairs.
    ball = full.where(F.col("n") > SMALL_BUCKET).select("fp").distinct()
    points = ball.select("fp", F.explode(F.expr("array_append(transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)), fp)")).alias("point"))
    around = points.groupBy("point").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all")).where("size(all) > 1")
    return pairs.unionByName(around.select("a", F.explode("all").alias("b")).where("a != b"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id, fingerprint (16 hex digits), component_id (smallest id reachable over links of 2 or fewer bits).

    Null and empty texts have fingerprint zero and are linked like any other;
    rows with a null id get the smallest id of their component, or null. Rows
    that repeat, and rows of one id with several texts, each have their own
    row. Texts of any length are read whole; further columns are ignored,
    whatever their names. An empty table gives no rows.
    """
    of = cut(fingerprints(docs, id_col, text_col))
    distinct = cut(of.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")))
    roots = components(near_links(distinct))
    joined = cut(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("rows"))
    named = cut(hot_join(joined, least, "root", "rows", "fp", "inner").select("fp", "component_id", "n"))
    return hot_join(of, named, "fp", "n", "id", "inner").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# --- near copies: fingerprints find candidates, shingle sets decide ------------


def order_keys(fp: np.ndarray, orders: range = range(ORDERS)) -> tuple[np.ndarray, np.ndarray]:
    """(position in fp, key) of every key of these orders."""
    bits = np.unpackbits(fp.astype(">i8").view(np.uint8).reshape(-1, 8), axis=1)
    where, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in orders:
        word = bits[:, _ORDER[k]].astype(np.int64) @ (np.int64(1) << np.arange(WHOLE + 23, dtype=np.int64))
        index, count = codeword_indices(word >> WHOLE)
        row, col = np.nonzero(np.arange(NEARBY)[None, :] < count[:, None])
        where.append(row)
        keys.append(np.int64(k) << 48 | (word[row] & (1 << WHOLE) - 1) << 12 | index[row, col])
    return np.concatenate(where), np.concatenate(keys)


def shingle_set(text: str | None, n_words: int = COPY_WORDS) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, A-Z lowered; a text of fewer words is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    line, n = b" ".join(words), max(1, len(words) - n_words + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1 if words else np.zeros(1, np.int64)
    starts = np.concatenate([[0], ends[:-1] + 1])[:n]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(line[i:j], SEED) for i, j in zip(starts.tolist(), ends[-n:].tolist())), np.uint64, n)).view(np.int64)


def _sets(batches):
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([shingle_set(t.as_py()) for t in part.column(1)], pa.list_(pa.int64()))], names=["nid", "grams"])


def _prints(batches):
    for b in batches:
        fp = [tuple(map(_signed, two_fingerprints(t.as_py()))) for t in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array([x[k] for x in fp], pa.int64()) for k in (0, 1))], names=["nid", "id", "fp", "fp2"])


def _keyed(batches):
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False)
        fp2 = b.column(1).to_numpy(zero_copy_only=False)
        for at in range(0, len(fp), 4096):
            # Half of the orders are of the second fingerprint: texts whose first ones happen to differ much share keys there.
            found = (order_keys(fp[at : at + 4096], range(ORDERS // 2)), order_keys(fp2[at : at + 4096], range(ORDERS // 2, ORDERS)))
            row, key = map(np.concatenate, zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(x[at : at + 4096][row]) for x in (fp, fp2))], names=["key", "node", "sketch"])


def _differ_little(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> np.ndarray:
    """By both fingerprints."""
    return np.bitwise_count((a ^ b).view(np.uint64)).astype(np.int64) + np.bitwise_count((x ^ y).view(np.uint64)) <= BITS


def _others_differ_little(_, x: np.ndarray, __, y: np.ndarray) -> np.ndarray:
    """By the second fingerprints, where the first ones are equal."""
    return np.bitwise_count((x ^ y).view(np.uint64)) <= BITS


def alike_sets(sets: pa.Array):
    """For these sets of shingles' hashes: (one, others) -> which of the others are alike to it."""
    held = Sets(sets.flatten().to_numpy(), pc.list_value_length(sets).to_numpy(zero_copy_only=False).astype(np.int64))

    def alike(one: int, others: np.ndarray) -> np.ndarray:
        both = held.common(one, others)
        return both >= SIMILARITY * (held.size[one] + held.size[others] - both)

    return alike


def copy_links(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """nodes(nid, least, fp, fp2), texts(nid, id, text) -> (a, b): links between texts at SIMILARITY or more.

    Texts whose fingerprints share a key are candidates if these and the second
    ones differ in BITS bits at most; so are those whose first ones are equal
    (see bucket_links). One text stands for all that share a fingerprint.
    """
    stand = saved(nodes.groupBy("fp").agg(F.min(F.struct("nid", "fp2")).alias("s"), F.count("*").alias("n")).select("fp", "s.*", "n"), "near-stand")
    # A key comes at most once from a fingerprint, so a bucket of one holds nothing alike.
    keys = stand.select("fp", "fp2").mapInArrow(_keyed, "key long, node long, sketch long")
    members = keys.select("*", F.count("*").over(W.partitionBy("key")).alias("n")).where("n > 1")

    def fetched(nids: DataFrame) -> DataFrame:
        """nids(nid), distinct, with their texts, nid and text, once each."""
        side = side_of(nids.count())
        wanted = saved(nodes.select("nid", "least").join(side(nids), "nid"), "near-wanted").select(F.col("nid").alias("w_nid"), "least")
        found = texts.join(side(wanted), (F.col("nid") == F.col("w_nid")) & F.col("id").eqNullSafe(F.col("least"))).select("nid", "text")
        # Rows that repeat may give a text more than once.
        return saved(saved(found, "near-texts").dropDuplicates(["nid"]), "near-texts")

    kept = {}

    def fetch(nids: DataFrame) -> None:
        """The texts of all candidates nids(nid), distinct, and their sets, for what follows."""
        kept["texts"] = fetched(saved(nids, "near-nids"))
        kept["sets"] = saved(kept["texts"].mapInArrow(_sets, "nid long, grams array<long>"), "near-sets")

    def verified(pairs: DataFrame, n: int | None = None) -> DataFrame:
        """Exact similarity of the shingle sets, for n pairs, saved."""
        sets, n = kept["sets"], pairs.count() if n is None else n
        side = side_of(n)
        often = pairs.groupBy("a").agg(F.count("*").alias("n"))
        of_b = sets.select(F.col("nid").alias("b"), F.col("grams").alias("y")).join(side(pairs), "b")
        of_a = saved(sets.select(F.col("nid").alias("a"), F.col("grams").alias("x")).join(side(often), "a"), "near-heads")
        both = hot_join(of_b, of_a, "a", "n", "b", "inner", total=n).withColumn("both", F.size(F.array_intersect("x", "y")))
        return both.where(F.col("both") >= SIMILARITY * (F.size("x") + F.size("y") - F.col("both"))).select("a", "b")

    def sets_of(nids: DataFrame) -> DataFrame:
        """nids(node) with their bitmaps."""
        sets = kept["sets"].toDF("node", "text").join(few(nids), "node", "left_semi")
        return bitmaps(sets, lambda grams: np.array(grams, np.int64), held=True)

    def named(pairs: DataFrame, side) -> DataFrame:
        """Pairs (a, b) of fingerprints with the texts that stand for them, nid_a and nid_b."""
        of_a, of_b = (stand.select(F.col("fp").alias(k), F.col("nid").alias(f"nid_{k}")) for k in "ab")
        return saved(of_b.join(side(of_a.join(side(pairs), "a")), "b"), "near-met")

    def alike_prints(pairs: DataFrame) -> DataFrame:
        n = pairs.count()
        side = side_of(n)
        near = named(pairs, side)
        found = verified(near.select(F.col("nid_a").alias("a"), F.col("nid_b").alias("b")), n)
        return near.join(side(saved(found.toDF("nid_a", "nid_b"), "near-found")), ["nid_a", "nid_b"], "left_semi").select("a", "b")

    def fetch_prints(prints: DataFrame) -> None:
        fetch(stand.select("fp", "nid").join(few(saved(prints, "near-prints")), F.col("fp") == F.col("node"), "left_semi").select("nid"))

    def sets_of_prints(prints: DataFrame) -> DataFrame:
        of = saved(stand.select(F.col("fp"), F.col("nid").alias("node")).join(prints.select(F.col("node").alias("fp")), "fp"), "near-apart")
        return saved(sets_of(of), "near-bits").join(of, "node").drop("node").withColumnRenamed("fp", "node")

    links = saved(bucket_links(members, _differ_little, alike_prints, sets_of_prints, fetch_prints, alike_sets), "near-links")
    links = named(links, side_of(links.count())).select(F.col("nid_a").alias("a"), F.col("nid_b").alias("b"))
    same = stand.where("n > 1").select("fp", "n")
    if same.isEmpty():
        return links
    texts_of = hot_join(nodes.select("fp", "nid", "fp2"), same.withColumn("size", F.col("n")), "fp", "size", "nid", "inner", narrow=True)
    texts_of = texts_of.select(F.col("fp").alias("key"), F.col("nid").alias("node"), F.col("fp2").alias("sketch"), F.count("*").over(W.partitionBy("fp")).alias("n"))
    return links.unionByName(bucket_links(texts_of, _others_differ_little, verified, sets_of, lambda nodes: fetch(nodes.select(F.col("node").alias("nid"))), alike_sets))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of near copies, the one with the smallest id, with the columns of docs.

    Texts are linked if their sets of COPY_WORDS-word shingles (words as white
    space separates them, A-Z lowered) have a Jaccard similarity of SIMILARITY
    or more; groups are what links connect. Candidates come from SimHash
    fingerprints over the same shingles, through Golay-code keys of several
    orders of the bits; every link is verified on the sets. Tests measure the
    share of near copies that are found.

    Null and empty texts are one shingle and copies of each other. A null id is
    larger than any other; of rows that repeat an id and a text one stays; of
    rows of one id with texts of different groups each group keeps its own.
    Texts of any length are read whole, and further columns are kept, whatever
    their names. Texts count as equal by 64 bits of hash. An empty table gives
    no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    nid = F.xxhash64(text)
    texts = docs.select(nid.alias("nid"), F.col(id_col).alias("id"), text.alias("text"))
    prints = texts.mapInArrow(_prints, f"nid long, id {texts.dtypes[1][1]}, fp long, fp2 long")
    rows = saved(prints.groupBy("nid", "id").agg(F.first("fp").alias("fp"), F.first("fp2").alias("fp2"), F.count("*").alias("times")), "near-ids")
    nodes = saved(rows.groupBy("nid").agg(F.min("id").alias("least"), F.first("fp").alias("fp"), F.first("fp2").alias("fp2"), F.count("*").alias("n")), "near-nodes")
    roots = components(copy_links(nodes, texts)).withColumnRenamed("node", "nid")
    named = saved(nodes.join(roots, "nid", "left").withColumn("root", F.coalesce("root", "nid")), "near-roots")
    stays = named.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "nid")).alias("stays"), F.count("*").alias("members"))
    named = saved(hot_join(named, saved(stays, "near-first"), "root", "members", "nid", "inner", narrow=True).select("nid", "n", "stays"), "near-stays")
    # Of a group's rows, those of the text and id that stay; the others go, as do further rows that repeat both.
    ids = hot_join(rows.select("nid", "id", "times"), named, "nid", "n", "id", "inner", narrow=True)
    ids = saved(ids.select(F.col("nid").alias("__nid"), F.col("id").alias("__id"), "times", ((F.col("nid") == F.col("stays.nid")) & F.col("id").eqNullSafe(F.col("stays.least"))).alias("stays")), "near-gone")
    gone = ids.where("NOT stays").select("__nid", "__id")
    same = (nid == F.col("__nid")) & F.col(id_col).eqNullSafe(F.col("__id"))
    out = docs.join(few(gone), same, "left_anti")
    twice = ids.where("stays AND times > 1").select("__nid", "__id")
    if twice.isEmpty():
        return out
    twice = few(twice)
    again = out.join(twice, same, "left_semi").withColumn("__nid", nid).dropDuplicates([id_col, "__nid"])
    return out.join(twice, same, "left_anti").unionByName(again.select(docs.columns))
