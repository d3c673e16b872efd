"""Document fingerprints from content-defined chunks."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Chunk sizes in bytes. Below NORMAL a boundary needs STRICT zero bits of the gear hash, above it LOOSE.
LEAST, NORMAL, MOST = 8, 32, 128
STRICT, LOOSE = 6, 4
#: Rows that one task walks through in order.
BLOCK_ROWS = 5_000
MOST_BLOCKS = 20_000


@lru_cache(1)
def _gear() -> np.ndarray:
    return np.array([xxhash.xxh32_intdigest(bytes([b])) for b in range(256)], np.uint32)


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks: the gear hash of the last 16 bytes decides, so a boundary depends on the bytes next to it and not on its place."""
    n = len(data)
    if not n:
        return []
    h = _gear()[np.frombuffer(data, np.uint8)]
    for span in (1, 2, 4, 8):
        h[span:] = h[span:] + (h[:-span] << np.uint32(span))
    top = h >> np.uint32(16 - STRICT)
    loose = np.nonzero((top & np.uint32((1 << LOOSE) - 1)) == 0)[0] + 1
    strict = ((top[loose - 1] & np.uint32((1 << STRICT) - 1)) == 0).tolist()
    ends, start = [], 0
    for at, is_strict in zip(loose.tolist(), strict):
        while at - start > MOST:
            start += MOST
            ends.append(start)
        size = at - start
        if size >= LEAST and (is_strict or size >= NORMAL):
            ends.append(at)
            start = at
    while n - start > MOST:
        start += MOST
        ends.append(start)
    if start < n:
        ends.append(n)
    return ends


def chunk_set(data: bytes) -> frozenset[int]:
    """Digest of each distinct chunk (32 bits) with its length (8 bits)."""
    ends = boundaries(data)
    digest = xxhash.xxh32_intdigest
    return frozenset(digest(data[a:b]) << 8 | (b - a) for a, b in zip([0, *ends], ends))


def as_text(chunks: frozenset[int]) -> str:
    """Ten hex digits for each chunk, in order: eight of the digest, two of the length."""
    return "".join(f"{c:010x}" for c in sorted(chunks))


def containment(a: frozenset[int], b: frozenset[int]) -> float:
    """Share of the smaller set, by length, that is in the other: 0 to 1. Two empty texts are alike, an empty and another one are not."""
    if not a or not b:
        return float(a == b)
    shared = sum(c & 0xFF for c in a & b)
    return shared / min(sum(c & 0xFF for c in a), sum(c & 0xFF for c in b))


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each row of docs: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is that of the next smaller id, after the last the
    first; a null text is empty; a null id comes last, and rows with one id
    are in the order of their texts. The edited text has its last third
    replaced by as much of the next document's start, or by all of it. Texts
    of any length are read whole; further columns are ignored, whatever their
    names. An empty table gives no rows; a single document is its own next one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    spark, n = docs.sparkSession, rows.count()
    # Blocks of ids from the largest down, cut at approximate quantiles; their number is bounded, their rows are walked through one by one.
    blocks = min(MOST_BLOCKS, max(1, -(-n // block_rows)))
    cuts = rows.agg(F.percentile_approx("id", [i / blocks for i in range(1, blocks)], 20 * blocks)).first()[0] if blocks > 1 else None
    cuts = np.unique(np.array(cuts or [], np.int64))

    def block_of(ids: pa.Array) -> np.ndarray:
        null = ids.is_null().to_numpy(zero_copy_only=False)
        value = ids.fill_null(0).to_numpy(zero_copy_only=False)
        return np.where(null, len(cuts), len(cuts) - np.searchsorted(cuts, value, side="right")).astype(np.int32)

    def firsts(batches):
        for b in batches:
            blk = block_of(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(blk), b.column(0)], names=["block", "id"])

    # The first id of each block: its documents are also handed to the block before, whose last document they follow.
    first = {r["block"]: r["id"] for r in rows.select("id").mapInArrow(firsts, "block int, id long").groupBy("block").agg(F.max("id").alias("id")).collect()}
    present = sorted(first)
    before = {b: present[i - 1] for i, b in enumerate(present)}
    lead = spark.sparkContext.broadcast((first, before))

    def deal(batches):
        first, before = lead.value
        for b in batches:
            blk, ids = block_of(b.column(0)), b.column(0).to_pylist()
            copied = np.array([i for i, (k, x) in enumerate(zip(blk.tolist(), ids)) if x == first[k]], np.int64)
            to = np.array([before[k] for k in blk[copied].tolist()], np.int32)
            again = b.take(pa.array(copied))
            yield pa.RecordBatch.from_arrays([pa.array(blk), pa.array(np.zeros(len(blk), bool)), *b.columns], names=["block", "copy", "id", "text"])
            if len(copied):
                yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(np.ones(len(to), bool)), *again.columns], names=["block", "copy", "id", "text"])

    dealt = rows.mapInArrow(deal, "block int, copy boolean, id long, text string").repartitionById(len(cuts) + 1, F.col("block"))
    dealt = dealt.sortWithinPartitions("copy", F.col("id").desc_nulls_last(), "text")

    def walk(batches):
        last, ended = None, False  # (id, text, chunks), which waits for the next document
        for b in batches:
            out = []
            if ended:
                continue
            for copy, i, t in zip(b.column(1).to_pylist(), b.column(2), b.column(3)):
                text = t.as_py()
                chunks = chunk_set(_bytes(text))
                if last is not None:
                    m = len(last[1]) // 3
                    edited = _bytes(last[1][: len(last[1]) - m] + text[:m])
                    after = chunk_set(edited)
                    out.append((last[0], len(last[1]), hashlib.sha256(edited).hexdigest(), as_text(last[2]), as_text(after), containment(last[2], after), containment(last[2], chunks)))
                if copy:
                    ended = True  # what follows are further rows of the next block's first id
                    break
                last = (i.as_py(), text, chunks)
            columns = list(zip(*out)) or [[]] * 7
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(walk, schema).withColumnRenamed("id", id_col)
