"""Removal of repeated byte strings, by suffix buckets that are refined through bucket pointers.

Sorting every suffix of a corpus moves many times its size. So suffixes are
first thinned without loss: each window of 50 bytes belongs to an anchor, a
16-byte gram chosen by content, and windows of one anchor form a context. A
context whose text also occurs in a smaller document is removed as a whole; a
context whose gram no other context has holds nothing repeated. Only the
suffixes of the remaining contexts are sorted: buckets of 16-byte grams are
refined by the bucket pointers 16 and 18 bytes later, the second round reusing
the pointers that the first one assigned, until a bucket stands for 50 bytes.

Hashes of grams only choose: anchors, parts, what is worth comparing. What is
removed rests on bytes: buckets of grams are told apart by their bytes, and
whole contexts and the windows of hot grams are equal by a cryptographic digest
(BLAKE2b, 96 bits and more), which stands for bytes that are in another task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklog.llm.common import cut, hot_join, saved

LENGTH = 50
GRAM = 16
WINDOW = LENGTH - GRAM + 1
#: Bytes of text whose contexts one step compares.
GATHER_BYTES = 8 << 20
#: Rows of docs for each part, as the mean.
PART_ROWS = 5_000
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def gram_hashes(data: np.ndarray, bits: int = 64) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes that start at each place; fewer bits for tests of hashes that collide."""
    h = data.astype(np.uint64) + np.uint64(1)
    for span, mix in zip((1, 2, 4, 8), MIX):
        h = h[:-span] * mix + h[span:]
    h ^= h >> np.uint64(29)
    h *= MIX[1]
    h ^= h >> np.uint64(32)
    return h if bits == 64 else h >> np.uint64(64 - bits) << np.uint64(64 - bits)


def _digests(data: bytes, first: list[int], end: list[int]) -> np.ndarray:
    """Two numbers, of 64 and 32 bits, for the bytes from each first to each end."""
    digest = hashlib.blake2b
    return np.frombuffer(b"".join([digest(data[a:b], digest_size=12).digest() for a, b in zip(first, end)]), [("c", "<u8"), ("d", "<u4")])


def contexts(data: np.ndarray, ends: np.ndarray, bits: int = 64) -> tuple[np.ndarray, ...]:
    """Texts end to end -> (text, first window, windows after it, hash of the anchor's gram, place of the first window in data) of each context.

    Every window of LENGTH bytes belongs to the leftmost of its grams with the
    least hash, its anchor; so equal windows have equal grams as anchors, at
    one offset. A context is a run of windows with one anchor. ends are where
    the texts end; places count from a text's start.
    """
    if len(data) < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.int64))
    h = gram_hashes(data, bits)
    low, at = (h >> np.uint64(32)).astype(np.uint32), np.arange(len(h), dtype=np.int32)
    for span in (1, 2, 4, 8, 16, WINDOW - 32):
        a, b = low[:-span], low[span:]
        at = np.where(b < a, at[span:], at[:-span])
        low = np.minimum(a, b)
    starts = np.concatenate([[0], ends[:-1]])
    inside = np.zeros(len(at) + 1, np.int64)
    full = ends - starts >= LENGTH
    np.add.at(inside, starts[full], 1)
    np.add.at(inside, ends[full] - LENGTH + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    new = inside.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
    close = inside.copy()
    close[:-1] &= (at[1:] != at[:-1]) | ~inside[1:]
    first, last = np.nonzero(new)[0], np.nonzero(close)[0]
    # Two windows of neighbouring texts never share an anchor, but they may stand side by side.
    text = np.searchsorted(ends, first, side="right")
    return text, first - starts[text], last - first, h[at[first]], first


def spans(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Runs [first, last] as pairs, in order, with touching and overlapping ones merged."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order]) if len(last) else last
    new = np.concatenate([[True], first[1:] > last[:-1] + 1]) if len(first) else np.zeros(0, bool)
    start = np.nonzero(new)[0]
    end = np.concatenate([start[1:] - 1, [len(first) - 1]]) if len(start) else start
    return np.stack([first[start], last[end]], 1).astype("<i4")


def _freeze(columns: list[np.ndarray]) -> bytes:
    return zstandard.ZstdCompressor(1).compress(b"".join(c.tobytes() for c in columns))


def _thaw(blob: bytes, types: tuple[str, ...]) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = len(data) // sum(np.dtype(t).itemsize for t in types), 0, []
    for t in types:
        out.append(np.frombuffer(data, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


def _by(keys: np.ndarray):
    """(key, positions in order) of each distinct key."""
    order = np.argsort(keys, kind="stable")
    cuts = np.nonzero(np.diff(keys[order]))[0] + 1
    return [(int(keys[p[0]]), p) for p in np.split(order, cuts) if len(p)]


#: Rows between the steps: many places in one binary value, dealt out by part; a text has its own row.
SCHEMA = "part int, kind int, ord long, rid long, data binary"
CONTEXTS, MARKS, WANTED, WINDOWS, TEXT = range(5)
#: Columns of each kind.
CONTEXT = ("<u4", "<u8", "<u4", "<i8", "<i8", "<i4", "u1")  # gram, digest of the bytes (two), ord, rid, first, more
MARK = ("<i8", "<i8", "<i4", "<i4")  # ord, rid, first and last window
WANT = ("<i8", "<i8", "<i4", "u1", "<i8")  # ord, rid, first, more, key of the gram


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))], names=["part", "kind", "ord", "rid", "data"])


def _dealt(kind: int, keys: np.ndarray, parts: int, columns: list[np.ndarray], types: tuple[str, ...]) -> pa.RecordBatch:
    return _rows([(p, kind, None, None, _freeze([c[i].astype(t) for c, t in zip(columns, types)])) for p, i in _by(keys % parts)])


def _least(group: np.ndarray, ord_: np.ndarray, more: np.ndarray | None = None) -> np.ndarray:
    """The least ord among the places of each place's group, which more tells apart further."""
    if not len(group):
        return ord_
    order = np.argsort(group) if more is None else np.lexsort((more, group))
    head = np.concatenate([[True], np.diff(group[order]) != 0])
    if more is not None:
        head[1:] |= np.diff(more[order]) != 0
    low = np.minimum.reduceat(ord_[order], np.nonzero(head)[0])
    out = np.empty_like(ord_)
    out[order] = low[np.cumsum(head) - 1]
    return out


def _gather(parts: int, hot: np.ndarray, most: int, bits: int):
    """Texts -> contexts by part of their gram. A context that a smaller document at hand has too is marked here and goes no further."""

    def found(texts: list[bytes], ord_: np.ndarray, rid: np.ndarray):
        data = b"".join(texts)
        text, first, more, g, at = contexts(np.frombuffer(data, np.uint8), np.cumsum([len(t) for t in texts]), bits)
        o, r = ord_[text], rid[text]
        if len(hot) and (is_hot := np.isin(g, hot)).any():
            rows = [
                (int(r[i] % parts), WINDOWS, int(o[i]), int(r[i]), hashlib.blake2b(texts[text[i]][x : x + LENGTH], digest_size=16).digest() + x.to_bytes(4, "little"))
                for i in np.nonzero(is_hot)[0].tolist()
                for x in range(int(first[i]), int(first[i] + more[i]) + 1)
            ]
            yield _rows(rows)
            first, more, g, at, o, r = (x[~is_hot] for x in (first, more, g, at, o, r))
        whole = _digests(data, at.tolist(), (at + more + LENGTH).tolist())
        c, d = whole["c"], whole["d"]
        low = _least(c, o, d)
        beaten = o > low
        yield _dealt(MARKS, r[beaten], parts, [x[beaten] for x in (o, r, first, first + more)], MARK)
        stay = ~beaten
        g, c, d, o, r, first, more = (x[stay] for x in (g, c, d, o, r, first, more))
        yield _dealt(CONTEXTS, (g % np.uint64(parts)).astype(np.int64), parts, [g >> np.uint64(32), c, d, o, r, first, more], CONTEXT)

    def run(batches):
        for b in batches:
            ord_, rid = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts, size, at = [], 0, 0
            for i, t in enumerate(b.column(2)):
                texts.append((t.as_py() or "").encode("utf-8", "surrogatepass"))
                size += len(texts[-1])
                if size >= most or i + 1 == len(ord_):
                    yield from found(texts, ord_[at : i + 1], rid[at : i + 1])
                    texts, size, at = [], 0, i + 1

    return run


def _settle(parts: int):
    """Contexts of a part -> marks of those that occur in a smaller document, and requests for the bytes of those that share a gram with another."""

    def run(batches):
        blobs, p = [], 0
        for b in batches:
            own = b.column(1).to_numpy() == CONTEXTS
            if not own.all():
                yield b.filter(pa.array(~own))
            for p, blob in zip(b.column(0).filter(pa.array(own)).to_pylist(), b.column(4).filter(pa.array(own))):
                blobs.append(_thaw(blob.as_py(), CONTEXT))
        if not blobs:
            return
        g, c, d, o, r, first, more = map(np.concatenate, zip(*blobs))
        del blobs
        low = _least(c, o, d)
        beaten = o > low
        yield _dealt(MARKS, r[beaten], parts, [o[beaten], r[beaten], first[beaten], first[beaten] + more[beaten].astype(np.int32)], MARK)
        g, o, r, first, more = (x[~beaten] for x in (g, o, r, first, more))
        # Contexts left have different bytes in different documents; their grams are of interest if a smaller document has them.
        wanted = (_least(g, o) < o) | (_least(g, -o) < -o)
        g, o, r, first, more = (x[wanted] for x in (g, o, r, first, more))
        yield _dealt(WANTED, r, parts, [o, r, first, more, (np.int64(p) << 32) | g.astype(np.int64)], WANT)

    return run


def _of_texts(batches, kind: int, types: tuple[str, ...]):
    """A part's places and texts, places first -> (ord, rid, id, bytes of the text, columns of its places) of each text."""
    blobs, table = [], None
    for b in batches:
        for k, o, r, i, x in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(5).to_pylist(), b.column(4)):
            if k == kind:
                blobs.append(_thaw(x.as_py(), types))
                continue
            if table is None:
                columns = [np.concatenate(c) for c in zip(*blobs)] if blobs else [np.zeros(0, t) for t in types]
                order = np.lexsort((columns[1], columns[0]))
                columns = [c[order] for c in columns]
                head = np.nonzero(np.concatenate([[True], (np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0)]))[0] if len(order) else order
                stop = np.append(head[1:], len(order))
                table = {(int(columns[0][a]), int(columns[1][a])): (a, z) for a, z in zip(head.tolist(), stop.tolist())}
                del blobs
                blobs = []
            a, z = table.get((o, r), (0, 0))
            yield o, r, i, x.as_py(), [c[a:z] for c in columns[2:]]


def _fetch(parts: int):
    """Requests and texts of a part -> the bytes of the contexts that are asked for, by part of their gram."""

    def flush(found):
        texts = [x for f in found for x in f[5]]
        key, o, r, first, more = (np.concatenate([f[i] for f in found]) for i in range(5))
        for p, i in _by((key.view(np.uint64) * MIX[0] >> np.uint64(33)).astype(np.int64) % parts):
            head = _freeze([key[i], o[i], r[i], first[i], more[i]])
            yield _rows([(p, CONTEXTS, None, None, len(head).to_bytes(4, "little") + head + zstandard.ZstdCompressor(1).compress(b"".join(texts[x] for x in i.tolist())))])

    def run(batches):
        found, n = [], 0
        for o, r, _, z, (first, more, key) in _of_texts(batches, WANTED, WANT):
            if len(first):
                text = zstandard.ZstdDecompressor().decompress(z)
                found.append((key, np.full(len(key), o), np.full(len(key), r), first, more, [text[x : x + m + LENGTH] for x, m in zip(first.tolist(), more.tolist())]))
                n += len(key)
                if n > 200_000:
                    yield from flush(found)
                    found, n = [], 0
        if found:
            yield from flush(found)

    return run


def _gram_buckets(texts: np.ndarray, live: np.ndarray, bits: int) -> np.ndarray:
    """A number for each place, the same for two of them exactly if their GRAM bytes are."""
    hashes = gram_hashes(texts, bits)[live]
    words = np.zeros((2, len(live)), np.uint64)
    for k in range(GRAM):
        words[k // 8] = words[k // 8] << np.uint64(8) | texts[live + k]
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    alike = (words[0, order[1:]] == words[0, order[:-1]]) & (words[1, order[1:]] == words[1, order[:-1]])
    if (same & ~alike).any():  # a hash that stands for different bytes
        order = np.lexsort(words)
        alike = (words[0, order[1:]] == words[0, order[:-1]]) & (words[1, order[1:]] == words[1, order[:-1]])
    out = np.zeros(len(live), np.int64)
    out[order[1:]] = np.cumsum(~alike)
    return out


def refine(texts: np.ndarray, start: np.ndarray, size: np.ndarray, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Strings laid end to end -> (places where LENGTH bytes of one string begin, bucket of those bytes).

    A place's bucket pointer is the rank of its bucket. Places alone in their
    bucket are not refined further and are left out.
    """
    reach = np.repeat(start + size, size)  # end of the string that each place is in
    place = np.arange(len(texts) - GRAM + 1)
    live = place[place + GRAM <= reach[place]]
    pointer = np.full(len(texts), -1, np.int64)
    buckets = _gram_buckets(texts, live, bits)
    depth = GRAM
    for later in (GRAM, LENGTH - 2 * GRAM):
        _, rank, times = np.unique(buckets, return_inverse=True, return_counts=True)
        again = times[rank] > 1
        live = live[again]
        pointer[:] = -1
        pointer[live] = rank[again]
        depth += later
        live = live[live + depth <= reach[live]]
        # The bucket of the bytes later on; without one they are in no other place.
        live = live[pointer[live + later] >= 0]
        buckets = pointer[live] * (len(texts) + 1) + pointer[live + later]
    _, rank, times = np.unique(buckets, return_inverse=True, return_counts=True)
    again = times[rank] > 1
    return live[again], rank[again]


def _compare(parts: int, chunk: int, bits: int):
    """Contexts of a part -> marks of the windows that a smaller document has too."""

    def run(batches):
        heads, texts = [], []
        for b in batches:
            for blob in b.column(4):
                blob = blob.as_py()
                n = int.from_bytes(blob[:4], "little")
                heads.append(_thaw(blob[4 : 4 + n], ("<i8", "<i8", "<i8", "<i4", "u1")))
                texts.append(zstandard.ZstdDecompressor().decompress(blob[4 + n :]))
        if not heads:
            return
        key, o, r, first, more = map(np.concatenate, zip(*heads))
        data = np.frombuffer(b"".join(texts), np.uint8)
        del heads, texts
        size = more.astype(np.int64) + LENGTH
        at = np.cumsum(size) - size
        order = np.argsort(key, kind="stable")
        ends = np.concatenate([np.nonzero(np.diff(key[order]))[0] + 1, [len(order)]])
        a = 0
        while a < len(order):
            b = ends[np.searchsorted(ends, min(a + chunk, len(order)))]
            i = order[a:b]
            a = b
            own = np.concatenate([[0], np.cumsum(size[i])])
            take = np.arange(own[-1]) + np.repeat(at[i] - own[:-1], size[i])
            live, bucket = refine(data[take], own[:-1], size[i], bits)
            if not len(live):
                continue
            ctx = np.searchsorted(own, live, side="right") - 1
            mine = o[i][ctx]
            hit = _least(bucket, mine) < mine
            ctx, begin = ctx[hit], (live - own[ctx])[hit] + first[i][ctx[hit]]
            # Windows that follow one another in a context are one mark.
            new = np.concatenate([[True], (np.diff(ctx) != 0) | (np.diff(begin) != 1)]) if len(ctx) else np.zeros(0, bool)
            head = np.nonzero(new)[0]
            tail = np.append(head[1:] - 1, len(ctx) - 1) if len(head) else head
            yield _dealt(MARKS, r[i][ctx[head]], parts, [o[i][ctx[head]], r[i][ctx[head]], begin[head], begin[tail]], MARK)

    return run


def _cut_out(batches):
    out = []

    def batch():
        columns = list(zip(*out)) or [[]] * 6
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    for _, _, i, z, (first, last) in _of_texts(batches, MARKS, MARK):
        text = zstandard.ZstdDecompressor().decompress(z)
        runs = spans(first.astype(np.int64), last.astype(np.int64) + LENGTH - 1)
        digest, at, gone = hashlib.sha256(), 0, 0
        for s, e in runs.tolist():
            digest.update(text[at:s])
            at = e + 1
            gone += e + 1 - s
        digest.update(text[at:])
        out.append((i, len(text), gone, len(runs), digest.hexdigest(), runs.tolist()))
        if len(out) >= 2000:
            yield batch()
            out.clear()
    yield batch()


def _texts(parts: int):
    def run(batches):
        z = zstandard.ZstdCompressor(1)
        for b in batches:
            texts = [z.compress((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in b.column(3)]
            part = (b.column(2).to_numpy(zero_copy_only=False) % parts).astype(np.int32)
            kind = np.full(len(part), TEXT, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(kind), b.column(1), b.column(2), pa.array(texts, pa.binary()), b.column(0)], names=["part", "kind", "ord", "rid", "data", "id"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = 20_000, hot_contexts: int = 500_000, sample: int = 1_000_000, hash_bits: int = 64) -> DataFrame:
    """One row for each row of docs: id, n_bytes, n_removed, n_spans, kept_sha256, spans (first and last byte of each removed run).

    A byte goes if a 50-byte string that covers it also starts in a document
    with a smaller id. A null text is empty, a null id is larger than any
    other; rows that repeat an id do not remove one another. Texts of any
    length are read whole; further columns are ignored, whatever their names.
    An empty table gives no rows. hash_bits under 64 shortens the hashes of
    grams (for tests); the result does not depend on them.

    A gram found in so many documents that its contexts (more than
    ``hot_contexts``, as a sample of documents foretells) would burden one
    task has its windows compared one by one, by an aggregation that combines
    on the map side; either way is exact.
    """
    spark = docs.sparkSession
    n = docs.count()
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // PART_ROWS))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ord_ = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), ord_.alias("ord"), F.xxhash64(F.col(id_col), text).alias("rid"), text.alias("text"))
    long_ = rows.where(F.octet_length("text") >= LENGTH).select("ord", "rid", "text")

    hot = np.zeros(0, np.uint64)
    if n > hot_contexts:
        def grams(batches):
            for b in batches:
                found = [t.as_py().encode("utf-8", "surrogatepass") for t in b.column(0)]
                g = [np.unique(contexts(np.frombuffer(t, np.uint8), np.array([len(t)]), hash_bits)[3]) for t in found]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(g or [np.zeros(0, np.uint64)]).view(np.int64))], names=["g"])

        share = min(1.0, sample / n)
        seen = long_.where(F.pmod(F.xxhash64("rid"), F.lit(1 << 20)) < int(share * (1 << 20))).select("text").mapInArrow(grams, "g long").groupBy("g").count()
        hot = np.array([r["g"] for r in seen.where(F.col("count") > max(9, hot_contexts * share)).select("g").collect()], np.int64).view(np.uint64)

    found = saved(long_.mapInArrow(_gather(parts, hot, GATHER_BYTES, hash_bits), SCHEMA).repartitionById(parts, F.col("part")).mapInArrow(_settle(parts), SCHEMA), "contexts")
    texts = rows.mapInArrow(_texts(parts), SCHEMA + ", id long")

    def beside_texts(places: DataFrame) -> DataFrame:
        """The texts of a part behind the places in them."""
        both = places.withColumn("id", F.lit(None).cast("long")).unionByName(texts)
        return both.repartitionById(parts, F.col("part")).sortWithinPartitions("kind")

    wanted = beside_texts(found.where(F.col("kind") == WANTED)).mapInArrow(_fetch(parts), SCHEMA)
    compared = wanted.repartitionById(parts, F.col("part")).mapInArrow(_compare(parts, chunk, hash_bits), SCHEMA)
    marks = found.where(F.col("kind") == MARKS).unionByName(compared)
    if len(hot):
        w = cut(found.where(F.col("kind") == WINDOWS).select(F.expr("substr(data, 1, 16)").alias("w"), "ord", "rid", F.expr("substr(data, 17, 4)").alias("at")))
        least = w.groupBy("w").agg(F.min("ord").alias("least"), F.count("*").alias("n")).where("n > 1")
        beaten = hot_join(w, least, "w", "n", "rid", "inner").where("least < ord").select("ord", "rid", "at")

        def mark(batches):
            for b in batches:
                o, r = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                at = np.array([int.from_bytes(x, "little") for x in b.column(2).to_pylist()], np.int64)
                yield _dealt(MARKS, r, parts, [o, r, at, at], MARK)

        marks = marks.unionByName(beaten.mapInArrow(mark, SCHEMA))
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<int>>"
    return beside_texts(marks).mapInArrow(_cut_out, schema).withColumnRenamed("id", id_col)
