import collections
import functools
import hashlib
import random

import numpy as np
import pytest
import xxhash

from sparklog.llm import exact_dedup, line_dedup, simhash, suffix_dedup
from sparklog.llm.components import components
from tests.llm.conftest import DOCS

WORDS = "the of and to in is that it was for on are as with his they at be this from have or by one had not but what all were".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def unite(nodes, pairs):
    parent = {x: x for x in nodes}
    for a, b in pairs:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return {x: find(parent, x) for x in nodes}


@pytest.mark.parametrize("n,m", [(1, 0), (60, 40), (300, 150), (300, 500)])
def test_components(spark, n, m):
    rng = random.Random(n + m)
    links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(500, 560)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = unite({x for p in links for x in p}, links)
    assert {x: got.get(x, x) for x in want} == want
    assert components(spark.createDataFrame([(3, 3)], "a long, b long")).count() == 0


# --- exact ------------------------------------------------------------------


def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))


def exact_brute(docs):
    groups = {}
    for i, t, *_ in docs:
        groups.setdefault(lowered(t), []).append(i)
    out = []
    for i, t, *_ in docs:
        ids = groups[lowered(t)]
        out.append((i, max((x for x in ids if x is not None), default=None), len(ids), hashlib.sha256(lowered(t).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("more", [{}, {"key_bits": 1}, {"bucket_rows": 1}, {"key_bits": 3, "bucket_rows": 1}])
def test_exact(docs, more):
    got = exact_dedup.exact_duplicates(docs, **more).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == exact_brute(DOCS)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({lowered(t) for _, t, *_ in DOCS}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_stage(docs, none):
    assert exact_dedup.exact_duplicates(none).count() == 0 and exact_dedup.without_copies(none).count() == 0
    left = exact_dedup.without_copies(docs)
    assert left.columns == docs.columns and left.count() == len({lowered(t) for _, t, *_ in DOCS})


def test_directory_splits(spark):
    rng = random.Random(1)
    keys = [rng.getrandbits(64) - (1 << 63) for _ in range(3000)] + [(1 << 60) + i for i in range(200)]
    df = spark.createDataFrame([(k,) for k in keys], "h long")
    buckets = exact_dedup.directory(df, 50)
    rows = buckets.collect()
    assert sum(r.load for r in rows) == len(keys) and max(r.load for r in rows) <= 50 and max(r.depth for r in rows) > 50
    spans = sorted((r.prefix % (1 << 64) << (64 - r.depth), r.prefix % (1 << 64) + 1 << (64 - r.depth), f"{r.depth}_{r.prefix}") for r in rows)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    got = {r.h: r.bucket for r in exact_dedup.with_bucket(df, buckets).collect()}
    assert got == {k: next(name for a, b, name in spans if a <= k % (1 << 64) < b) for k in keys}


def test_exact_owner_files(spark, docs):
    """The chains of one key stand in one file of one bucket, in order."""
    _, index = exact_dedup.build_index(docs, key_bits=2, bucket_rows=1)
    rows = index.select("h", "chain", "bucket", "n").withColumn("file", index["_metadata.file_path"]).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.h].append(r)
    assert all(len({(r.bucket, r.file) for r in x}) == 1 and sorted(r.chain for r in x) == list(range(len(x))) for x in by.values())
    assert max(map(len, by.values())) > 1 and sum(r.n for r in rows) == len(DOCS)


def test_hot_text(spark):
    df = spark.range(6000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'Hot', concat('t', id)) AS text")
    got = exact_dedup.exact_duplicates(df)
    assert got.where("kept").count() == 4001 and got.where("keep_id = 5997").count() == 2000
    left = exact_dedup.without_copies(df.unionByName(df.where("doc_id < 10")))
    assert left.count() == 4001


# --- SimHash ----------------------------------------------------------------


def brute_fingerprint(text):
    words = lowered(text).encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_and_shingle_hash(spark):
    rng = random.Random(2)
    for t in [None, "", " \n", "one", "A b", "a b c", prose(rng, 50), "é Ü ß " * 9, " x ", "a b"]:
        assert simhash.text_fingerprint(t) == brute_fingerprint(t)
        assert simhash.text_fingerprint(t, 7) == brute_fingerprint(t)
    one = spark.sql("SELECT xxhash64('a b c') AS h").first().h
    assert simhash.text_fingerprint("a b c") == one % (1 << 64)


def test_golay_indices():
    rng = np.random.default_rng(3)
    words = rng.integers(1 << 23, size=4000)
    index, count = simhash.codeword_indices(words)
    assert set(count.tolist()) <= {1, 6}
    for bit in range(23):
        other, n = simhash.codeword_indices(words ^ (1 << bit))
        for a, x, b, y in zip(index, count, other, n):
            assert set(a[:x].tolist()) & set(b[:y].tolist())


@pytest.mark.parametrize("small", [48, 2])
def test_links(spark, monkeypatch, small):
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = set(base) | {0, (1 << 64) - 1, 3, 7}
    for b in base[:20]:
        for _ in range(12):
            b ^= (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) if rng.random() < 0.8 else (1 << rng.randrange(64)) | (1 << rng.randrange(64)) | 5
            fps.add(b)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    pairs = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if bin((a ^ b) % (1 << 64)).count("1") <= 2]
    want = unite(fps, pairs)
    links = [tuple(r) for r in simhash.near_links(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()]
    assert all(bin((a ^ b) % (1 << 64)).count("1") <= 2 for a, b in links)
    assert unite(fps, links) == want


def test_simhash_groups(docs, none):
    got = simhash.simhash_groups(docs).collect()
    prints = [(i, brute_fingerprint(t)) for i, t, *_ in DOCS]
    root = unite({f for _, f in prints}, [(a, b) for _, a in prints for _, b in prints if bin(a ^ b).count("1") <= 2])
    least = {}
    for i, f in prints:
        least.setdefault(root[f], []).append(i)
    want = sorted(((i, f"{f:016x}", min((x for x in least[root[f]] if x is not None), default=None)) for i, f in prints), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == want
    assert simhash.simhash_groups(none).count() == 0
    assert simhash.without_near_copies(docs).columns == docs.columns


# --- near copies of documents -----------------------------------------------


@functools.cache
def five_words(t):
    w = lowered(t).encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def word_jaccard(a, b):
    a, b = five_words(a), five_words(b)
    return len(a & b) / len(a | b)


def near_brute(docs):
    """The (id, text) that stay."""
    rows = sorted({(i is None, i or 0, t or "") for i, t, *_ in docs})
    texts = sorted({t for *_, t in rows})
    root = unite(texts, [(a, b) for k, a in enumerate(texts) for b in texts[:k] if word_jaccard(a, b) >= 0.8])
    least = {}
    for none, i, t in rows:
        least.setdefault(root[t], (none, i))
    return collections.Counter((None if none else i) for none, i, t in rows if (none, i) == least[root[t]])


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def near_corpus(rng):
    """Texts of several lengths, each with edited copies, chains of edits, and copies in other case and spacing."""
    texts = []
    for n in (4, 12, 40, 150, 400):
        for _ in range(8):
            base = prose(rng, n)
            texts += [base, base.upper(), base.replace(" ", "\n ", 2), *(edited(rng, base, k) for k in (1, 1, 2, 3, 5, 8, 10, 15))]
            chain = base
            for _ in range(4):
                chain = edited(rng, chain, max(1, n // 60))
                texts.append(chain)
    texts += ["", None, " \n", "one", "ONE", "one two"]
    rng.shuffle(texts)
    return texts


def test_near_copies(of, docs, none):
    """Chains of edits, none of which is central, lose some links in stars."""
    texts = near_corpus(random.Random(11))
    kept = collections.Counter(r.doc_id for r in simhash.without_near_copies(of(texts)).collect())
    want = near_brute(list(enumerate(texts)))
    assert not want - kept  # nothing goes that has no copy of a smaller id
    assert len(texts) - sum(kept.values()) >= 0.9 * (len(texts) - sum(want.values()))
    left = simhash.without_near_copies(docs)
    assert left.columns == docs.columns and simhash.without_near_copies(none).count() == 0


def test_near_copies_of_repeated_rows(spark):
    x, y = "a b c d e f g h", "q w e r t y u"
    rows = [(1, x), (1, x), (2, x), (3, y), (8, y), (8, "other words that stand alone here"), (None, y), (None, "no id at all"), (None, "no id at all")]
    got = simhash.without_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, x), (3, y), (8, "other words that stand alone here"), (None, "no id at all")], key=repr)


def test_shingle_sets():
    rng = random.Random(14)
    for t in [None, "", " \n", "One", "a B c d", "a b c d e", prose(rng, 60), "é Ü ß " * 5]:
        w = lowered(t).encode().split()
        want = {xxhash.xxh64_intdigest(b" ".join(w[i : i + 5]), 42) for i in range(max(1, len(w) - 4))}
        assert set(simhash.shingle_set(t).view(np.uint64).tolist()) == want


def test_near_stage_drops_edited_copies(spark, of):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(12)
    base = prose(rng, 300)
    other = edited(rng, base, 6)
    assert word_jaccard(base, other) >= 0.8 and bin(brute_fingerprint(base) ^ brute_fingerprint(other)).count("1") > 2
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, of([base, other, prose(rng, 300)]), None)
    assert sorted(r.doc_id for r in got.collect()) == [0, 2]


def test_order_keys_recall():
    """Near copies of 0.8 and more share a key; texts that have nothing to do with each other hardly ever do."""
    rng, found, n, far = random.Random(13), 0, 0, 0
    while n < 300:
        base = prose(rng, 120)
        other = edited(rng, base, rng.choice((1, 2, 3)))
        if word_jaccard(base, other) >= 0.8:
            fp = np.array([simhash._signed(simhash.text_fingerprint(t, n_words=5)) for t in (base, other, prose(rng, 120))])
            row, key = simhash.order_keys(fp)
            a, b, c = (set(key[row == k].tolist()) for k in range(3))
            n, found, far = n + 1, found + bool(a & b), far + bool(a & c)
    assert found >= 0.9 * n and far <= 0.01 * n


# --- repeated strings -------------------------------------------------------


def repeats_brute(docs):
    key = lambda i: (1 << 63) - 1 if i is None else i
    seen = {}
    for i, t, *_ in docs:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            s = b[p : p + 50]
            seen[s] = min(seen.get(s, 1 << 64), key(i))
    out = []
    for i, t, *_ in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 2, np.int8)
        for p in range(len(b) - 49):
            if seen[b[p : p + 50]] < key(i):
                gone[p + 1 : p + 51] = 1
        kept = np.frombuffer(b, np.uint8)[gone[1:-1] == 0].tobytes()
        out.append((i, len(b), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def repeats(df, **more):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df, **more).collect()), key=repr)


@pytest.mark.parametrize("more", [{}, {"hot_contexts": 2}, {"chunk": 3, "hash_bits": 8}])
def test_repeats_edges(docs, none, more):
    small = [d for d in DOCS if d[0] not in (7, 9)]
    assert repeats(docs.where("doc_id IS NULL OR doc_id NOT IN (7, 9)"), **more) == repeats_brute(small)
    assert repeats(none, **more) == []
    assert suffix_dedup.remove_repeats(docs, **more).count() == len(DOCS)


@pytest.mark.parametrize("seed", range(4))
def test_repeats_random(spark, seed):
    rng = random.Random(seed)
    if seed == 0:  # few letters, runs and periods
        texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(300))) for _ in range(30)] + ["a" * n for n in (49, 50, 51, 200)] + ["ab" * 60, "ba" * 61, "abc" * 50]
    else:
        passages = [prose(rng, 14) for _ in range(12)] + ["é" * 40]
        texts = ["".join(rng.choice(passages)[rng.randrange(20) :] if rng.random() < 0.5 else prose(rng, 5) for _ in range(rng.randrange(1, 9))) for _ in range(60)]
        texts += texts[:5] + [texts[0] + "!", "?" + texts[0]]
    order = list(range(len(texts)))
    rng.shuffle(order)
    docs = [(order[i], t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = repeats_brute(docs)
    assert repeats(df) == want
    assert repeats(df, hash_bits=8) == want and repeats(df, hash_bits=1 if seed == 1 else 3) == want


def test_gram_buckets_follow_bytes():
    rng = np.random.default_rng(2)
    texts = rng.integers(97, 99, size=4000).astype(np.uint8)
    live = np.arange(len(texts) - suffix_dedup.GRAM + 1)
    want = {}
    names = [want.setdefault(texts[i : i + suffix_dedup.GRAM].tobytes(), len(want)) for i in live.tolist()]
    for bits in (64, 8, 1):
        got = suffix_dedup._gram_buckets(texts, live, bits)
        assert len(set(zip(got.tolist(), names))) == len(set(got.tolist())) == len(want)


# --- lines ------------------------------------------------------------------


def jaccard(a, b):
    x, y = ({s[i : i + 5] for i in range(max(1, len(s) - 4))} for s in (a, b))
    return len(x & y) / len(x | y)


def lines_brute(docs):
    where = {}
    for i, t, *_ in docs:
        for j, line in enumerate((t or "").split("\n")):
            where.setdefault(line, []).append((-1 if i is None else i, j))
    lines = sorted(where)
    near = [(a, b) for k, a in enumerate(lines) for b in lines[:k] if len(a) >= 5 and len(b) >= 5 and jaccard(a, b) >= 0.8]
    root = unite(lines, near)
    least, size = {}, {}
    for x in lines:
        least[root[x]] = min(least.get(root[x], (1 << 63, 0)), min(where[x]))
        size[root[x]] = size.get(root[x], 0) + len(where[x])
    return sorted(((-1 if i is None else i), j, *least[root[x]], size[root[x]]) for i, t, *_ in docs for j, x in enumerate((t or "").split("\n")))


def line_rows(df):
    return sorted(tuple(-1 if x is None else x for x in r) for r in line_dedup.line_groups(df).select("doc_id", "line", "group_id", "group_line", "group_size").collect())


def test_lines_edges(docs, none):
    small = [d for d in DOCS if d[0] not in (7, 9)]
    assert line_rows(docs.where("doc_id IS NULL OR doc_id NOT IN (7, 9)")) == lines_brute(small)
    assert line_rows(none) == []
    lines = {x for _, t, *_ in DOCS for x in (t or "").split("\n")}
    assert sum(r.kept for r in line_dedup.line_groups(docs).collect()) == len(lines)


def test_lines_near(spark):
    rng = random.Random(6)
    base = [prose(rng, 25) for _ in range(25)]

    def edited(s):
        w = s.split()
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        return " ".join(w)

    docs = [(i, "\n".join(edited(rng.choice(base[:5] if i % 2 else base)) for _ in range(rng.randrange(1, 6)))) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got, want = line_rows(df), lines_brute(docs)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert sum(a == b for a, b in zip(got, want)) >= 0.97 * len(want)
    left = {r.doc_id: r.text for r in line_dedup.without_near_lines(df).collect()}
    kept = {(r.doc_id, r.line) for r in line_dedup.line_groups(df).where("kept").collect()}
    assert left == {i: "\n".join(x for j, x in enumerate(t.split("\n")) if (i, j) in kept) for i, t in docs}


def test_line_bands_are_of_the_line_alone():
    rng = random.Random(7)
    lines = [prose(rng, n) for n in (1, 2, 30, 3)] + ["exact", "é" * 9]
    lines = [x for x in lines if len(x) >= 5]
    together = line_dedup.line_bands(lines)
    assert all((line_dedup.line_bands([x])[0] == t).all() for x, t in zip(lines, together))


@pytest.mark.parametrize("n", [30, 100, 400])
def test_line_band_recall(n):
    rng = random.Random(n)
    letters = "abcdefghijklmnopqrstuvwxyz    "
    pairs = []
    while len(pairs) < 400:
        a = "".join(rng.choice(letters) for _ in range(n))
        b = list(a)
        for _ in range(max(1, int(n * 0.022))):
            b[rng.randrange(n)] = rng.choice(letters)
        b = "".join(b)[: n - rng.choice((0, 0, n // 15))]
        if 0.8 <= jaccard(a, b) < 0.86:
            pairs.append((a, b))
    x, y = (line_dedup.line_bands(list(s)) for s in zip(*pairs))
    assert (x == y).any(1).mean() > 0.985
