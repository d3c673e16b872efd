"""Spelling variants, shards and phrases against brute-force versions."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparklog.llm import phrases, sharding, spelling
from tests.llm.conftest import DOCS, SCHEMA


def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))


# --- spelling ----------------------------------------------------------------


def edits(a, b):
    """Levenshtein distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def spelling_brute(docs, damage, min_length=6, min_count=5, ratio=5):
    count = collections.Counter()
    for i, t, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lowered(run)
            if damage and (h := zlib.crc32(f"{'' if i is None else i}:{run}".encode())) % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: k for w, k in count.items() if len(w) >= min_length and k >= min_count}
    near = collections.defaultdict(list)
    for a, b in itertools.combinations(n, 2):
        if abs(len(a) - len(b)) < 2 and edits(a, b) == 1:
            near[a].append(b), near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n), key=repr)


def misspelt(rng, words):
    w = list(rng.choice(words))
    at = rng.randrange(len(w))
    kind = rng.randrange(3)
    if kind == 0:
        w[at] = rng.choice("abcdeéÿ")
    elif kind == 1:
        del w[at]
    else:
        w.insert(at, rng.choice("abcdeéÿ"))
    return "".join(w)


@pytest.mark.parametrize("tile", [2, 1024])
def test_spelling(spark, rows, tile):
    rng = random.Random(tile)
    stems = ["".join(rng.choice("abéÿ") for _ in range(rng.randrange(6, 9))) for _ in range(40)] + ["commonly", "commonle", "aaaaaa", "aaaaaaa"]
    words = [w for s in stems for w in [s] * rng.choice([5, 6, 30, 160])]
    words += [w for _ in range(120) for w in [misspelt(rng, stems)] * rng.choice([4, 5, 7])]
    rng.shuffle(words)
    docs = [(i if i % 9 else None, " ".join(w.upper() if j % 5 == 0 else w for j, w in enumerate(words[at : at + 50])) + " 7x", None, None) for i, at in enumerate(range(0, len(words), 50))]
    df = spark.createDataFrame(docs, SCHEMA)
    for damage in (None, 7):
        want = spelling_brute(docs, damage)
        assert sum(x[1] is not None for x in want) > 10
        assert rows(spelling.spelling_variants(df, damage=damage, tile=tile)) == want


def test_spelling_odd_rows(docs, none, rows):
    got = rows(spelling.spelling_variants(docs, min_length=3, min_count=1, damage=2))
    assert got == spelling_brute(DOCS, 2, 3, 1)
    assert spelling.spelling_variants(none).count() == 0


@given(st.text("abé", max_size=6), st.text("abé", max_size=6))
@settings(max_examples=300, deadline=None)
def test_one_edit(a, b):
    assert spelling.one_edit(a, b) == (edits(a, b) == 1)
    if edits(a, b) == 1:
        x = spelling.letter_counts([a, b]) if a and b else None
        assert x is None or ((x[0] - x[1]) ** 2).sum() <= 2


def test_hot_block_is_tiled(spark):
    """Words of one block alone meet all others once, in matrices of two tiles."""
    words = ["stemstem" + "".join(t) for t in itertools.product("abcdef", repeat=3)]
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    tiled = spelling._tiled(spelling._blocks(df), 16)
    assert tiled.groupBy("base", "side", "block", "i", "j").count().agg(F.max("count")).first()[0] <= 3 * 16 * 2
    got = spelling.near_words(df, 16)
    assert got.count() == got.distinct().count() == len(words) * 15


# --- shards ------------------------------------------------------------------


def placed(df):
    by = collections.defaultdict(list)
    for r in df.collect():
        by[r.shard].append(r)
    assert all(sorted(x.slot for x in v) == list(range(len(v))) for v in by.values())
    return by


@pytest.mark.parametrize("bucket_bytes", [1 << 9, 1 << 12, 1 << 30])
def test_shards(spark, bucket_bytes):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    got = sharding.shuffle_into_shards(docs, bucket_bytes=bucket_bytes)
    by = placed(got)
    assert set(by) == set(range(16)) and {len(v) for v in by.values()} == {250}
    order = [r.doc_id for k in sorted(by) for r in sorted(by[k], key=lambda r: r.slot)]
    assert sorted(order) == list(range(4000))
    # A random order: no correlation with the old one, and neighbours are seldom neighbours.
    assert abs(np.corrcoef(order, range(4000))[0, 1]) < 0.06
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:])) < 12
    spread = np.bincount([r.shard for v in by.values() for r in v if r.doc_id < 400], minlength=16)
    assert spread.min() > 8 and spread.max() < 45
    again = sharding.shuffle_into_shards(docs.repartition(7), bucket_bytes=bucket_bytes)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for v in by.values() for r in v}
    other = sharding.shuffle_into_shards(docs, seed=3, bucket_bytes=bucket_bytes)
    assert {tuple(r) for r in other.collect()} != {tuple(r) for v in by.values() for r in v}


def test_shards_of_odd_rows(docs, none):
    got = sharding.shuffle_into_shards(docs.withColumn("Shard", F.lit("clash")).withColumn("slot", F.lit("clash")), shards=4, bucket_bytes=100)
    by = placed(got)
    assert sorted(map(len, by.values())) == [3, 3, 3, 4]
    assert got.columns == [*docs.columns, "slot", "shard"]
    texts = collections.Counter((r.doc_id, r.text) for v in by.values() for r in v)
    assert texts == collections.Counter((i, t) for i, t, *_ in DOCS)
    assert sharding.shuffle_into_shards(none).count() == 0
    digest = sharding.shard_digest(got).collect()
    want = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in DOCS)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in digest) == want
    assert {(r.law, r.grown_shard) for r in digest} == {("rows", None)}


def test_repeated_rows_are_scattered(spark):
    """A row that stands for half of all is spread over all buckets."""
    docs = spark.range(20000).selectExpr("if(id % 2 = 0, null, id) AS doc_id", "if(id % 2 = 0, 'same text', concat('text ', id)) AS text")
    rows, loads = sharding.scattered(docs, 16, 17)
    n = [r.n for r in loads.collect()]
    assert len(n) == 16 and sum(n) == 20000 and max(n) < 1500
    by = placed(sharding.shuffle_into_shards(docs, bucket_bytes=20000))
    assert {len(v) for v in by.values()} == {1250}
    assert all(500 < sum(r.doc_id is None for r in v) < 750 for v in by.values())


def test_shard_folders(spark, tmp_path):
    docs = spark.range(100).selectExpr("id AS doc_id", "string(id) AS text")
    sharding.shuffle_into_shards(docs, shards=5, path=f"{tmp_path}/out")
    assert sorted(p.name for p in (tmp_path / "out").glob("shard=*")) == [f"shard={k}" for k in range(5)]


# --- phrases -----------------------------------------------------------------


def counted(docs):
    f = collections.Counter()
    for _, text, lang, *_ in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for n in range(4):
                f.update((lang or "und", " ".join(words[i : i + n]), n) for i in range(len(words) - max(n, 1) + 1))
    return f


def phrases_brute(docs, min_count, share, top):
    f = counted(docs)
    frequent = {k: v for k, v in f.items() if k[2] >= 2 and v >= min_count}
    out = collections.defaultdict(list)
    for (lang, phrase, n), a in frequent.items():
        words = phrase.split(" ")
        if n == 2 and any(k[2] == 3 and k[0] == lang and words in (k[1].split(" ")[:2], k[1].split(" ")[1:]) and 100 * v >= share * a for k, v in frequent.items()):
            continue
        cuts = []
        for k in range(1, n):
            left, right = f[lang, " ".join(words[:k]), k], f[lang, " ".join(words[k:]), n - k]
            cuts.append((10**6 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, phrase.encode(), phrase, left, right))
    total = {k[0]: v for k, v in f.items() if k[2] == 0}
    return sorted(((lang, i, p, -a, left, right, total[lang], -s) for lang, found in out.items() for i, (s, a, _, p, left, right) in enumerate(sorted(found)[:top], 1)), key=repr)


def made_texts(seed, n=60):
    rng = random.Random(seed)
    words = ["a", "the", "de", "fox", "Éa", "éa", "x" * 40, "big"]
    sets = ["red hot iron", "de la mer", "tick tock"]
    docs = []
    for i in range(n):
        parts = [rng.choice(sets) if rng.random() < 0.3 else rng.choice(words).upper() if rng.random() < 0.2 else rng.choice(words) for _ in range(rng.randrange(0, 60))]
        text = "".join(p + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " \r "]) for p in parts)
        docs.append((i, text, rng.choice(["en", "fr", None]), "s"))
    return docs + [(90, None, "en", "s"), (91, "", "en", "s"), (92, " .,\n", "es", "s"), (None, "red hot iron " * 30, "fr", None), (None, "red hot iron " * 30, "fr", None)]


@pytest.mark.parametrize("bits,segment", [(64, 1 << 20), (64, 50), (6, 50), (10, 1 << 20)])
def test_phrases(spark, rows, bits, segment):
    docs = made_texts(bits + segment)
    df = spark.createDataFrame(docs, SCHEMA)
    found = phrases.frequent_phrases(df, 5, bits, segment)
    want = {(k[0], k[1], k[2], v) for k, v in counted(docs).items() if v >= (5 if k[2] else 1)}
    assert {tuple(r) for r in found.collect()} == want
    assert found.count() == len(want)
    for top in (4, 1000):
        assert rows(phrases.collocations(df, 5, 50, top, bits, segment)) == phrases_brute(docs, 5, 50, top)


def test_phrases_of_odd_rows(docs, none, rows):
    got = rows(phrases.collocations(docs, min_count=2))
    assert got == phrases_brute(DOCS, 2, 50, 2000) and len(got) == 4
    assert phrases.collocations(none).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    found = [("en", "a", 1, big + 7), ("en", "b", 1, big + 1), ("en", "c", 1, big + 3), ("en", "a b", 2, big), ("en", "b c", 2, big - 1), ("en", "a b c", 3, big - 2)]
    df = spark.createDataFrame(found, "lang string, phrase string, words byte, n long")
    got = {r.phrase: (r.score, r.l, r.r) for r in phrases.phrase_scores(df).collect()}
    assert got["a b"] == (10**6 * big * big // ((big + 7) * (big + 1)), big + 7, big + 1)
    cuts = [(10**6 * (big - 2) ** 2 // (x * y), k, x, y) for k, x, y in ((1, big + 7, big - 1), (2, big, big + 3))]
    assert got["a b c"] == (min(cuts)[0], *min(cuts)[2:])


@pytest.mark.parametrize("size", [1, 7, 30, 1000])
def test_segments_count_each_word_once(size):
    import pyarrow as pa

    rng = random.Random(size)
    texts = ["".join(rng.choice("ab .\t,") for _ in range(rng.randrange(0, 200))) for _ in range(30)] + [None, "", "  ", "ab" * 300]
    hasher, f = phrases.Hasher(), collections.Counter()
    for s in phrases.segments(pa.array(texts, pa.string()), size):
        low, starts, ends, follows = hasher.words(s.data)
        data = low.tobytes()
        for i, at in enumerate(starts.tolist()):
            if at >= s.own:
                continue
            text = max(k for k, b in enumerate(s.begins) if b <= at)
            place = at - s.begins[text] + s.offset[text]
            assert texts[s.rows[text]].encode()[place : place + ends[i] - at] == data[at : ends[i]]
            for n in range(1, 4):
                if i + n <= len(starts) and follows[i : i + n - 1].all():
                    f[b" ".join(data[starts[j] : ends[j]] for j in range(i, i + n)).decode()] += 1
    want = collections.Counter()
    for k, v in counted([(0, t, None) for t in texts]).items():
        if k[2]:
            want[k[1]] += v
    assert f == want


def test_filter_keeps_all(spark):
    fps = np.random.default_rng(5).integers(-(1 << 63), 1 << 63, 9000).tolist()
    kept = phrases.Filter(phrases.filter_of(spark.createDataFrame([(x,) for x in fps], "fp long")))
    assert kept.has(np.array(fps, np.int64).view(np.uint64)).all()
    chance = kept.has(np.random.default_rng(1).integers(0, 1 << 63, 20000, np.uint64)).mean()
    assert chance < 0.1 and math.log2(len(kept.bits)) % 1 == 0
