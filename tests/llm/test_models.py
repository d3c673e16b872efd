import collections
import hashlib
import itertools
import math
import os
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparklog.llm import fingerprint, langid, mixing, packing, toxicity, warc
from tests.llm.conftest import DOCS, SCHEMA

SF = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


# --- mixing -----------------------------------------------------------------


def waterfill(size):
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [s for s in size if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = sum(size.values()), {}, set(size)
    while open_:
        left = total - sum(target.values())
        w = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / w > 3 * size[s]}
        if not full:
            return target | {s: left * weight[s] / w for s in open_}
        target |= {s: 3 * size[s] for s in full}
        open_ -= full
    return target


def test_mixing(spark):
    rng = random.Random(1)
    docs = [(i, " w" * min(3000, int(rng.paretovariate(1) * 20)), "en", rng.choice(["a", "B", "é", None, "z" * 3, "tiny"] + ["big"] * 6)) for i in range(1500)]
    docs = [d for d in docs if d[3] != "tiny" or d[0] < 40] + [(9000, "", "en", "empty"), (9001, None, "en", "empty")]
    df = spark.createDataFrame(docs, SCHEMA)
    got = mixing.mix(df).collect()
    size, taken = collections.Counter(), collections.Counter()
    source = {d[0]: d[3] for d in docs}
    for d in docs:
        size[d[3]] += len((d[1] or "").split())
    want = waterfill(size)
    for r in got:
        s = source[r.doc_id]
        taken[s] += r.taken
        assert r.source_size == size[s] and math.isclose(r.target, want[s], rel_tol=1e-9, abs_tol=1e-6)
        assert r.taken <= 3 * r["size"] and r.taken % max(1, r["size"]) == 0 and 0 <= r.rate <= 3
    assert math.isclose(sum(want.values()), sum(size.values()))
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.01 * t + 25, (s, t, taken[s])
    # exponential tilt: in a source, log(rate) * (mean + size) / size is one number below the most
    for s in ("big", "é"):
        mean = size[s] / sum(1 for d in docs if d[3] == s)
        tilts = [math.log(r.rate) * (mean + r["size"]) / r["size"] for r in got if source[r.doc_id] == s and 0 < r["size"] and r.rate < 2.999]
        assert not tilts or max(tilts) - min(tilts) < 1e-6
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


@tables
def test_mixing_does_not_depend_on_the_layout(spark):
    docs = table(spark, "documents")
    first = sorted(map(tuple, mixing.mix(docs).collect()), key=repr)
    assert sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=repr) == first
    assert sorted(map(tuple, mixing.mix(docs.orderBy(F.desc("text")).coalesce(2)).collect()), key=repr) == first


def test_mixing_edges(docs, none):
    assert mixing.mix(none).count() == 0
    got = mixing.mix(docs)
    assert got.count() == len(DOCS)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.count() == got.agg(F.sum("copies")).first()[0]
    many = docs.where("doc_id = 1").withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(100)))).drop("again").unionByName(docs.where("doc_id IN (2, 6, 8)"))
    copies = collections.Counter(r.doc_id for r in mixing.mixed(many).collect())
    assert copies == collections.Counter({r.doc_id: r.n for r in mixing.mix(many).groupBy("doc_id").agg(F.sum("copies").alias("n")).collect() if r.n})


# --- toxicity ---------------------------------------------------------------


def brute_ratios(rows):
    """word -> log P(word | 1) - log P(word | 0), and the one of a word never seen."""
    pairs = {0: set(), 1: set()}
    for y, t in rows:
        w = toxicity.words(t)
        pairs[y] |= set(zip(w, [""] + w[:-1]))
    count = {y: collections.Counter(w for w, _ in p) for y, p in pairs.items()}
    both = collections.Counter(w for w, _ in pairs[0] | pairs[1])
    cut = lambda c: min(c, max(0.75, math.sqrt(c)))
    left = {y: sum(map(cut, count[y].values())) / len(pairs[y]) for y in (0, 1)}

    def p(y, w):
        shared = (both[w] - 0.75 + 0.75 * len(both) / (len(both) + 1)) / sum(both.values())
        c = count[y][w]
        return (c - cut(c)) / len(pairs[y]) + left[y] * shared

    return {w: math.log(p(1, w) / p(0, w)) for w in both}, math.log(left[1] / left[0])


def brute_likeness(text, ratios, unseen):
    r = sorted(ratios.get(w, unseen) for w in toxicity.words(text))
    if not r:
        return 0.0
    k = -(-len(r) // 50)
    return sum(r[-k:]) / k - (r[(len(r) - 1) // 2] + r[len(r) // 2]) / 2


@tables
def test_toxicity_against_brute_force(spark, monkeypatch):
    """Whole texts: models of all rows and of the folds, likeness, curve, score."""
    docs, labels = table(spark, "documents"), table(spark, "labels")
    mark = {r.doc_id: r.toxic for r in labels.collect()}
    rows = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("fold")).collect()
    taught = [r for r in rows if r.doc_id in mark and zlib.crc32(str(r.doc_id).encode()) % 5]
    whole = brute_ratios([(mark[r.doc_id], r.text) for r in taught])
    fold = [brute_ratios([(mark[r.doc_id], r.text) for r in taught if r.fold == k]) for k in (0, 1)]
    x = np.array([(brute_likeness(r.text, *fold[1 - r.fold]), math.log1p(len(toxicity.words(r.text))), 1) for r in taught])
    w = toxicity._fit(x, np.array([mark[r.doc_id] for r in taught], float))
    want = {r.doc_id: (like, 1 / (1 + math.exp(-(w[0] * like + w[1] * math.log1p(len(toxicity.words(r.text))) + w[2])))) for r in rows for like in [brute_likeness(r.text, *whole)]}
    for most in (toxicity.BROADCAST_WORDS, 0):  # broadcast and joined models agree
        monkeypatch.setattr(toxicity, "BROADCAST_WORDS", most)
        got = {r.doc_id: (r.likeness, r.score) for r in toxicity.toxicity_scores(docs, labels).collect()}
        assert got.keys() == want.keys()
        for i, (like, score) in got.items():
            assert math.isclose(like, want[i][0], abs_tol=1e-5) and math.isclose(score, want[i][1], abs_tol=1e-4)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    got = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got)
    toxic = [r.predicted for r in got if r.toxic]
    assert sum(toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in got if not r.toxic) <= 0.01 * len(got)
    wins = [(a.score > b.score) + 0.5 * (a.score == b.score) for a in got if a.toxic for b in got if not b.toxic]
    assert sum(wins) / len(wins) > 0.96


def test_toxicity_edges(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (7, 0), (None, 1), (8, 5)], "doc_id long, toxic int")
    for d, n in ((docs, len(DOCS)), (none, 0)):
        for marks in (labels, labels.where("false")):
            got = toxicity.toxicity_scores(d, marks).collect()
            assert len(got) == n and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out is not None for r in got)
    assert toxicity.without_toxic(docs, labels.where("false")).columns == docs.columns
    twice = toxicity.toxicity_scores(docs.unionByName(docs), labels).where("doc_id = 6").collect()
    assert len(twice) == 4 and len({r.score for r in twice}) == 1


def test_planted_phrase_is_caught(spark):
    """Every word of a set phrase tells, also those that always follow the same word."""
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(900):
        w = [f"w{rng.randrange(300)}" for _ in range(60)]
        if i % 2:
            w[30:30] = ["grab", "some", "burlap"]
        docs.append((i, " ".join(w)))
        labels.append((i, i % 2))
    got = toxicity.toxicity_scores(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)
    ratios, unseen = brute_ratios([(i % 2, t) for i, t in docs])
    assert min(ratios[w] for w in ("some", "burlap")) > unseen


# --- language ---------------------------------------------------------------


@tables
def test_language_held_out(spark):
    docs = table(spark, "documents")
    got = langid.predict_language(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in got)
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98


@tables
def test_language_mixture(spark):
    docs = table(spark, "documents").where("lang IN ('de', 'es')")
    langs, model = langid.train(docs.select("lang", "text"))
    one = {lang: docs.where(F.col("lang") == lang).orderBy(F.desc("n_chars")).first().text[:4000] for lang in langs}
    assert set(langid.infer(one["de"], model)) == {langs.index("de")}
    mixed = langid.infer(one["de"][:3000] + "\n" + one["es"][:1000], model)
    assert len(mixed) == 2 and 0.6 < mixed[langs.index("de")] < 0.9 and math.isclose(sum(mixed.values()), 1, abs_tol=1e-6)


def brute_trigrams(text):
    """Word by word, the trigrams that end on each letter."""
    words, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            words.append([("  " + word)[i : i + 3] for i in range(len(word))])
            word = ""
    return words


def cell(gram):
    """The cell that a trigram is counted in, as the model has it."""
    a, b, c = map(ord, gram)
    h = ((a * 0x9E3779B97F4A7C15 + b) * 0xC2B2AE3D27D4EB4F + c) * 0x165667B19E3779F9
    return h % (1 << 64) >> 48


def brute_mixture(text, prob, langs):
    """Proportions by plain expectation-maximisation over the words, and the set by penalised likelihood."""
    words = brute_trigrams(text)
    if not words:
        return {}
    logs = [[sum(math.log(prob(x, g)) for g in w) for x in langs] for w in words]

    def em(some):
        share, last = [1 / len(some)] * len(some), -math.inf
        for _ in range(500):
            resp, total = [0.0] * len(some), 0.0
            for row in logs:
                top = max(row)
                mixed = [s * math.exp(row[k] - top) for s, k in zip(share, some)]
                total += math.log(sum(mixed)) + top
                resp = [a + m / sum(mixed) for a, m in zip(resp, mixed)]
            share = [r / len(logs) for r in resp]
            if total - last < 1e-9:
                break
            last = total
        return share, total

    best = None
    for n in range(1, len(langs) + 1):
        for some in itertools.combinations(range(len(langs)), n):
            share, total = em(some)
            value = total - (n - 1) * langid.PENALTY * math.log(len(words) + 1)
            if best is None or value > best[0]:
                best = (value, {langs[k]: s for k, s in zip(some, share)})
    return best[1]


@tables
def test_language_against_brute_force(spark):
    docs = table(spark, "documents").where("text IS NOT NULL AND n_chars < 1500")
    rows = [r for r in docs.collect() if r.lang]
    count = collections.defaultdict(collections.Counter)
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            count[r.lang].update(cell(g) for w in brute_trigrams(r.text) for g in w)
    langs = sorted(count)
    size = {x: sum(count[x].values()) for x in langs}
    prob = lambda x, g: (count[x][cell(g)] + langid.SMOOTHING) / (size[x] + langid.SMOOTHING * langid.CELLS)
    by = {x: [r.text for r in rows if r.lang == x and r.n_chars > 200] for x in langs}
    texts = [r.text for r in rows[:40]] + [by[a][k][:400] + "\n" + by[b][k][:250] for k in range(3) for a in langs for b in langs if a != b]
    df = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(-k - 1, t, None) for k, t in enumerate(texts)], "doc_id long, text string, lang string"))
    got = {-r.doc_id - 1: r for r in langid.predict_language(df).where("doc_id < 0").collect()}
    same, mixtures = 0, 0
    for k, t in enumerate(texts):
        want = brute_mixture(t, prob, langs)
        if set(got[k].langs) == set(want):
            same, mixtures = same + 1, mixtures + (len(want) > 1)
            assert all(abs(got[k].langs[x] - want[x]) < 0.02 for x in want)
            assert got[k].lang_pred == max(sorted(want), key=want.get)
    assert same >= 0.97 * len(texts) and mixtures > 20


def test_all_languages_are_learnt(spark):
    """300 languages, each of letters of its own order: with fewer cells for each, all are told apart, and the model keeps to its size."""
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    tongues = {f"l{k:03d}": ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 8))) for _ in range(40)] for k in range(300)}
    said = lambda words: " ".join(rng.choice(words) for _ in range(60))
    rows = [(3 * i + j, said(words), name) for i, (name, words) in enumerate(tongues.items()) for j in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, model = langid.train(df.select("lang", "text"))
    assert len(langs) == 300 and model.shape == (langid.cells_for(300), 300) and model.size <= langid.MODEL_CELLS
    fresh = [(-k - 1, said(words), None) for k, words in enumerate(tongues.values())]
    got = {r.doc_id: r.lang_pred for r in langid.predict_language(df.unionByName(spark.createDataFrame(fresh, df.schema))).where("doc_id < 0").collect()}
    names = list(tongues)
    taught = {r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1}
    want = {-k - 1: n for k, n in enumerate(names) if n in taught}
    assert len(want) > 250 and all(got[i] == n for i, n in want.items())
    assert langid.cells_for(200) == langid.CELLS and langid.cells_for(10**9) == langid.LEAST_CELLS


def test_language_edges(docs, none):
    got = {(r.doc_id, r.lang_pred) for r in langid.predict_language(docs).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (None, "und")} <= got
    assert langid.predict_language(none).count() == 0
    untaught = langid.predict_language(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in untaught} == {"und"} and all(r.score == 0 for r in untaught)


def test_trigram_cells():
    cells, starts = langid.trigram_cells("Ab, ab!\n\tÉ1é")
    assert starts.tolist() == [0, 2, 4, 5] and cells[:2].tolist() == cells[2:4].tolist()
    assert cells[4] == cells[5]
    assert not len(langid.trigram_cells("12 --")[0])


# --- packing ----------------------------------------------------------------


def whole_ids(text):
    from tokenizers import Tokenizer

    whole_ids.t = getattr(whole_ids, "t", None) or Tokenizer.from_file(packing.default_tokenizer())
    return whole_ids.t.encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_against_tokenizer():
    of = packing._Ids(packing.default_tokenizer())
    rng = random.Random(8)
    alphabet = [*"abzAZéÉçßÖñİKſ0129.,;:!?'\"-_|<>\n\t\r\x0b\x1c\x85  ́字𝔸😀", "'s", "'re", "<|endoftext|>", "<|STARTOFTEXT|>", "ll."]
    for _ in range(4000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(14)))
        assert np.frombuffer(of.of(t), "<u4").tolist() == whole_ids(t), repr(t)


def check_packing(parts, room):
    by = collections.defaultdict(list)
    for r in parts:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= room
    return len(by)


def test_packing(docs, none):
    got = packing.pack_documents(docs).collect()
    check_packing(got, 4096)
    want = collections.Counter()
    for i, t, *_ in DOCS:
        ids = whole_ids(t)
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            want[(i, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert packing.pack_documents(none).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan(spark, seed, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_ROWS", 20)
    rng = random.Random(seed)
    room = 256
    draw = [lambda: rng.randint(1, room), lambda: min(room, int(rng.lognormvariate(4, 1)) + 1), lambda: rng.choice([room // 2 + 1, room // 3, 5]), lambda: rng.choice([129, 127, 64, 1])][seed]
    lengths = [draw() for _ in range(1500)]
    hist = collections.Counter(lengths)
    made = collections.Counter()
    for key, m in packing.plan(dict(hist), room, 1):
        assert sum(key) <= room and m > 0
        for n in key:
            made[n] += m
    assert made == hist
    parts = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "row long, piece int, length long")
    got = packing.pack(parts, room, 1).collect()
    used = check_packing(got, room)
    best = []
    for n in sorted(lengths, reverse=True):  # best fit by falling length
        fits = [i for i, x in enumerate(best) if x + n <= room]
        if fits:
            best[max(fits, key=lambda i: best[i])] += n
        else:
            best.append(n)
    assert used <= len(best) * 1.02 + 1


@pytest.mark.parametrize("seed", range(3))
def test_plan_on_both_sides_of_the_steps(seed):
    """At the ratio of room to step that the query has: few lengths go exactly, many in steps; all pieces are placed, within 2 % of best fit."""
    rng = random.Random(seed)
    for kinds in (6, 200):
        sizes = rng.sample(range(1, 257), kinds)
        lengths = [rng.choice(sizes) for _ in range(3000)]
        hist, made, used, free = collections.Counter(lengths), collections.Counter(), 0, []
        assert (len(hist) <= 128) == (kinds == 6)
        for key, m in packing.plan(dict(hist), 256, 2):
            assert sum(key) <= 256
            used += m
            for n in key:
                made[n] += m
        assert made == hist
        for n in sorted(lengths, reverse=True):
            fits = [i for i, x in enumerate(free) if x >= n]
            best = min(fits, key=lambda i: free[i]) if fits else free.append(256) or len(free) - 1
            free[best] -= n
        assert used <= 1.02 * len(free) + 1


def test_nonnegative_fit():
    rng = np.random.default_rng(9)
    a, x = rng.random((12, 30)), np.maximum(0, rng.normal(size=30))
    fit = packing.nonnegative_fit(a, a @ x)
    assert (fit >= 0).all() and np.linalg.norm(a @ fit - a @ x) < 0.02 * np.linalg.norm(a @ x)


# --- fingerprints -----------------------------------------------------------


def plain_chunks(data):
    """Digest and length of the chunks, byte by byte: the gear hash rolls over the last 16 bytes, its bits 10 to 15 decide."""
    gear = [xxhash.xxh32_intdigest(bytes([b])) for b in range(256)]
    out, start, h = set(), 0, 0
    for i, b in enumerate(data):
        h = ((h << 1) + gear[b]) & 0xFFFF
        size = i + 1 - start
        ends = (size >= 32 and (h >> 10) % 16 == 0) or (size >= 8 and (h >> 10) % 64 == 0)
        if ends or size == 128 or i + 1 == len(data):
            out.add((xxhash.xxh32_intdigest(data[start : i + 1]), size))
            start = i + 1
    return out


def plain_text(chunks):
    return "".join(sorted(f"{d:08x}{n:02x}" for d, n in chunks))


def plain_likeness(a, b):
    if not a or not b:
        return float(a == b)
    return sum(n for _, n in a & b) / min(sum(n for _, n in a), sum(n for _, n in b))


def edited_brute(docs):
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0), reverse=True)
    order = sorted(order, key=lambda d: (-(d[0] if d[0] is not None else -(1 << 62)), (d[1] or "").encode()))
    out = []
    for d, after in zip(order, order[1:] + order[:1]):
        t, u = d[1] or "", after[1] or ""
        m = len(t) // 3
        e = (t[: len(t) - m] + u[:m]).encode()
        f, g, h = (plain_chunks(x) for x in (t.encode(), e, u.encode()))
        out.append((d[0], len(t), hashlib.sha256(e).hexdigest(), plain_text(f), plain_text(g), plain_likeness(f, g), plain_likeness(f, h)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_rows", [5000, 1, 3])
def test_fingerprints(docs, none, block_rows):
    got = fingerprint.document_fingerprints(docs, block_rows=block_rows)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == edited_brute(DOCS)
    assert fingerprint.document_fingerprints(none, block_rows=block_rows).count() == 0
    one = fingerprint.document_fingerprints(docs.where("doc_id = 1"), block_rows=block_rows).first()
    assert one.near_next == 1.0


def test_chunks():
    rng = random.Random(10)
    data = bytes(rng.randrange(97, 123) for _ in range(20000))
    ends = fingerprint.boundaries(data)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes[:-1].min() >= fingerprint.LEAST and sizes.max() <= fingerprint.MOST
    moved = fingerprint.chunk_set(b"some words in front " + data)
    assert fingerprint.containment(fingerprint.chunk_set(data), moved) > 0.97
    assert fingerprint.containment(fingerprint.chunk_set(data[:5000]), fingerprint.chunk_set(data)) > 0.95
    assert fingerprint.containment(fingerprint.chunk_set(data[:9000]), fingerprint.chunk_set(data[9000:])) < 0.05


# --- revisits ---------------------------------------------------------------

CAPTURES = "record_id long, url string, ts long, kind string, status int, headers map<string,string>, digest string"


def test_canonical_urls(spark):
    urls = {
        "HTTP://User@WWW2.Example.com:80/a/b/?b=2&a=1&utm_source=x#f": "example.com/a/b?a=1&b=2",
        "https://example.com": "example.com/", "https://example.com/?": "example.com/", "https://example.com:443//": "example.com/", " http://m.example.com/A ": "m.example.com/A", "example.com?x=1": "example.com/?x=1",
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.c for r in df.select("u", warc.canonical_url(F.col("u")).alias("c")).collect()} == urls


def test_revisit_cases(spark):
    u, v = "http://e.com/a", "https://www.e.com/a/"
    rows = [
        (1, u, 10, "response", 200, {"ETag": '"x"', "Content-Type": "text/html", "Date": "old", "Content-Length": "5"}, "d1"),
        (2, u, 10, "response", 404, {"ETag": '"y"'}, "d2"),
        (3, v, 5, "revisit", 304, {"ETag": '"x"'}, None),
        (4, v, 10, "revisit", 304, {"ETag": '"x"'}, None),
        (5, v, 11, "revisit", 304, {"etag": 'W/"x"', "DATE": "newer", "content-type": "no"}, None),
        (6, v, 12, "revisit", 304, {"ETag": '"z"'}, "d1"),
        (7, v, 13, "revisit", 304, {}, "d1"),
        (8, v, 14, "revisit", 304, None, None),
        (9, v, 15, "revisit", 304, {"ETag": '"x"'}, "other"),
        (10, None, 15, "revisit", 304, {"ETag": '"x"'}, "d1"),
        (11, v, None, "revisit", 304, {"ETag": '"x"'}, "d1"),
        (12, v, 20, "response", 200, {"Last-Modified": "t"}, "d3"),
        (13, v, 21, "revisit", 304, {"Last-Modified": "t"}, None),
        (14, v, 22, "revisit", 304, {"Last-Modified": "u"}, None),
        (15, v, 23, None, None, None, None),
    ]
    for most in (warc.MOST_TIMES, 1):
        got = {r.record_id: r for r in warc.resolve_revisits(spark.createDataFrame(rows, CAPTURES), most_times=most).collect()}
        assert {k: (r.source_id, r.resolution) for k, r in got.items()} == {
            3: (None, "no_earlier_response"), 4: (None, "no_earlier_response"), 5: (1, "etag"), 6: (1, "etag_mismatch"), 7: (1, "digest"), 8: (1, "no_validator"), 9: (1, "digest_mismatch"),
            10: (None, "no_earlier_response"), 11: (None, "no_earlier_response"), 13: (12, "last_modified"), 14: (12, "last_modified_mismatch"),
        }
        assert got[5].headers == {"etag": 'W/"x"', "date": "newer", "content-type": "text/html", "content-length": "5"}
        assert got[5].digest == "d1" and got[6].headers is None
    assert warc.resolve_revisits(spark.createDataFrame([], CAPTURES)).count() == 0


def test_revisits_of_a_hot_url(spark):
    rng = random.Random(11)
    rows = [(i, "http://hot.com/" if i % 3 else f"http://h{i % 7}.com/", rng.randrange(400), rng.choice(["response", "revisit"]), 200, {"ETag": '"x"'}, None) for i in range(900)]
    best = {}
    for r in rows:
        if r[3] == "response":
            best[(r[1], r[2])] = max(r[0], best.get((r[1], r[2]), -1))
    want = {r[0]: best[max((k for k in best if k[0] == r[1] and k[1] < r[2]), key=lambda k: k[1])] if any(k[0] == r[1] and k[1] < r[2] for k in best) else None for r in rows if r[3] == "revisit"}
    for most in (warc.MOST_TIMES, 50):
        got = warc.resolve_revisits(spark.createDataFrame(rows, CAPTURES), most_times=most).collect()
        assert {r.record_id: r.source_id for r in got} == want


def test_captures_have_every_outcome(spark):
    pages = spark.range(3000).selectExpr("id AS page_id", "concat('http://h', id % 40, '.org/', id) AS url", "concat('text ', id) AS html")
    got = warc.resolve_revisits(warc.captures_of(pages)).collect()
    assert {r.resolution for r in got} == {"etag", "last_modified", "digest", "etag_mismatch", "last_modified_mismatch", "digest_mismatch", "no_validator", "no_earlier_response"}
    assert len({r.source_id // 4 - r.record_id // 4 for r in got if r.source_id is not None}) > 5


def test_repeated_records(spark):
    rows = [(1, "http://e/", 1, "response", 200, {"ETag": '"b"'}, "d2"), (1, "http://e/", 1, "response", 200, {"ETag": '"a"'}, "d1"), (2, "http://e/", 5, "revisit", 304, {"ETag": '"a"'}, None)] + [(3, None, 5, "revisit", 304, None, None)] * 3
    got = warc.resolve_revisits(spark.createDataFrame(rows, CAPTURES)).collect()
    assert sorted((r.record_id, r.source_id or 0, r.resolution) for r in got) == [(2, 1, "etag")] + [(3, 0, "no_earlier_response")] * 3


def test_captures_of_nulls(spark):
    pages = spark.createDataFrame([(None, None, None), (1, None, "x"), (2, "http://a/", None), (2, "http://a/", None)], "page_id long, url string, html string").withColumn("status", F.lit("clash"))
    assert warc.resolve_revisits(warc.captures_of(pages)).where("record_id IS NULL").count() == 1
