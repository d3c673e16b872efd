import random

import numpy as np
import pytest

from sparklog.llm import line_dedup, prefix, simhash
from tests.llm.test_dedup import jaccard, unite, word_jaccard


def words(text):
    return np.unique(np.array([hash_of(w) for w in text.split()], np.int64))


def hash_of(w):
    return int(w) * 0x9E3779B97F4A7C1 % (1 << 63)


def alike(a, b):
    x, y = set(a.split()), set(b.split())
    return len(x & y) / len(x | y) >= 0.8


def test_prefix_length():
    """By counting: sets of n <= m at 0.8 or more leave at least one common element among so many first ones."""
    for n in range(1, 60):
        for m in range(n, 76):
            need = next((o for o in range(1, n + 1) if 5 * o >= 4 * (n + m - o)), None)
            if need:
                assert prefix.prefix_length(n) >= n - need + 1 and prefix.prefix_length(m) >= m - need + 1


@pytest.mark.parametrize("seed", range(2))
def test_pairs_are_all_there(spark, seed):
    """Sets of few and many elements, near copies and unlike ones: every pair at 0.8 is a candidate unless its roots are equal."""
    rng = random.Random(seed)
    texts = []
    for _ in range(60):
        base = rng.sample(range(400), rng.choice((1, 2, 5, 9, 30, 80)))
        for _ in range(rng.randrange(1, 5)):
            other = list(base)
            for _ in range(rng.randrange(1 + len(base) // 8)):
                other[rng.randrange(len(other))] = rng.randrange(400)
            texts.append(" ".join(map(str, sorted(set(other)))))
    texts = sorted(set(texts))
    rows = [(i, i // 3, t) for i, t in enumerate(texts)]
    got = {tuple(sorted(r)) for r in prefix.prefix_pairs(spark.createDataFrame(rows, "node long, root long, text string"), words, hot=10**6).collect()}
    want = {(i, j) for j in range(len(texts)) for i in range(j) if i // 3 != j // 3 and alike(texts[i], texts[j])}
    assert want and want <= got and all(i // 3 != j // 3 for i, j in got)
    assert len(got) < 0.3 * len(texts) ** 2 / 2
    assert prefix.prefix_pairs(spark.createDataFrame([], "node long, root long, text string"), words).count() == 0


def test_common_template_of_many(spark):
    """What all sets hold is nearly enough, or enough, by itself: components stay whole, and pairs are few."""
    rng = random.Random(5)
    rows = [(i, i, " ".join(map(str, [*range(100), *(1000 + 40 * i + k for k in range(rng.choice((0, 4, 8, 11, 13, 20, 30))))]))) for i in range(400)]
    found = [tuple(r) for r in prefix.prefix_pairs(spark.createDataFrame(rows, "node long, root long, text string"), words).collect()]
    assert len(found) < 6 * len(rows)
    text = {i: t for i, _, t in rows}
    want = unite(text, [(i, j) for j in text for i in range(j) if alike(text[i], text[j])])
    assert unite(text, [(a, b) for a, b in found if alike(text[a], text[b])]) == want


def planted(rng, n, pairs, own, edit):
    """n texts as lists of own(rng) parts, of which pairs are edited copies of earlier ones."""
    base = [own(rng) for _ in range(n - pairs)]
    return base + [edit(rng, base[i]) for i in range(pairs)]


def letters(rng, n):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))


def linked_share(texts, group, similarity):
    """Of the pairs at 0.8 or more, the share that is in one group."""
    pairs = [(i, j) for j in range(len(texts)) for i in range(j) if similarity(texts[i], texts[j]) >= 0.8]
    return len(pairs), sum(group[i] == group[j] for i, j in pairs) / len(pairs)


def test_lines_of_one_template(spark):
    """1,000 lines of one template: unrelated ones at about 0.76, 500 pairs at 0.8 to 0.85."""
    rng = random.Random(21)
    fixed = [letters(rng, 62) for _ in range(4)]

    def own(rng):
        return [letters(rng, 6) for _ in range(4)]

    def edit(rng, parts):
        return [*(letters(rng, 6) for _ in range(2)), *parts[2:]]

    texts = ["".join(f + s for f, s in zip(fixed, [*p, ""])) for p in planted(rng, 1000, 500, own, edit)]
    unrelated = jaccard(texts[0], texts[1])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    group = {r.doc_id: r.group_id for r in line_dedup.line_groups(df).collect()}
    sample = texts[:150] + texts[500:650]
    n, share = linked_share(sample, [group[i] for i in (*range(150), *range(500, 650))], jaccard)
    assert 0.7 < unrelated < 0.8 and n >= 100 and share >= 0.9


def test_documents_of_one_boilerplate(of):
    """1,000 documents with common boilerplate: unrelated ones at about 0.765, 500 pairs at 0.8 to 0.85."""
    rng = random.Random(22)
    common = " ".join(letters(rng, 6) for _ in range(330))

    def own(rng):
        return [letters(rng, 6) for _ in range(50)]

    def edit(rng, parts):
        return parts[:12] + [letters(rng, 6) for _ in range(38)]

    texts = [common + " " + " ".join(p) for p in planted(rng, 1000, 500, own, edit)]
    pairs = [i for i in range(500) if word_jaccard(texts[i], texts[500 + i]) >= 0.8]
    kept = {r.doc_id for r in simhash.without_near_copies(of(texts)).collect()}
    assert 0.74 < word_jaccard(texts[0], texts[1]) < 0.79 and len(pairs) > 450
    assert sum(500 + i not in kept for i in pairs) >= 0.9 * len(pairs) and set(range(500)) <= kept


def test_bitmaps_never_differ_in_more_than_the_sets():
    rng = np.random.default_rng(7)
    for size, changed in ((1, 1), (40, 3), (300, 60), (5000, 900)):
        a = np.unique(rng.integers(-(2**63), 2**63 - 1, size))
        b = np.unique(np.concatenate([a[changed:], rng.integers(-(2**63), 2**63 - 1, changed)]))
        differ = int(np.bitwise_count((prefix._bitmap(a) ^ prefix._bitmap(b)).view(np.uint64)).sum())
        assert differ <= len(np.setxor1d(a, b))
    assert not prefix._bitmap(np.zeros(0, np.int64)).any()


def test_bitmaps_joined_either_way(spark, monkeypatch):
    rng = np.random.default_rng(8)
    known = [str(i) for i in range(400)]
    texts = []
    for _ in range(30):
        own = list(rng.choice(known, 60, replace=False))
        texts += [" ".join(own), " ".join([*own[:-4], "900", "901"]), " ".join([*own[:40], *rng.choice(known, 20)])]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "node long, text string")
    sets = [set(t.split()) for t in texts]
    asked = [(i, j) for i in range(len(texts)) for j in range(i)]
    pairs = spark.createDataFrame(asked, "a long, b long")

    got = []
    for most in (10_000, 0):
        monkeypatch.setattr(prefix, "BROADCAST_SETS", most)
        got.append({(r.a, r.b) for r in prefix._few_bits_differ(pairs, rows, words).collect()})
    alike = {(i, j) for i, j in asked if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    assert len(alike) >= 30 and alike <= got[0] == got[1] and len(got[0]) < 2 * len(alike)
