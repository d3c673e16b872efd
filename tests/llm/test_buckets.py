import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparklog.llm import buckets, prefix
from tests.llm.test_dedup import unite
from tests.llm.test_prefix import alike, planted, words


def always(a, x, b, y):
    return np.ones(len(a), bool)


def sets_of_one_template(rng, n):
    """n sets of which unrelated ones share 100 of 117 elements each (0.746), and neighbours in planted pairs some 5 more (0.82 and more): no set is alike to all."""
    fresh = iter(range(1000, 10**6))
    own = lambda rng: [next(fresh) for _ in range(17)]
    edit = lambda rng, e: e[: rng.randrange(9, 15)] + [next(fresh) for _ in range(4)]
    return [" ".join(map(str, [*range(100), *e])) for e in planted(rng, n, n // 2, own, edit)]


@pytest.mark.parametrize("held, block", [(2048, 1024), (8, 7)])
def test_no_link_of_a_bucket_is_lost(spark, monkeypatch, held, block):
    """One bucket of a template, one of near copies, small ones and chance meetings: components are those of all pairs that share a bucket."""
    monkeypatch.setattr(buckets, "HELD", held)
    monkeypatch.setattr(buckets, "BLOCK", block)
    rng = random.Random(31)
    texts = sets_of_one_template(rng, 200)
    copies = [" ".join(map(str, [*range(5000, 5100 - k), *range(9000 + 50 * k, 9000 + 51 * k)])) for k in range(12)]
    texts += [copies[k % 12] + f" {7000 + k}" for k in range(60)]
    key = [(0 if i < 200 else 1, i) for i in range(len(texts))] + [(2 + i % 50, i) for i in range(len(texts))]
    members = spark.createDataFrame([(k, i, 0) for k, i in key], "key long, node long, sketch long")
    members = members.withColumn("n", F.count("*").over(W.partitionBy("key"))).where("n > 1")
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    asked = []

    def verify(pairs):
        got = [tuple(r) for r in pairs.select("a", "b").collect()]
        asked.extend(got)
        return spark.createDataFrame([(a, b) for a, b in got if alike(texts[a], texts[b])], "a long, b long")

    links = [tuple(r) for r in buckets.bucket_links(members, always, verify, lambda nodes: prefix.bitmaps(rows.join(nodes, "node"), words)).collect()]
    share = {}
    for k, i in key:
        share.setdefault(k, []).append(i)
    pairs = {(a, b) for own in share.values() for b in own for a in own if a < b}
    nodes = range(len(texts))
    want = [(a, b) for a, b in pairs if alike(texts[a], texts[b])]
    assert len(want) > 100 and unite(nodes, links) == unite(nodes, want)
    assert len(asked) < 0.2 * len(pairs)


def test_sparse_buckets_make_no_rows_of_chance(spark):
    """Of a bucket whose members have little in common only near pairs come out, and no dense bucket."""
    import pyarrow as pa

    n, rng = 1500, np.random.default_rng(3)
    sketch = rng.integers(0, 2**62, n)
    sketch[1] = sketch[0] ^ 1
    near = lambda a, x, b, y: np.bitwise_count((x ^ y).view(np.uint64)) <= 6
    batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int64)), pa.array(np.arange(n)), pa.array(sketch), pa.array(np.full(n, n))], names=["key", "node", "sketch", "n"])
    out = [tuple(r.values()) for b in buckets._met(near)([batch.slice(0, 700), batch.slice(700)]) for r in b.to_pylist()]
    assert out == [(None, 0, 1, None, None)]


def test_keys_of_both_fingerprints(spark):
    """Of texts at about 0.8 to 0.84, fewer than 0.85 share a key of the first fingerprint's orders alone; of both, more."""
    import pyarrow as pa

    from sparklog.llm import simhash
    from tests.llm.test_dedup import word_jaccard
    from tests.llm.test_prefix import letters

    rng, pairs = random.Random(33), []
    while len(pairs) < 150:
        one = [letters(rng, 5) for _ in range(300)]
        other = list(one)
        for _ in range(rng.randrange(5, 9)):
            other[rng.randrange(300)] = letters(rng, 5)
        if 0.8 <= word_jaccard(" ".join(one), " ".join(other)) < 0.84:
            pairs.append((" ".join(one), " ".join(other)))
    prints = np.array([[simhash._signed(x) for x in simhash.two_fingerprints(t)] for p in pairs for t in p], np.int64)
    of = {}
    for b in simhash._keyed([pa.RecordBatch.from_arrays([pa.array(c) for c in prints.T.copy()], names=["fp", "fp2"])]):
        for key, node in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            of.setdefault(node, set()).add(key)
    fp = prints[:, 0].tolist()
    assert sum(bool(of[fp[i]] & of[fp[i + 1]]) for i in range(0, len(fp), 2)) >= 0.85 * len(pairs)


def test_candidates_of_near_copies_are_about_as_many_as_the_copies(spark):
    """150 near copies that meet in many small buckets, of ever other members: almost each two of them share one, but few are verified."""
    rng = random.Random(34)
    texts = [" ".join(map(str, [*range(100), *range(1000 + 9 * i, 1009 + 9 * i)])) for i in range(150)]
    key = []
    for k in range(60):
        order = rng.sample(range(150), 150)
        key += [(100 * k + at // 5, i) for at, i in enumerate(order)]
    members = spark.createDataFrame([(k, i, 0) for k, i in key], "key long, node long, sketch long").withColumn("n", F.count("*").over(W.partitionBy("key")))
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    asked, fetched = [], []

    def verify(pairs):
        got = [tuple(r) for r in pairs.select("a", "b").collect()]
        asked.extend(got)
        return spark.createDataFrame([(a, b) for a, b in got if alike(texts[a], texts[b])], "a long, b long")

    fetch = lambda nodes: fetched.extend(r.node for r in nodes.collect())
    links = [tuple(r) for r in buckets.bucket_links(members, always, verify, lambda nodes: prefix.bitmaps(rows.join(nodes, "node"), words), fetch).collect()]
    assert set(unite(range(150), links).values()) == {0}
    assert len(asked) < 2 * len(texts) and sorted(fetched) == list(range(150))


def test_similarity_of_lines_by_hashes_is_that_of_their_shingles():
    """Pairs around 0.8 get the same decision as by sets of shingles, and those further away the same number."""
    from sparklog.llm import line_dedup
    from tests.llm.test_prefix import letters

    rng, near = random.Random(35), 0
    for _ in range(1500):
        x = letters(rng, rng.randrange(5, 160)) + rng.choice(["", "é", "語", "aaaaaaaaaaaa"])
        y = list(x)
        for _ in range(rng.randrange(0, 2 + len(x) // 30)):
            y[rng.randrange(len(y))] = rng.choice("qé語")
        y = "".join(y)
        one, other = ({s[i : i + 5] for i in range(len(s) - 4)} for s in (x, y))
        want = len(one & other) / len(one | other)
        near += 0.75 < want < 0.85
        assert line_dedup._similarity(x, line_dedup._grams(x), y) == want
    assert near > 50


def jobs_of(spark, name, work):
    """How many Spark jobs work() starts, and what it gives."""
    context = spark.sparkContext
    context.setJobGroup(name, name)
    try:
        out = work()
        context._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        return len(context.statusTracker().getJobIdsForGroup(name)), out
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("part", [125_000, 40])
def test_jobs_of_components(spark, monkeypatch, part):
    """A chain, a star and random links, in one part and in many: right roots, and where they fit in one part no rounds, whose jobs fill the driver."""
    from sparklog.llm import components

    monkeypatch.setattr(components, "PART_LINKS", part)
    rng = random.Random(36)
    links = [(i, i + 1) for i in rng.sample(range(500, 900), 400)] + [(-7, i) for i in range(1000, 1100)] + [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(5, None)]
    rows = spark.createDataFrame(links, "a long, b long").repartition(7).localCheckpoint()
    jobs, found = jobs_of(spark, f"components-{part}", lambda: components.components(rows))
    got = {r.node: r.root for r in found.collect()}
    want = unite({x for p in links for x in p if x is not None}, [p for p in links if None not in p])
    assert got == {x: r for x, r in want.items() if x != r}
    assert part == 40 or jobs <= 8


def test_a_saved_table_is_read_without_a_job(spark):
    """The schema is known, nested and empty ones too, so files are not opened for it."""
    from sparklog.llm.common import saved

    rows = spark.range(10).selectExpr("id", "struct(id AS x, array(id) AS y) AS s", "cast(null AS binary) AS b")
    for name, df in (("all", rows), ("none", rows.where("id < 0"))):
        jobs, out = jobs_of(spark, f"saved-{name}", lambda df=df: saved(df, "test-saved"))
        assert jobs <= 1 and sorted(map(str, out.collect())) == sorted(map(str, df.collect())) and out.dtypes == df.dtypes


@pytest.mark.parametrize("block, elements", [(1024, 1 << 20), (7, 1 << 20), (1024, 1 << 12)])
def test_families_are_verified_where_they_are_compared(spark, monkeypatch, block, elements):
    """12 variants of one template at about 0.77, 20 near copies of each: groups are those of all pairs, and few pairs leave the tasks."""
    from sparklog.llm import line_dedup
    from tests.llm.test_prefix import jaccard, letters

    monkeypatch.setattr(buckets, "BLOCK", block)
    monkeypatch.setattr(buckets, "ELEMENTS", elements, raising=False)
    kept = line_dedup.saved
    rows = []

    def counted(df, name):
        out = kept(df, name)
        if name == "line-near":
            rows.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "saved", counted)
    rng = random.Random(37)
    fixed = [letters(rng, 62) for _ in range(4)]
    texts = []
    for _ in range(12):
        line = "".join(f + s for f, s in zip(fixed, [letters(rng, 7) for _ in range(3)] + [""]))
        texts += [line + letters(rng, 2) for _ in range(20)]
    texts = sorted(set(texts))
    group = {r.doc_id: r.group_id for r in line_dedup.line_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want = unite(range(len(texts)), [(i, j) for j in range(len(texts)) for i in range(j) if jaccard(texts[i], texts[j]) >= 0.8])
    assert group == want and 5 < len(set(want.values())) < 60
    assert sum(rows) < 2 * len(texts)


def test_which_of_many_are_alike():
    """Of lines and of sets: one held against many gives what pairs give one by one."""
    import pyarrow as pa

    from sparklog.llm import line_dedup, simhash
    from tests.llm.test_prefix import letters

    rng = random.Random(38)
    base = letters(rng, 90)
    lines = ["aaaaa", "aaaaaaaa", "aaaaab"]
    for _ in range(120):
        y = list(base[: rng.randrange(60, 91)])
        for _ in range(rng.randrange(4)):
            y[rng.randrange(len(y))] = rng.choice("qé語")
        lines.append("".join(y))
    grams = [line_dedup._grams(x) for x in lines]
    sets = [[1, 2, 3, 4], [1, 2, 3, 4, 5], [-9, 7], [7], *(g.tolist() for g in grams)]
    of_lines, of_sets = line_dedup.alike_lines(pa.array(lines)), simhash.alike_sets(pa.array([[0], *sets], pa.list_(pa.int64())).slice(1))
    everything = np.arange(len(lines)), np.arange(len(sets))
    linked = 0
    for i, x in enumerate(lines):
        want = [line_dedup._similarity(x, grams[i], y) >= 0.8 for y in lines]
        linked += sum(want) - 1
        assert of_lines(i, everything[0]).tolist() == want
    assert 500 < linked < len(lines) ** 2 - 500
    for i, x in enumerate(sets):
        assert of_sets(i, everything[1]).tolist() == [len(set(x) & set(y)) >= 0.8 * len(set(x) | set(y)) for y in sets]
