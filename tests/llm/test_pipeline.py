import collections
import os

import pytest

from sparklog.llm import queries
from tests.oracle import same_rows
from tests.llm.test_dedup import lowered, near_brute
from tests.llm.test_models import check_packing, waterfill, whole_ids

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    same_rows(queries.QUERIES[name](spark, SF), queries.ORACLE[name], SF)


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, frames = {}, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = frames[name] = stage(spark, docs, SF).cache()
        kept[name] = collections.Counter(r.doc_id for r in docs.collect())
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    score = queries.op3_toxicity(spark, SF).collect()
    assert set(kept["toxicity"]) == {r.doc_id for r in score if r.predicted == 0}

    text = {r.doc_id: r.text for r in frames["toxicity"].collect()}
    last = {}
    for i in sorted(text):
        last[lowered(text[i])] = i
    assert set(kept["exact_dedup"]) == set(last.values())

    want = near_brute([(i, text[i]) for i in kept["exact_dedup"]])
    assert not want - kept["near_dedup"] and sum(kept["near_dedup"].values()) <= 1.05 * sum(want.values())

    rows = {r.doc_id: r for r in frames["near_dedup"].collect()}
    size = collections.Counter()
    for r in rows.values():
        size[r.source] += len(r.text.split())
    got = collections.Counter()
    for i, n in kept["mixing"].items():
        assert n <= 3
        got[rows[i].source] += n * len(rows[i].text.split())
    for s, want in waterfill(size).items():
        assert abs(got[s] - want) <= 0.02 * want + 60

    parts = frames["packing"].collect()
    used = check_packing(parts, 4096)
    tokens = sum(len(whole_ids(rows[i].text)) * n for i, n in kept["mixing"].items())
    assert sum(r.length for r in parts) == tokens and used <= -(-tokens // 4096) * 1.05 + 1
