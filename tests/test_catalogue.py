"""Every registered query of the library against DuckDB on the smallest tables."""

import os

import pytest

from sparklog.plans import catalogue
from tests.oracle import same_rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, name):
    df = catalogue.QUERIES[name](spark, SF)
    if name in catalogue.ORACLE:
        same_rows(df, catalogue.ORACLE[name], SF)
    else:
        assert df.count() > 0


def test_strip_lenient_reads_whole_texts(spark, tmp_path):
    long = "word " * 2000
    texts = [long + "x> app: body " + long, long + " sender: body " + long, long + "<13>1 a b c d e - body"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.message for r in catalogue.QUERIES["strip_lenient_texts"](spark, str(tmp_path)).collect()}
    assert got == {0: "body " + long, 1: "body " + long, 2: "body"}
    same_rows(catalogue.QUERIES["strip_lenient_texts"](spark, str(tmp_path)), catalogue.ORACLE["strip_lenient_texts"], str(tmp_path))


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
