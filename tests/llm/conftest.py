import pytest
from pyspark.sql import functions as F

#: doc_id, text, lang, source: nulls, empty and blank texts, repeated rows, one id with two texts.
DOCS = [
    (1, "Alpha beta gamma delta", "en", "s1"),
    (2, "alpha BETA gamma delta", "en", "s1"),
    (3, None, None, None),
    (4, "", "fr", "s2"),
    (5, " \t\n", "fr", "s2"),
    (6, "ÀB ça éÉ", "fr", None),
    (6, "ÀB ça éÉ", "fr", None),
    (7, "word " * 20000, "en", "s1"),
    (8, "one", None, "s3"),
    (8, "two words", "de", "s3"),
    (None, "nobody", "en", "s3"),
    (None, None, None, None),
    (9, "x" * 300000, "en", "s1"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that operators use inside.
CLASHES = "id row h sha n key block kept size at line root node a b n_rows total text_sha256 keep_id group_size rate copies taken score _n fp rid ord part kind data".split()


@pytest.fixture
def docs(spark):
    """A DataFrame of DOCS, with further columns whose names clash."""
    return spark.createDataFrame(DOCS, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="session")
def of(spark):
    """Texts -> a DataFrame with ids from 0."""
    return lambda texts: spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], SCHEMA)
