"""From raw documents to packed token sequences: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparklog.llm.common import saved, table
from sparklog.llm.exact_dedup import without_copies
from sparklog.llm.mixing import mixed
from sparklog.llm.packing import pack_documents
from sparklog.llm.simhash import without_near_copies
from sparklog.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that op3's operator does not predict toxic.

    Null and empty texts are judged by the curve alone; rows that repeat go or stay together; very long texts are scored whole;
    an empty table stays empty. This and the next three stages keep the columns of docs, whatever else they are called.
    """
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for A-Z's case, the row with the largest id. Null counts as empty, a null id is the smallest, of rows that repeat id and text one stays."""
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose five-word shingles are 0.8 alike or more, found by op4's fingerprints and keys, the one with the smallest id. Null and empty texts are copies; of rows that repeat id and text one stays."""
    return without_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as op2's mix takes it, which may be not at all. Null and empty texts have no words and are not taken; rows that repeat share their copies; the order of docs does not matter."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of op8's sequences. A null or empty text has the end-of-document id alone; rows that repeat are packed each by itself; long texts are cut into pieces of 4096; an empty table gives no rows."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]
#: SQL expresses neither the scores, nor the similarities, nor the tokens; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
