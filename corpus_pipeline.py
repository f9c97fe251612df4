"""From raw documents to packed training sequences: five stages, each on all that is kept before.

Every stage takes the session, the documents so far and the folder of the tables. The first
four return the columns of documents, the last the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakestay.llm import decontamination, jaccard_join, packing, quality, secret_scan
from lakestay.llm.batches import table
from lakestay.llm.components import stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the preference model does not reject; it learns from labels that are not held out."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, the one with the smallest id."""
    return jaccard_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and n_chars brought up to date."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens, as pieces of documents."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("packing", packed),
]

# Encoding, the learned model and the embedding cannot be put in SQL; tests/llm holds run()
# against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all packed sequences; each stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
