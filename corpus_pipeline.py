"""The corpus pipeline: toxic documents go, one of each group of near-duplicates stays, personal data is redacted,
sources are mixed to their targets, and the result is tokenized.

Each stage takes the documents that the one before it has kept, written as Parquet and read again, and returns
the columns of documents; the last one adds the token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumbung.llm import bpe, mixing, near_copies, personal_data, toxicity
from lumbung.llm.tables import table
from lumbung.session import fresh_folder


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of the folder, doesn't predict toxic."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked by a similarity of 0.8 or more (five-word shingles) the document with the smallest id.

    Candidates come from the SimHash fingerprints and Golay codewords of ``op1`` and from bands of minima.
    """
    return near_copies.one_of_each(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; no document is lost."""
    return personal_data.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's rate and their own draw say."""
    return mixing.emitted(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids."""
    return bpe.tokenized(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("personal_data", without_personal_data),
    ("mixing", mixed),
    ("tokens", tokenized),
]

# A trained classifier and token merges cannot be written in SQL; tests compare with plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
