"""Corpus pipeline: toxicity, near duplicates, benchmark decontamination, personal data, mixing.

Each stage gets the documents that the stage before wrote, and its decisions take effect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm.decontaminate import without_contaminated
from lodestone.llm.mixing import mix
from lodestone.llm.ngram_join import one_of_each
from lodestone.llm.pii import redacted
from lodestone.llm.toxicity import without_toxic
from lodestone.llm.work import store


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text is not scored as toxic."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows hold less than a twentieth of the words."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced."""
    return redacted(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixing", mixing),
]

#: Trained scores decide the first stage, which SQL can't express; test_one_of_each and test_stages hold the others against brute force or small known cases.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = store(stage(spark, docs, sf_dir), name)
    return docs
