"""The training-data pipeline: documents to token ids, in five stages.

Each stage takes all that the one before it kept, written as Parquet and read again, so a lost
executor or a failed stage never goes back further than one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barweave.llm import byte_bpe, decontaminate, jaccard_join, language, line_dedup
from barweave.session import work_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; others go."""
    return language.accepted(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that a document of smaller id holds."""
    return line_dedup.dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates."""
    return jaccard_join.distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; a few benchmark words in a long document are cut out."""
    return decontaminate.clean(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of the token ids, and of what they decode to."""
    return byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", encoding),
]

#: SQL cannot express the stages; tests compare them with plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        written = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(written)
        docs = spark.read.parquet(written)
    return docs
