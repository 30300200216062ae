"""Corpus pipeline over ``documents``: language, quality, near duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all rows that
the stage before it kept.  Between stages the rows are written as Parquet to the shared
checkpoint folder and read again, so a lost executor never reaches back beyond a stage.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadlens.llm.common import table, written
from leadlens.llm.language_id import keep_known
from leadlens.llm.line_quality import keep_good
from leadlens.llm.mixing import mixed_docs
from leadlens.llm.ngram_join import first_of_each
from leadlens.llm.sentencepiece_sampling import encoded_docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in no known language go."""
    return keep_known(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that fail the counts or lose too much to the line rules go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays."""
    return first_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mixed_docs(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every row that the mix took."""
    return encoded_docs(docs)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("encoding", encoding),
]

#: sampling and trained models have no SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
