"""From raw documents to token files: five stages, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept. All but the last return the columns
of documents; the mix returns a document once for each copy it takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gripline.llm import decontaminate, minhash, mixing, quality, tokens
from gripline.llm.common import written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.5 or more."""
    return quality.good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near duplicates."""
    return minhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights take them."""
    return mixing.taken(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mixed documents, as read back from their files."""
    return tokens.round_trip(docs)


STAGES = [
    ("quality", keep_good),
    ("near_dedup", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: Trained networks, signatures and a vocabulary take part; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
