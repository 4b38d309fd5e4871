"""The corpus pipeline: quality rules, exact dedup, near duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every
stage's rows as Parquet to the shared folder and reads them as the next stage's docs.  A
stage starts by removing the scratch tables of the stage before.  Texts go to Python in
small batches, as memory is what the stages' workers share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recflow.llm import bpe, exact_dedup, mixing, ngram_join, quality
from recflow.llm.common import read, small_batches, stage, stored


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_quality(docs, read(spark, sf_dir, "labels"))


@stage
def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


@stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.resample(docs, in_files=bool(docs.inputFiles()))


@stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = bpe.digests(docs.select("doc_id", "source", "text"))
    return out.select("doc_id", "source", "_tokens.*")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("ngram_join", near_duplicates),
    ("mixing", source_mix),
    ("bpe", tokens),
]

#: SQL can't express the learned rules or the draws; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    with small_batches(spark):
        for name, apply in STAGES:
            docs = stored(apply(spark, docs, sf_dir), name)
    return docs
