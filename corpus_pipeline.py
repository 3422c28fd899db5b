"""A training corpus from raw documents, one operator per stage.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and gives a DataFrame;
all but the last give the columns of documents. A stage's rows are written as Parquet and read again as
the next one's docs.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from rasterspark.llm import decontaminate, minhash, mixing, rules, simhash, tokens
from rasterspark.llm.common import materialise, release, scratch


def stage(operator):
    """A stage: the tables that the stages before it wrote for themselves go, since their rows are written by now."""

    @functools.wraps(operator)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, "pipeline")
        with scratch("pipeline"):
            return operator(spark, docs, sf_dir)

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null and empty texts have too few words and go; very long ones are judged whole; equal rows go or stay together; null ids
    make no difference; an empty table stays empty; extra columns stay, whatever their names.
    """
    return rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the least doc_id stays: of texts whose fingerprints (op1) differ in 4 bits or fewer, or
    that have 0.8 or more of their five-word shingles in common; a chain of either kind is one group.

    Null, empty and blank texts are one group; very long ones are compared whole; null ids come last and of equal rows one
    stays; an empty table stays empty; extra columns stay, whatever their names.
    """
    return simhash.keep_one(docs, minhash.groups(docs))


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go.

    Null and empty texts contain none and stay, as does everything if the benchmark is empty; very long texts are judged
    whole; equal rows go or stay together, rows of one id are judged apart, null ids included; extra columns stay.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@stage
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Null and empty texts have no words and are never taken; a null source is a source of its own; very long texts are taken
    whole or not; repeated rows are rows and null ids ids; an empty table stays empty; extra columns stay.
    """
    return mixing.take_mix(docs)


@stage
def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; a row per document as read back from them.

    Null and empty texts have the end id only; null ids come first; documents that the mix repeats are written each time;
    very long ones run over blocks; an empty table gives no files and no rows; extra columns are left out.
    """
    return tokens.read(tokens.write(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_files", token_files),
]

#: SQL expresses neither fingerprint components nor template alignments nor the coder; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = materialise(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
