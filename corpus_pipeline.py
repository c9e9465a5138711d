"""The corpus pipeline: toxicity, near duplicates, decontamination, personal data, mixing.

Every stage works on all documents that the one before it kept, written as Parquet and
read again.  The first four return the columns of documents; the last adds the mix to them:
size, source_size, target, taken and epochs.  Null and empty texts, repeated rows and empty tables
go through as the operators' docstrings say; columns with clashing names are carried unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadprint.llm import decontam, mixing, pii, simhash, toxicity
from roadprint.llm.common import forget, keep, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates (SimHash, 4 words, 4 bits) the smallest doc_id stays."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold 0.8 or more of a benchmark item in runs of 5 words or more."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, with personal data replaced by its kind in brackets."""
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, whole, each with the words and whole repetitions that the mix takes from it."""
    return mixing.mix_documents(docs)


STAGES = [("toxicity", without_toxic), ("simhash", one_per_group), ("decontamination", without_benchmark),
          ("pii", redacted), ("mixing", mixed)]

# Trained scores and span extraction have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            forget(before)
        before = docs
    return docs
