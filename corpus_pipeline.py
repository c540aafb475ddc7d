"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, lines, minhash, mixing, quality, tokenizer_files
from millrace.llm.common import importable, table
from millrace.storage import remove, settled


def measured(docs: DataFrame) -> DataFrame:
    """n_chars after the text has changed."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that a rule rejects go."""
    importable(spark)
    return quality.keep(docs)


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines found in many documents go from every text."""
    return measured(lines.dedup(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each group stays."""
    return minhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: for each pass over a source, each document's words in the blocks drawn."""
    return measured(mixing.mixture(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: per document the token count and digests of its ids and of the decoded text."""
    return bpe.digests(docs, tokenizer_files.path())


STAGES = [
    ("quality rules", good),
    ("line dedup", without_common_lines),
    ("near dedup", one_of_each),
    ("mixing", mixed),
    ("bpe", tokens),
]

#: SQL can't express the draws of the mix; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, one after another.

    A stage's working folders and its input go once its result is written, so two stages' documents are
    held at most.
    """
    docs, held = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, path = settled(spark, f"pipeline-{name.replace(' ', '-')}", lambda docs=docs, stage=stage: stage(spark, docs, sf_dir))
        if held:
            remove(spark, held)
        held = path
    return STAGES[-1][1](spark, docs, sf_dir)
