"""Queries of this subpackage, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import ann, bpe, chat, licenses, lines, merkle, merkle_sql, minhash, mixing, oracle, packing, pii, quality, tokenizer_files, toxicity, trie, trie_sql
from millrace.llm.common import table


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 50 = 0"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(table(spark, sf_dir, "documents"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_files.path())


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents")).drop("rejected_by")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(table(spark, sf_dir, "documents"), tokenizer_files.path("word_bpe_49k.json"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(table(spark, sf_dir, "conversations"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": op1_ann,
    "op2_mixing": op2_mixing,
    "op3_chat": op3_chat,
    "op4_minhash": op4_minhash,
    "op5_lines": op5_lines,
    "op6_licenses": op6_licenses,
    "op7_pii": op7_pii,
    "op8_bpe": op8_bpe,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_packing": op11_packing,
    "op12_trie": op12_trie,
    "op13_merkle": op13_merkle,
}

ORACLE_SQL: dict[str, str] = {
    "op3_chat": oracle.OP3,
    "op4_minhash": oracle.OP4,
    "op5_lines": oracle.OP5,
    "op6_licenses": oracle.licence_sql(),
    "op10_quality": oracle.OP10,
    "op12_trie": trie_sql.trie_sql(),
    "op13_merkle": merkle_sql.manifest_sql(),
}
