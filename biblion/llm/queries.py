"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblion.llm import bpe, chat, forest, lines, minhash, mixing, neighbours, pseudonyms, quality, substring
from biblion.llm.base import table


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(docs, vocabulary_path())


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(table(spark, sf_dir, "conversations"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~quality.held_out(F.col("doc_id")))
    return quality.score(docs, model).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.searched(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.grouped(table(spark, sf_dir, "documents"), words=2, percent=80)


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymised(docs, key="a key for tests", count="n_replaced")


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicated(table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.grouped(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_bpe_encode_decode": op1_bpe_encode_decode,
    "op2_chat_format": op2_chat_format,
    "op3_quality": op3_quality,
    "op4_line_dedup": op4_line_dedup,
    "op5_nearest": op5_nearest,
    "op6_minhash": op6_minhash,
    "op7_pseudonyms": op7_pseudonyms,
    "op8_mix": op8_mix,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_embedding_dedup": op10_embedding_dedup,
}
ORACLE_SQL: dict[str, str] = {
    "op2_chat_format": chat.ORACLE,
    "op4_line_dedup": lines.ORACLE,
}
