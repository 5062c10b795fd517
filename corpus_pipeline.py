"""From raw documents to training tokens, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; between stages the rows are written as Parquet and read again.  The tables
between stages are removed when the next one has been written.

Defined cases, in every stage: an empty table gives an empty table; columns
besides ``doc_id``, ``text`` and ``source`` stay as they are, whatever their
names (but for ``n_chars``, which follows the text); very long texts are taken
whole; rows with one id are rows of their own.  What null cells, ties and
repeated rows do is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblion.llm import bpe, lines, minhash, mixing, quality
from biblion.llm.base import cut, dropped, table
from biblion.llm.queries import vocabulary_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good.

    Null and empty texts share one score, that of no text; a score of just 0.5
    is good; equal texts share their fate; ids, null ones too, play no part in
    a score.
    """
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels"), ~quality.held_out(F.col("doc_id"))))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go; n_chars follows the text.

    A null text stays null, an empty one empty; rows without an id are kept
    whole; the first place (smallest id, then line) of a chunk stays, and at
    one place of one id it stays in every row.
    """
    return lines.deduplicated(docs, with_text=True).withColumn("n_chars", F.length("text").cast("long"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies (five words, similarity 0.8) stays, the one of the smallest id.

    Rows without an id, a text or words are copies of nothing and stay; of rows
    with one id all stay or all go.
    """
    return minhash.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it.

    A null source is a source of its own; documents without words are taken as
    often as the whole part of their source's rate says; equal rows are sampled
    each.
    """
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of each document: their number and digests; a null text counts as empty, repeated rows are encoded each."""
    return bpe.digests(docs.select("doc_id", "source", "text"), vocabulary_path())


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: A trained classifier and a sampling stage have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
            dropped(before)
    return docs
