"""The corpus pipeline: documents in, encoded documents out.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before kept.
``run`` writes every stage's result to the shared folder and reads it again as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftide.llm import decontamination, line_runs, near_duplicates, piece_codec, toxicity
from shelftide.llm.common import stage, table


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the toxicity model rejects. It learns from these documents and labels."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs deleted; a document of which no word is left goes."""
    return _recounted(line_runs.delete_repeated_runs(docs, drop_emptied=True))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_duplicates.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that are mostly benchmark go."""
    return _recounted(decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, the ids of the text, and the text decoded from them."""
    return piece_codec.encode_column(docs, public_tokenizers.path("piece_bpe_32k.model"), decoded_col="decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("encoding", encode),
]

# Trained models and tokenizers have no counterpart in SQL; see tests/llm for the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), name)
    return docs
