"""The corpus pipeline: documents through five of the training-data operators.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns the columns of documents (the last one: token ids).  ``run``
writes every stage as Parquet to the shared folder and reads it again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetcraft.llm.byte_bpe import bpe_round_trip
from sheetcraft.llm.common import read_table, written
from sheetcraft.llm.lang_id import identify_documents
from sheetcraft.llm.mixing import mix_documents
from sheetcraft.llm.ngram_join import one_a_component
from sheetcraft.llm.queries import QUALITY_MIX
from sheetcraft.llm.substring_dedup import dedup_passages


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter stay, whether or not there is a language to
    learn; those without one, or without text, go."""
    found = identify_documents(docs, F.lit(True), lettered="__lettered")
    return found.where("__lettered").select(docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays, that of the smallest id;
    texts without a word are in no group and stay."""
    return one_a_component(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that repeat earlier ones."""
    columns = [F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return dedup_passages(docs).select(columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as its fitted rate calls for."""
    rows = mix_documents(docs, read_table(spark, sf_dir, "labels"), QUALITY_MIX)
    repeated = rows.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return repeated.select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document; decoding gives its text again."""
    coded = bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard", one_of_near_copies),
    ("substring_dedup", without_repeats),
    ("mixing", mixed),
    ("byte_bpe", token_ids),
]

# Trained models, signatures and merges cannot be written in SQL; tests hold
# the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
