"""Queries of the training-data operators over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetcraft.llm.byte_bpe import bpe_round_trip, digests
from sheetcraft.llm.common import read_table
from sheetcraft.llm.embed_dedup import embedding_components
from sheetcraft.llm.html_extract import extract_main_text
from sheetcraft.llm.lang_id import held_out, identify_languages
from sheetcraft.llm.lexical_search import lexical_search
from sheetcraft.llm.mixing import mix_documents
from sheetcraft.llm.ngram_join import jaccard_components
from sheetcraft.llm.packing import pack_documents
from sheetcraft.llm.prefix_trie import prefix_trie
from sheetcraft.llm.quality import quality_model, quality_rules
from sheetcraft.llm.substring_dedup import repeated_spans
from sheetcraft.llm.token_ids import shard_digest, write_token_shards
from sheetcraft.llm.url_filters import filter_urls
from sheetcraft.llm.sql import OP3_SQL, OP9_SQL, OP11_SQL, OP13_SQL
from sheetcraft.session import scratch_dir

# Token share of each quality label in the mix.
QUALITY_MIX = {"1": 0.97, "0": 0.03}

# The url rules, verdict and host with path.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = identify_languages(docs, ~held_out())
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that repeat passages of earlier ones, which, and what to remove."""
    docs = read_table(spark, sf_dir, "documents")
    words = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["to_word"] - x["from_word"])
    return repeated_spans(docs).select(F.col("id").alias("doc_id"), "repeats_of", "removed", words.alias("n_removed_words"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-shards") + "/ids"
    model = public_tokenizers.path("word_bpe_49k.json")
    files = write_token_shards(read_table(spark, sf_dir, "documents"), folder, model, end_id=1)
    return shard_digest(spark, folder, files)


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read_table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_rules(docs, quality_model(docs, read_table(spark, sf_dir, "labels")))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    mixed = mix_documents(docs, read_table(spark, sf_dir, "labels"), QUALITY_MIX, carry=["doc_id"])
    return mixed.select("doc_id", "domain", "n_tokens", "rate", "copies")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return digests(bpe_round_trip(read_table(spark, sf_dir, "documents"), ranks))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(read_table(spark, sf_dir, "embeddings"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels: a page whose id is labelled as of low quality or toxic is bad."""
    labels = read_table(spark, sf_dir, "labels")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = labels.select(F.col("doc_id").alias("page_id"), bad.alias("blocked"))
    return filter_urls(read_table(spark, sf_dir, "pages"), known, URL_RULES)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv")
    shared = F.crc32(conv.cast("string")) % 4
    return prefix_trie(read_table(spark, sf_dir, "conversations"), shared, conv - conv % 20)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_token_ids": op4_token_ids,
    "op5_html_extract": op5_html_extract,
    "op6_quality_rules": op6_quality_rules,
    "op7_mixing": op7_mixing,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_url_filters": op10_url_filters,
    "op11_lexical_search": op11_lexical_search,
    "op12_packing": op12_packing,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op3_ngram_jaccard": OP3_SQL,
    "op9_embedding_dedup": OP9_SQL,
    "op11_lexical_search": OP11_SQL,
    "op13_prefix_trie": OP13_SQL,
}
