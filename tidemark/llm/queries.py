"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, lm_score, near_dup, prefix_trie, quality_classifier, quality_rules, sharding, substring_dedup, token_align, token_counts, toxicity, url_filter
from .common import crc_mod, read
from .oracle import LLM_ORACLE_SQL

#: The rules of the url query: host, path, action.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


#: Shards of the sharding query.
SHARDS = 24


def _hex(column) -> Column:
    return F.sha2(column, 256)


def _held_out(mod: int, rest: int) -> Column:
    """Whether a row is held out; a row without an id is not."""
    return F.coalesce(crc_mod(F.col("doc_id"), mod) == rest, F.lit(False)).alias("held_out")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text, and what decoding them gives back."""
    ranks = bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    found = bpe.encode(read(spark, sf_dir, "documents"), ranks, with_decoded=True)
    return found.select("doc_id", "n_tokens", _hex("ids").alias("ids_sha256"), _hex("decoded").alias("decoded_sha256"))


def op2_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets agree to 85 % or more."""
    return near_dup.near_duplicates(read(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in windows of benchmark items."""
    found = decontaminate.find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        _hex(F.array_join("items", ",")).alias("items_sha256"), "contaminated")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens and greedy word pieces of every text."""
    ranks = bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), ranks.rank)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document keeps when repeated windows of 35 words go."""
    found = substring_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", _hex("kept_text").alias("kept_sha256"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backoff-model and base scores; learnt from documents that are not held out."""
    found = lm_score.score_texts(read(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 5) != 1)
    return found.select("doc_id", _held_out(5, 1), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores; learnt from the labels of two thirds of the ids."""
    found = toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 3) != 1)
    return found.select("doc_id", _held_out(3, 1), "score", "predicted")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, rules and the host's verdict for every document."""
    return quality_rules.judge_documents(read(spark, sf_dir, "documents")).drop("host_rate")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores; learnt from the positive labels of four fifths of the ids."""
    found = quality_classifier.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 5) != 0)
    return found.select("doc_id", _held_out(5, 0), "score", "predicted")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.judge_urls(read(spark, sf_dir, "pages"), rules)


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens, with corpus-wide pair counts."""
    first, second = (token_align.read_file(spark, public_tokenizers.path(x)) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_align.align_tokens(read(spark, sf_dir, "documents"), first, second)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document among 24, and its shard among 25."""
    found = sharding.assign_shards(read(spark, sf_dir, "documents"), SHARDS, grown_weight=1.0)
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of rebuilt conversations."""
    turns = prefix_trie.turn_digests(read(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_heads(turns, every=20, most=3))


LLM_QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_minhash_near_dup": op2_minhash_near_dup,
    "op3_decontamination": op3_decontamination,
    "op4_token_counts": op4_token_counts,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_toxicity_lexicon": op7_toxicity_lexicon,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_url_filter": op10_url_filter,
    "op11_token_align": op11_token_align,
    "op12_sharding": op12_sharding,
    "op13_prefix_trie": op13_prefix_trie,
}

__all__ = ["LLM_ORACLE_SQL", "LLM_QUERIES"]
