"""The corpus pipeline: quality classifier, near-duplicates, repeated passages,
benchmark contamination, tokens.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` writes each stage's rows as Parquet to the shared
checkpoint folder and reads them again as the next stage's documents, so a
stage works on what all earlier ones kept and a failure costs one stage.

Nulls: a row without an id passes every filter on its text alone where a stage
can judge it (see the operators) and is kept otherwise; null texts are empty.
An empty table gives empty stages.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, near_dup, quality_classifier, substring_dedup
from tidemark.llm.common import crc_mod, read
from tidemark.session import checkpoint_dir

#: No stage but the first could be checked in SQL, and that is a learnt model.
ORACLE_SQL = None

#: Least similarity of near-duplicates, in percent.
NEAR_PERCENT = 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality_classifier.drop_low_quality(docs, read(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 5) != 0)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, which a five-word Jaccard
    of 0.8 or more links."""
    return near_dup.drop_near_duplicates(docs, percent=NEAR_PERCENT)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the word sequences that occur elsewhere; n_chars follows."""
    return substring_dedup.apply_removal(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of any benchmark item to be contaminated."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256): the token ids, and
    what decoding them gives back."""
    ranks = bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    found = bpe.encode(docs, ranks, with_decoded=True)
    return found.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", keep_quality),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", decontaminated),
    ("byte_bpe", tokenised),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
