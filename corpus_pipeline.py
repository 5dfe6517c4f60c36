"""From documents to token ids: language, exact and near duplicates, mix of sources, encoding.

Each stage is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleflow.llm.bpe import round_trip
from sampleflow.llm.exact import exact_dedup
from sampleflow.llm.graph import kept
from sampleflow.llm.language import known_language, train_network
from sampleflow.llm.mixing import repeated
from sampleflow.llm.ngram_join import near_dedup

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not recognised go; learned from those that have one."""
    return known_language(docs, train_network(docs, other=True))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the last document stays."""
    return exact_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by five-word shingles at a similarity of 0.8 or more the first document stays."""
    return near_dedup(docs, size=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by their target weights, at most three times each document."""
    return repeated(docs, weights=(1, 2, 3), max_epochs=3, seed=7)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the mix, and whether they decode to the same digest of its text."""
    return round_trip(docs, RANKS, public_tokenizers.PATTERN).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("ngram_jaccard_join", near_duplicates),
    ("source_mixing", source_mix),
    ("byte_bpe", byte_bpe),
]

#: The first and the last stage cannot be said in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name)
    return docs
