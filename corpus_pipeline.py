"""From raw documents to token ids: quality rules, exact copies, near copies, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chorale.llm import exact_dedup, jaccard, mixing, quality, sentencepiece_bpe
from chorale.llm.common import documents
from chorale.session import materialise, pin_session, use_scratch


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trees."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z read as a-z) the document with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by like sets of five-word shingles (80 % or more) the one with the least id."""
    return jaccard.drop_near_duplicates(docs, shingle=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take_mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the decoded text, as counts and digests."""
    return sentencepiece_bpe.digests(sentencepiece_bpe.encode(docs))


STAGES = [
    ("quality_rules", keep_good),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: No SQL states the trees, the fit of the mix or the encoder; tests/llm compares the run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; every stage is written and read again."""
    docs = documents(use_scratch(pin_session(spark)), sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
