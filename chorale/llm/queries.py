"""Registered queries of the operators, and their SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.llm import (
    exact_dedup, imatch, jaccard, mixing, periodic_runs, pii, quality, repeats, secrets, sentencepiece_bpe, token_alignment,
    token_attribution, token_files,
)
from chorale.llm.common import documents
from chorale.session import pin_session, use_scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: f(use_scratch(pin_session(spark)), sf_dir)
        if sql:
            SQL[name] = sql
        return f

    return register


@query("op1_token_files")
def _(spark, sf):
    return token_files.token_files(documents(spark, sf)).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op2_secrets")
def _(spark, sf):
    return secrets.digests(secrets.find_secrets(documents(spark, sf)))


@query("op3_jaccard")
def _(spark, sf):
    found = jaccard.near_duplicates(documents(spark, sf), shingle=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


@query("op4_repeats")
def _(spark, sf):
    return repeats.remove_repeats(documents(spark, sf)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op5_quality")
def _(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return quality.judge(documents(spark, sf), labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality_score")


@query("op6_exact_dedup", sql="""
    WITH t AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
        FROM documents)
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
    FROM t WINDOW same AS (PARTITION BY norm)""")
def _(spark, sf):
    found = exact_dedup.exact_duplicates(documents(spark, sf))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op7_token_counts")
def _(spark, sf):
    return token_attribution.token_counts(documents(spark, sf))


@query("op8_sentencepiece")
def _(spark, sf):
    return sentencepiece_bpe.digests(sentencepiece_bpe.encode(documents(spark, sf)))


@query("op9_personal_data")
def _(spark, sf):
    return pii.digests(pii.find_personal(documents(spark, sf)))


@query("op10_mixing")
def _(spark, sf):
    return mixing.mix(documents(spark, sf)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query("op11_periodic_runs")
def _(spark, sf):
    return periodic_runs.digests(periodic_runs.find_runs(periodic_runs.looped_documents(documents(spark, sf))))


@query("op12_token_alignment")
def _(spark, sf):
    return token_alignment.digests(token_alignment.align_documents(documents(spark, sf)))


@query("op13_imatch")
def _(spark, sf):
    return imatch.compare_next(documents(spark, sf))
