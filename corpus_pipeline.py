"""The corpus pipeline: documents in, token ids out, one operator per stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rxstrata.llm import bpe, classifier, exact_dedup, mixing, ngram_join
from rxstrata.llm.queries import pattern, table, vocabulary
from rxstrata.session import stage as written

LEAST_QUALITY = 0.3
WORDS_REMEMBERED = 200_000  # worker processes still hold what earlier stages left there


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below the threshold go."""
    model = classifier.fit(docs, table(spark, sf_dir, "labels"))
    return classifier.keep_good(docs, model, LEAST_QUALITY)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts only the row with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the smallest doc_id stays."""
    return ngram_join.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.repeated(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and of what they decode to."""
    return bpe.round_trip(docs, vocabulary(), pattern(), remembered=WORDS_REMEMBERED)


STAGES = [
    ("quality_classifier", good_quality),
    ("exact_dedup", without_copies),
    ("ngram_jaccard_join", without_near_copies),
    ("mixing", mixed),
    ("byte_bpe", tokens),
]

#: The classifier is a trained model and has no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = written(step(spark, docs, sf_dir), name)
    return docs
