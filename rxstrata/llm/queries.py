"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxstrata.llm import (
    bpe,
    classifier,
    exact_dedup,
    filter_audit,
    license_scan,
    mixing,
    ngram_join,
    quality_rules,
    source_audit,
    token_counts,
    token_files,
    topk_search,
    warc,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Path of a public tokenizer's file, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join_components(table(spark, folder, "documents")).drop("node")


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), vocabulary(), pattern())


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents")).drop("matches")


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document before and after its repeated lines are deleted."""
    return token_counts.count_edited(
        table(spark, folder, "documents"), vocabulary(), pattern(), edits=token_counts.cleaning_edits
    )


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_rules.judged(quality_rules.ledger(table(spark, folder, "documents")))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed",
    )


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return token_files.written_and_read(docs, vocabulary("byte_bpe_50k.json"))


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = classifier.fit(docs, table(spark, folder, "labels"))
    scored = classifier.with_scores(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        classifier.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.read(warc.archive(table(spark, folder, "pages")))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select(
        F.col("_doc.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def op11_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    return source_audit.audit(table(spark, folder, "documents"))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return filter_audit.audit(filter_audit.failure_counts(docs, labels))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_join,
        op2_bpe,
        op3_exact_dedup,
        op4_license_scan,
        op5_token_counts,
        op6_quality_rules,
        op7_token_files,
        op8_quality_classifier,
        op9_warc,
        op10_mixing,
        op11_topk_search,
        op12_source_audit,
        op13_filter_audit,
    )
}
