"""Exact duplicates by a tree merge of sorted digest runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxstrata.llm.text import lower_ascii, whole
from rxstrata.session import stage

FAN_IN = 8


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: its run (the partition that read it), a row number,
    the digest of the normalised text and a second, independent check of it."""
    text = lower_ascii(whole(F.col(text_col)))
    return docs.select(
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.struct(
            F.octet_length(text).alias("n_bytes"), F.xxhash64(text).alias("hash")
        ).alias("check"),
    )


def merge_runs(rows: DataFrame, keep: str = "largest", fan_in: int = FAN_IN):
    """(first runs, merged root) of the digest rows.

    Level 0 folds each run by digest; every further round sends ``fan_in`` runs to
    the one that carries their common number and merges them in digest order, so
    equal digests meet level by level and a large group has at most ``fan_in`` rows
    per digest in any merge. Digests of a run stay spread over all tasks. ``check``
    is part of the key: equal digests of different texts would never be merged.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is largest or smallest")
    best = F.max if keep == "largest" else F.min
    leaves = rows.groupBy("run", "digest", "check").agg(
        best(F.struct("id", "row")).alias("best"), F.count("*").alias("n")
    )
    runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    level = leaves
    while runs > 1:
        runs = -(-runs // fan_in)
        level = (
            level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
            .groupBy("run", "digest", "check")
            .agg(best("best").alias("best"), F.sum("n").alias("n"))
        )
    return leaves, level.drop("run")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Each document with the one that stays for its text.

    Texts are equal when they are identical after lower-casing A-Z; null counts as
    the empty text. Returns one row per input row: doc_id, keep_id, group_size, kept,
    text_sha256. Rows without an id lose to rows that have one (``smallest``: win, as
    null sorts first); of repeated rows with the same id and text exactly one is
    kept. An empty table gives no rows; other columns of ``docs`` are not read.
    """
    rows = stage(digest_rows(docs, id_col, text_col), "digests")
    leaves, root = merge_runs(rows, keep, fan_in)
    root = root.select("digest", "check", F.col("best").alias("winner"), F.col("n").alias("size"))
    # the answer goes down the same tree: a group has one row per run here, and a
    # run's rows of a group stay within that run's size
    answers = leaves.select("run", "digest", "check").join(root, ["digest", "check"])
    return rows.join(answers, ["run", "digest", "check"]).select(
        F.col("id").alias("doc_id"),
        F.col("winner.id").alias("keep_id"),
        F.col("size").cast("long").alias("group_size"),
        (F.col("row") == F.col("winner.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    fan_in: int = FAN_IN,
) -> DataFrame:
    """The documents that stay, with all their columns.

    Winners are found on digests; documents then meet their own group's winner by
    (digest, id), so no group gathers anywhere. Of repeated rows with equal id and
    text the one with the smallest hash of all columns stays.
    """
    rows = stage(digest_rows(docs, id_col, text_col), "digests")
    _, root = merge_runs(rows, keep, fan_in)
    winners = root.select(
        F.col("digest").alias("_digest"), F.col("best.id").alias("_winner")
    )
    text = lower_ascii(whole(F.col(text_col)))
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.unhex(F.sha2(text, 256)).alias("_digest"),
        F.col(id_col).cast("long").alias("_winner"),
    )
    joined = marked.join(
        winners.withColumnRenamed("_digest", "_d").withColumnRenamed("_winner", "_w"),
        (F.col("_digest") == F.col("_d")) & F.col("_winner").eqNullSafe(F.col("_w")),
        "left_semi",
    )
    return _first_of_repeated(joined).select(
        *[F.col("_doc").getField(c).alias(c) for c in docs.columns]
    )


def _first_of_repeated(marked: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    same = Window.partitionBy("_digest", "_winner").orderBy(F.xxhash64("_doc"))
    return marked.withColumn("_nth", F.row_number().over(same)).filter("_nth = 1")
