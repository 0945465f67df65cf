"""Mixing sources to target weights by repetition rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxstrata.llm.text import n_words
from rxstrata.session import stage

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CEILING = 2.0
SEED = "mix-1"
DRAWS = 2**52


def draw(id_col: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the seed, the id and a digest of the text; nulls count as
    empty. Rows without ids, or of one id, draw on their own as far as their texts differ."""
    digest = F.md5(
        F.concat(
            F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"),
            F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")),
        ).cast("binary")
    )
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(DRAWS))


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    ceiling: float = CEILING,
) -> DataFrame:
    """source, source_size, target of each source.

    Sources in code point order, null last, take the weights in turn and share
    ``budget`` times all sizes. A target stops at ``ceiling`` times its source's size
    and what is cut goes to the others by weight, until none is above. In closed form:
    by rising size per weight, sources are capped as long as the share per weight that
    is left for the rest exceeds their cap. The windows hold one row per source, after
    the sizes were summed.
    """
    if budget > ceiling:
        raise ValueError("the budget cannot exceed the ceiling")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1)
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    return (
        totals.withColumn("weight", weight)
        .withColumn("goal", F.sum("source_size").over(everything) * F.lit(float(budget)))
        .withColumn("used", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(float(ceiling)))
        .withColumn("open", F.sum("weight").over(onward))
        .withColumn("share", (F.col("goal") - F.col("used")) / F.col("open"))
        .withColumn("capped", F.col("share") * F.col("weight") > F.col("source_size") * F.lit(float(ceiling)))
        .withColumn("level", F.min(F.when(~F.col("capped"), F.struct(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source", "share"))).over(everything)["share"])
        .select(
            "source",
            "source_size",
            F.when(F.col("capped"), F.col("source_size") * F.lit(float(ceiling)))
            .otherwise(F.col("level") * F.col("weight"))
            .alias("target"),
        )
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    ceiling: float = CEILING,
    seed: str = SEED,
    size: Column | None = None,
) -> DataFrame:
    """``docs`` in ``_doc`` with its ``size``, its source's figures, and ``copies``.

    A source's rate is its target over its size. Each document gets floor(rate)
    copies and one more when its draw falls below the fraction, so a document never
    exceeds ceil(ceiling) copies and reruns agree. ``size`` defaults to the words of
    the text (null: 0). Rows equal in id and text draw alike, so a source that is mostly
    one repeated row can miss its target; ids may else be null or repeated. A null source
    is a source; sources without words get target 0 and no copies. An empty table gives
    no rows.
    """
    size = n_words(F.col(text_col)) if size is None else size
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.col(source_col).alias("_source"),
        draw(F.col(id_col), F.col(text_col), seed).alias("_draw"),
        size.alias("size"),
    )
    targets = source_targets(
        docs.select(F.col(source_col).alias("source"), size.alias("size")), weights, budget, ceiling
    )
    # written, so that Catalyst knows its size and broadcasts it only while it is small
    targets = stage(targets, "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        sized.join(targets, sized["_source"].eqNullSafe(targets["source"]))
        .withColumn("_rate", rate)
        .withColumn("_whole", F.floor("_rate"))
        .withColumn(
            "copies",
            F.col("_whole")
            + (F.col("_draw") < F.col("_rate") - F.col("_whole")).cast("long"),
        )
        .drop("_source", "_draw", "_rate", "_whole")
    )


def repeated(docs: DataFrame, **options) -> DataFrame:
    """Every document as often as the mix takes it, with the columns of ``docs``."""
    mixed = mix(docs, **options).filter("copies > 0")
    return mixed.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        *[F.col("_doc").getField(c).alias(c) for c in docs.columns]
    )
