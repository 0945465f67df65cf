"""The k best rows of each group as one array."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_arrays(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, item: Column, alias: str
) -> DataFrame:
    """One row per group with ``item`` of its first ``k`` rows by ``order``.

    The row-number filter lets Spark keep only ``k`` rows per group in each task
    before the shuffle, so a hot group never arrives whole anywhere.
    """
    ranked = df.select(
        *by, item.alias("__item"), F.row_number().over(Window.partitionBy(*by).orderBy(*order)).alias("__rank")
    ).where(F.col("__rank") <= k)
    ordered = F.sort_array(F.collect_list(F.struct("__rank", "__item")))
    return ranked.groupBy(*by).agg(F.transform(ordered, lambda e: e["__item"]).alias(alias))


def join_groups(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join two tables of one row per group, matching NULL groups too."""
    renamed = right.select(*[F.col(c).alias(f"__{c}" if c in by else c) for c in right.columns])
    condition = None
    for c in by:
        same = F.col(c).eqNullSafe(F.col(f"__{c}"))
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, "left").drop(*[f"__{c}" for c in by])
