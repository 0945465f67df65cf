"""Exact ranks and quantiles over groups of any size.

A window over ``partitionBy(category)`` sends a whole category to one task, and
an exact percentile aggregate keeps every distinct value of a group in one
buffer. Both stop working when one category holds a third of 100 TB. Here the
rows are first counted per distinct value (partial aggregation does most of
that before the shuffle), the counts are range-partitioned into even slices
that may split a group anywhere, and positions are running sums within a slice
plus the totals of the slices before it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxstrata.session import stage


@dataclass(frozen=True)
class Measure:
    """A column whose distribution is wanted, within the groups of ``by``."""

    name: str
    value: str
    by: tuple[str, ...] = ()
    keep_nulls: bool = True


@dataclass(frozen=True)
class Distribution:
    """Counts per distinct value in even, ordered slices, and what precedes each slice.

    ``counts``: ``measure``, group columns, ``value``, ``n`` and ``slice``.
    ``slices``: per measure, group and slice its ``rows`` and ``values``, those of the
    group before it (``rows_offset``, ``values_offset``) and in all (``rows_total``,
    ``values_total``). NULL is the lowest value.
    """

    groups: tuple[str, ...]
    counts: DataFrame
    slices: DataFrame

    def _placed(self, slices: DataFrame) -> DataFrame:
        """Counts of the given slices with the rows and values before each."""
        scope = ("measure", *self.groups, "slice")
        sides = slices.select(
            *[F.col(c).alias(f"_{c}") for c in scope],
            *[c for c in slices.columns if c not in scope],
        )
        same = F.col("slice") == F.col("_slice")
        for c in ("measure", *self.groups):
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        within = Window.partitionBy(*scope).orderBy("value")
        before = within.rowsBetween(Window.unboundedPreceding, -1)
        rows_in_slice = F.coalesce(F.sum("n").over(before), F.lit(0))
        values_in_slice = F.row_number().over(within) - 1
        return (
            self.counts.join(sides, same)
            .withColumn("rows_before", F.col("rows_offset") + rows_in_slice)
            .withColumn("values_before", F.col("values_offset") + values_in_slice)
        )

    def _of(self, df: DataFrame, *measures: Measure) -> DataFrame:
        return df.where(F.col("measure").isin(*[m.name for m in measures]))

    def positions(self, *measures: Measure) -> DataFrame:
        """One row per distinct value: ``rows_before`` and ``values_before`` it in its
        group, ``rows_total`` and ``values_total`` of the group.

        Written once, so that a join with it knows its size.
        """
        placed = self._placed(self._of(self.slices, *measures))
        return stage(
            placed.select(
                "measure", *self.groups, "value", "n",
                "rows_before", "values_before", "rows_total", "values_total",
            ),
            "positions",
        )

    def values_at(self, measure: Measure, **rows: Column) -> DataFrame:
        """Per group, the value of the row at each 1-based position.

        A position may use ``rows_total``. Only slices that hold one are looked into.
        """
        ends = F.col("rows_offset") + F.col("rows")
        wanted = None
        for row in rows.values():
            here = (F.col("rows_offset") < row) & (row <= ends)
            wanted = here if wanted is None else wanted | here
        placed = self._placed(self._of(self.slices, measure).where(wanted))
        first, last = F.col("rows_before"), F.col("rows_before") + F.col("n")
        picks = [
            F.max(F.when((first < row) & (row <= last), F.col("value"))).alias(name)
            for name, row in rows.items()
        ]
        return placed.groupBy(*measure.by).agg(*picks)

    def quantiles(self, measure: Measure, **at: float) -> DataFrame:
        """Per group: the least value that a share ``at`` of the rows does not exceed."""
        return self.values_at(
            measure, **{name: F.ceil(F.col("rows_total") * F.lit(p)) for name, p in at.items()}
        )

    def medians(self, measure: Measure, alias: str) -> DataFrame:
        """Per group: the middle value, or the mean of the two middle values."""
        half = F.floor(F.col("rows_total") / 2)
        middle = self.values_at(
            measure, lower=F.floor((F.col("rows_total") + 1) / 2), upper=half + 1
        )
        return middle.select(*measure.by, ((F.col("lower") + F.col("upper")) / 2).alias(alias))


def distribution(df: DataFrame, *measures: Measure) -> Distribution:
    """The distributions of all ``measures``, in one pass over ``df``."""
    groups = tuple(dict.fromkeys(column for m in measures for column in m.by))
    types = {name: df.schema[name].dataType for name in groups}

    def entry(m: Measure) -> Column:
        keys = [
            (F.col(g) if g in m.by else F.lit(None).cast(types[g])).alias(g) for g in groups
        ]
        value = F.col(m.value).cast("double").alias("value")
        return F.struct(F.lit(m.name).alias("measure"), *keys, value)

    entries = df.select(F.explode(F.array(*map(entry, measures))).alias("e")).select("e.*")
    without_nulls = [m.name for m in measures if not m.keep_nulls]
    if without_nulls:
        entries = entries.where(
            F.col("value").isNotNull() | ~F.col("measure").isin(*without_nulls)
        )

    scope = ("measure", *groups)
    counts = entries.groupBy(*scope, "value").agg(F.count(F.lit(1)).alias("n"))
    sliced = stage(
        counts.repartitionByRange(*scope, "value").withColumn("slice", F.spark_partition_id()),
        "counts",
    )
    group = Window.partitionBy(*scope)
    earlier = group.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        sliced.groupBy(*scope, "slice")
        .agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values"))
        .select(
            "*",
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_offset"),
            F.coalesce(F.sum("values").over(earlier), F.lit(0)).alias("values_offset"),
            F.sum("rows").over(group).alias("rows_total"),
            F.sum("values").over(group).alias("values_total"),
        )
    )
    return Distribution(groups, sliced, stage(slices, "slices"))


def exact_quantiles(df: DataFrame, value: str, accuracy: int = 1000, **at: float) -> DataFrame:
    """One row: the least value that a share of the rows does not exceed, per share.

    The same as ``quantiles`` of a single group, without counting every value: a sketch
    brackets each quantile, one aggregate counts the rows below each bracket, and only
    rows inside (a few in ``accuracy``) are counted per value. The sketch's rank is off
    by at most ``1 / accuracy``, so brackets of twice that hold the quantile for sure.
    NULLs are left out; without values every quantile is NULL. ``df`` is read three
    times, one column of it, so pass a written table.
    """
    values = df.select(F.col(value).cast("double").alias("value")).where("value IS NOT NULL")
    slack = 2 / accuracy
    edges = [min(max(q + d, 0.0), 1.0) for q in at.values() for d in (-slack, slack)]
    found = values.agg(
        F.count(F.lit(1)), F.percentile_approx("value", F.array(*map(F.lit, edges)), accuracy)
    ).first()
    rows, bounds = found[0], found[1] or []
    if not rows:
        return df.sparkSession.range(1).select(*[F.lit(None).cast("double").alias(n) for n in at])
    brackets = dict(zip(at, zip(bounds[::2], bounds[1::2], strict=True), strict=True))
    below = values.agg(*[F.count_if(F.col("value") < low) for low, _ in brackets.values()]).first()
    inside = F.array_compact(
        F.array(*[F.when(F.col("value").between(low, high), F.lit(n)) for n, (low, high) in brackets.items()])
    )
    near = values.select("value", F.explode(inside).alias("bracket"))
    measure = Measure("quantile", "value", by=("bracket",), keep_nulls=False)
    place = {n: math.ceil(rows * q) - before for (n, q), before in zip(at.items(), below, strict=True)}
    wanted = F.create_map(*[F.lit(x) for item in place.items() for x in item])[F.col("bracket")]
    picked = distribution(near, measure).values_at(measure, found=wanted)
    return picked.agg(*[F.max(F.when(F.col("bracket") == n, F.col("found"))).alias(n) for n in at])


def percent_rank() -> Column:
    """``PERCENT_RANK() OVER (PARTITION BY group ORDER BY value NULLS FIRST)``."""
    others = F.col("rows_total") - 1
    return F.when(others > 0, F.col("rows_before") / others).otherwise(0.0)


def dense_rank_descending() -> Column:
    """``DENSE_RANK() OVER (PARTITION BY group ORDER BY value DESC NULLS LAST)``."""
    return F.col("values_total") - F.col("values_before")


def attach_position(
    df: DataFrame, positions: DataFrame, measure: Measure, position: Column, alias: str
) -> DataFrame:
    """Add ``position`` of each row's value to the rows.

    The positions are a written table of distinct values: Catalyst sees their size
    and broadcasts them where they are few, else it merges by sort and splits a
    skewed value.
    """
    table = positions.where(F.col("measure") == measure.name).select(
        *[F.col(g).alias(f"__{g}") for g in measure.by],
        F.col("value").alias("__value"),
        position.alias(alias),
    )
    condition = F.col(measure.value).eqNullSafe(F.col("__value"))
    for g in measure.by:
        condition = condition & F.col(g).eqNullSafe(F.col(f"__{g}"))
    joined = df.join(table, condition, "left")
    return joined.drop("__value", *[f"__{g}" for g in measure.by])
