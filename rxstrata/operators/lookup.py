"""Left joins with mapping tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def constant_table(spark: SparkSession, table: Mapping[str, str], key: str, value: str) -> DataFrame:
    """A two-column table from a constant mapping.

    A VALUES clause has a known size, so Catalyst broadcasts it without a hint.
    """
    quoted = [tuple(part.replace("'", "''") for part in item) for item in table.items()]
    rows = ", ".join(f"('{k}', '{v}')" for k, v in quoted)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({key}, {value})")


def one_per_key(table: DataFrame, key: str, *values: Column) -> DataFrame:
    """A mapping table with each key once; ``values`` are its aggregates."""
    return table.groupBy(key).agg(*values)


def attach(
    df: DataFrame,
    table: DataFrame,
    on: str,
    key: str,
    value: str,
    alias: str,
    keep_unmatched: bool = True,
    unique: bool = False,
) -> DataFrame:
    """Left join ``table`` on ``df[on] = table[key]`` and add its ``value`` as ``alias``.

    An unmatched row keeps its own ``on`` value, or gets NULL. Of a key that the table
    holds twice the smallest value counts, so no row is multiplied;
    ``unique`` says that keys cannot repeat, as in a constant mapping. Whether it is broadcast is left to its known size, so a mapping
    that outgrows the limit is merged by sort with skew splitting instead.
    """
    once = table if unique else one_per_key(table, key, F.min(value).alias(value))
    renamed = once.select(F.col(key).alias("__key"), F.col(value).alias("__value"))
    joined = df.join(renamed, F.col(on) == F.col("__key"), "left")
    found = F.coalesce("__value", F.col(on)) if keep_unmatched else F.col("__value")
    return joined.withColumn(alias, found).drop("__key", "__value")
