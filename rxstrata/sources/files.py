"""Reading files and stored layers."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxstrata import schemas
from rxstrata.functions.columns import as_date, on_day, start_of
from rxstrata.session import file_system


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line and a fixed schema; nothing is inferred."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_bronze(spark: SparkSession, path: str, ingested_at: Column, version: str) -> DataFrame:
    """Bronze CSV plus its lineage columns."""
    items = spark.read.schema(schemas.BRONZE_FILE).option("header", True).csv(path)
    return items.select(
        "*",
        F.unix_millis(ingested_at).alias("ingestion_timestamp"),
        F.col("_metadata.file_name").alias("source_file"),
        F.lit(version).alias("data_version"),
    )


def read_layer(
    spark: SparkSession, path: str, layer: schemas.Layer, day: str | dt.date | Column | None = None
) -> DataFrame:
    """A stored layer; ``day`` prunes to one date partition."""
    stored = list(layer.schema.fields)
    if layer.partition not in layer.schema.names:
        stored.append(T.StructField(layer.partition, schemas.DATE))
    names = [field.name for field in stored]
    df = spark.read.schema(T.StructType(stored)).parquet(path).select(*names)
    return df if day is None else df.where(F.col(layer.partition) == as_date(day))


def read_evolving(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet parts whose later files may have more columns than the first."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def union_evolving(*parts: DataFrame) -> DataFrame:
    """Union by name; a column a part lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def rows_on(df: DataFrame, layer: schemas.Layer, day: str | dt.date | Column) -> DataFrame:
    """Rows of one date: by the date partition where ``df`` has it, else by timestamp."""
    if layer.partition in df.columns:
        return df.where(F.col(layer.partition) == as_date(day))
    return df.where(on_day(layer.dated_by, day))


def rows_since(df: DataFrame, layer: schemas.Layer, day: str | dt.date | Column) -> DataFrame:
    """Rows from one date on, by the date partition where ``df`` has it."""
    if layer.partition in df.columns:
        return df.where(F.col(layer.partition) >= as_date(day))
    return df.where(F.col(layer.dated_by) >= start_of(day))


def stored_days(spark: SparkSession, path: str, layer: schemas.Layer) -> list[dt.date]:
    """The dates a layer has, from the names of its folders: no file is opened."""
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(at))
    prefix = f"{layer.partition}="
    return sorted(
        dt.date.fromisoformat(n.removeprefix(prefix))
        for n in names
        if n.startswith(prefix) and not n.endswith("__HIVE_DEFAULT_PARTITION__")
    )


def read_latest(
    spark: SparkSession, path: str, layer: schemas.Layer, as_of: str | dt.date | None = None
) -> DataFrame:
    """The newest date of a stored layer, not after ``as_of``; without any, no rows."""
    limit = dt.date.max if as_of is None else dt.date.fromisoformat(str(as_of))
    days = [day for day in stored_days(spark, path, layer) if day <= limit]
    return read_layer(spark, path, layer, days[-1]) if days else read_layer(spark, path, layer).where("false")


def latest_snapshot(
    df: DataFrame, layer: schemas.Layer, as_of: str | dt.date | Column | None = None
) -> DataFrame:
    """Rows of the last date, not after ``as_of``, found by a scalar subquery.

    For tables of any origin; ``read_latest`` finds the date of a stored layer without
    opening its files. On a stored layer the subquery's result prunes the scan.
    """
    stored = layer.partition in df.columns
    day = F.col(layer.partition) if stored else F.to_date(layer.dated_by)
    if as_of is not None:
        df = df.where(day <= as_date(as_of))
    newest = df.select(F.max(day).alias("day")).scalar()
    return df.where(day == newest)


def literal_rows(spark: SparkSession, values: tuple[str, ...], name: str) -> DataFrame:
    """An array literal as a table."""
    return spark.range(1).select(F.explode(F.array(*map(F.lit, values))).alias(name))


def literal_grid(spark: SparkSession, **dimensions: tuple[str, ...]) -> DataFrame:
    """Every combination of constant lists, unnested one after the other."""
    grid = spark.range(1).select()
    for name, values in dimensions.items():
        grid = grid.select("*", F.explode(F.array(*map(F.lit, values))).alias(name))
    return grid
