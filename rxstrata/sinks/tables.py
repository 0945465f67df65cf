"""Catalog tables and views over the stored layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rxstrata.schemas import DATE, LAYERS, Layer


def _columns(layer: Layer) -> str:
    fields = list(layer.schema.fields)
    if layer.partition not in layer.schema.names:
        fields.append(T.StructField(layer.partition, DATE))
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in fields
    )


def create_table(spark: SparkSession, name: str, layer: Layer, path: str) -> None:
    """An external Parquet table over a layer's folder, partitioned by its date."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({_columns(layer)}) USING parquet "
        f"PARTITIONED BY ({layer.partition}) LOCATION '{path}'"
    )


def create_tables(spark: SparkSession, database: str, root: str) -> list[str]:
    """All layers as tables of ``database``, each in its folder below ``root``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/{database}.db'")
    names = []
    for layer in LAYERS.values():
        names.append(f"{database}.{layer.name}")
        create_table(spark, names[-1], layer, f"{root}/{layer.name}")
    return names


def refresh_partitions(spark: SparkSession, name: str) -> None:
    """Make dates written since the last refresh visible through the table."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def create_views(views: Mapping[str, DataFrame]) -> None:
    """Temporary views for SQL users."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
