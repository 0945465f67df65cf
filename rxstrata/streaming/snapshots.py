"""Batch distributions for records that stream in: tiers by the snapshot of their date.

The batch knows the quartiles of all prices, a stream does not. Each batch run saves its
quartiles as a snapshot that is valid from a date on; a streamed record is tiered by the
newest snapshot that was valid on its own date, so it gets the tier that the batch would
have given it. Snapshots are read anew for every micro-batch. Which ones a micro-batch
has seen is written before its rows, and read again if it must be repeated: a snapshot
that came in between does not change rows that have been written once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxstrata import fixed_values as V
from rxstrata.functions.columns import banded
from rxstrata.operators.enrichment import price_quartiles
from rxstrata.session import file_system
from rxstrata.sinks.layers import swap
from rxstrata.streaming.accounting import batches

QUARTILES = "p25 double, p50 double, p75 double"
KINDS = ("date", "double", "double", "double")
SNAPSHOT = f"valid_from date, {QUARTILES}"


def save_snapshot(batch: DataFrame, path: str, valid_from: str | dt.date) -> None:
    """The price quartiles of a batch, valid from a date on; replaces that date's."""
    day = dt.date.fromisoformat(str(valid_from))
    fresh = f"{path}/_new-{day}"
    price_quartiles(batch).coalesce(1).write.mode("overwrite").parquet(fresh)
    swap(batch.sparkSession, fresh, f"{path}/valid_from={day}")


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    """The saved snapshots; without any, no rows."""
    fs, at = file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    if not any(n.startswith("valid_from=") for n in names):
        return spark.createDataFrame([], SNAPSHOT)
    schema = T.StructType.fromDDL(f"{QUARTILES}, valid_from date")
    return spark.read.schema(schema).parquet(path).select("valid_from", "p25", "p50", "p75")


def add_price_tier(records: DataFrame, known: DataFrame, date: str | Column) -> DataFrame:
    """``price_tier`` and ``snapshot_from`` by the newest snapshot not after ``date``.

    Both are NULL where the record has no date or is older than every snapshot. There is
    a snapshot per day at most: they are collected and become one constant array.
    """
    saved = sorted(map(tuple, known.select("valid_from", "p25", "p50", "p75").collect()))
    names = ("valid_from", "p25", "p50", "p75")
    constants = [F.struct(*[F.lit(x).cast(k).alias(n) for x, k, n in zip(s, KINDS, names)]) for s in saved]
    listed = F.array(*constants).cast(f"array<struct<{', '.join(f'{n}: {k}' for n, k in zip(names, KINDS))}>>")
    day = F.to_date(date) if isinstance(date, str) else date
    valid = F.filter(listed, lambda s: s["valid_from"] <= day)
    rows = records.withColumn("_valid", F.try_element_at(valid, F.lit(-1)))
    bounds = [F.col("_valid")[name] for name in ("p25", "p50", "p75")]
    tier = banded(F.col("price_usd"), zip(bounds, V.QUARTILE_TIERS), V.QUARTILE_TIER_BEYOND)
    return rows.withColumns(
        {
            "price_tier": F.when(F.col("_valid").isNotNull(), tier),
            "snapshot_from": F.col("_valid")["valid_from"],
        }
    ).drop("_valid")


def run_tiered(
    stream: DataFrame, snapshot_path: str, path: str, checkpoint: str, date: str = "ingestion_timestamp"
) -> DataFrame:
    """Tier all streamed records that are available now; returns what has been written."""
    spark = stream.sparkSession

    def write(records: DataFrame, batch: int) -> None:
        seen = f"{path}/seen/batch={batch:09d}"
        fs, done = file_system(spark, f"{seen}/_SUCCESS")
        if not fs.exists(done):
            snapshots(spark, snapshot_path).coalesce(1).write.mode("overwrite").parquet(seen)
        known = spark.read.schema(SNAPSHOT).parquet(seen)
        tiered = add_price_tier(records, known, date)
        tiered.write.mode("overwrite").parquet(f"{path}/rows/batch={batch:09d}")

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    schema = T.StructType([f for f in stream.schema.fields if f.name != "price_tier"])
    schema = schema.add("price_tier", T.StringType()).add("snapshot_from", T.DateType())
    if not batches(spark, f"{path}/rows"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/rows").drop("batch")
