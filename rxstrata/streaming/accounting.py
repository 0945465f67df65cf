"""Every event in exactly one place: accepted, or set aside with the reason.

A watermark drops late rows without a trace. Here each micro-batch is split against the
high mark of its topic, the latest event time seen in the batches before; an event older
than the mark by more than its topic keeps messages goes to a side table. Marks and
outputs are written under the batch's number, so a batch that is repeated after a crash
replaces what it had written, and sees the same marks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxstrata import fixed_values as V
from rxstrata.functions.columns import first_match
from rxstrata.session import delete, file_system

ACCEPTED, LATE = "accepted", "late"
NO_TIME, UNKNOWN_TOPIC, TOO_OLD = "no event time", "unknown topic", "older than its topic keeps"
MARKS = "topic string, high timestamp"
KEPT_MARKS = 2


def batches(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the batches below a folder, ascending."""
    fs, at = file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def marks_before(spark: SparkSession, path: str, batch: int) -> DataFrame:
    """The high mark of each topic when a batch begins."""
    earlier = [b for b in batches(spark, path) if b < batch]
    if not earlier:
        return spark.createDataFrame([], MARKS)
    return spark.read.schema(MARKS).parquet(f"{path}/batch={earlier[-1]:09d}")


def reason(topic: Column, stamp: Column, high: Column, keeps: Mapping[str, int]) -> Column:
    """Why an event is set aside; NULL where it is accepted."""
    oldest = F.lit(None).cast("timestamp")
    for name, seconds in keeps.items():
        oldest = F.when(topic == name, high - F.expr(f"interval {int(seconds)} seconds")).otherwise(oldest)
    cases = [
        (stamp.isNull(), NO_TIME),
        (~F.coalesce(topic.isin(*keeps), F.lit(False)), UNKNOWN_TOPIC),
        (stamp < oldest, TOO_OLD),
    ]
    return first_match(cases, None)


def split_batch(
    events: DataFrame, marks: DataFrame, topic: str, stamp: str, keeps: Mapping[str, int]
) -> DataFrame:
    """Events with ``late_reason``. There is a mark per topic at most, and a topic has a
    fixed retention, so the marks are a constant map and nothing is joined."""
    known = F.map_from_entries(F.collect_list(F.struct("topic", "high")))
    high = F.try_element_at(marks.where(F.col("topic").isin(*keeps)).select(known).scalar(), F.col(topic))
    return events.withColumn("late_reason", reason(F.col(topic), F.col(stamp), high, keeps))


def run_accounted(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keeps: Mapping[str, int] = V.TOPIC_RETENTION,
    topic: str = "topic",
    stamp: str = "ts",
) -> tuple[DataFrame, DataFrame]:
    """Process all that is available now; returns the accepted and the late events.

    ``keeps`` has the seconds that each topic keeps its messages; events of other topics
    and without event time are set aside, too. Late events carry ``late_reason``. In a
    topic's first batch nothing is late.
    """
    spark = stream.sparkSession

    def write(events: DataFrame, batch: int) -> None:
        marks = marks_before(spark, f"{path}/marks", batch)
        rows = split_batch(events, marks, topic, stamp, keeps).persist()
        try:
            folder = f"batch={batch:09d}"
            accepted = rows.where("late_reason is null")
            accepted.drop("late_reason").write.mode("overwrite").parquet(f"{path}/{ACCEPTED}/{folder}")
            rows.where("late_reason is not null").write.mode("overwrite").parquet(f"{path}/{LATE}/{folder}")
            seen = accepted.select(F.col(topic).alias("topic"), F.col(stamp).alias("high"))
            highest = marks.unionByName(seen).groupBy("topic").agg(F.max("high").alias("high"))
            highest.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/{folder}")
        finally:
            rows.unpersist()
        for old in [b for b in batches(spark, f"{path}/marks") if b <= batch][:-KEPT_MARKS]:
            delete(spark, f"{path}/marks/batch={old:09d}")

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()

    def written(name: str, schema: T.StructType) -> DataFrame:
        if not batches(spark, f"{path}/{name}"):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{path}/{name}")

    plain = stream.schema
    return written(ACCEPTED, plain), written(LATE, T.StructType([*plain.fields, T.StructField("late_reason", T.StringType())]))
