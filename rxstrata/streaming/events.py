"""Event streams: parsing, deduplication, windowed metrics, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxstrata import fixed_values as V
from rxstrata import schemas
from rxstrata.functions.columns import exact_mean, exact_sum
from rxstrata.session import file_system

REDELIVERY = "600 seconds"
RETENTION = "7 days"


def read_table_stream(
    spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None
) -> DataFrame:
    """A stored table as a stream, whether it is one file or a folder of files."""
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    fs, at = file_system(spark, path)
    if fs.getFileStatus(at).isFile():
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return reader.parquet(path)


def instants(events: DataFrame, column: str = "ts") -> DataFrame:
    """Event time as an instant: a watermark does not accept local timestamps."""
    return events.withColumn(column, F.col(column).cast("timestamp"))


def run_to_files(
    stream: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ()
) -> DataFrame:
    """Process all that is available now into Parquet files, and read them.

    Append mode with the file sink: each row is written once, whatever restarts.
    A window is written when the watermark has passed its end, which suits an endless
    stream; ``run_to_end`` gives the windows of a source that ends.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*partition_by)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.parquet(path)


def run_to_end(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """All windows of an aggregated stream whose source is used up, whatever came late.

    Complete mode: every batch writes the whole small result under its own number, so a
    repeated batch replaces itself and the highest number is the result. Nothing is
    dropped, and state is kept per window, not per row.
    """
    spark = stream.sparkSession

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch:09d}")

    query = (
        stream.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    fs, at = file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    if not names:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(f"{path}/{max(names)}")


def parse_ingestion(messages: DataFrame, body: str = "body") -> DataFrame:
    """Ingestion events from JSON, each with its ``outcome``.

    ``rejected`` are bodies that do not parse, that lack one of the fields or have one
    of another type, and priorities outside the domain; written with
    ``partition_by=("outcome",)`` they form the side table of bad rows, which keep
    their ``body`` for a replay.
    """
    parsed = messages.withColumn("event", F.from_json(body, schemas.INGESTION_EVENT))
    known = F.col("event.priority").isin(*V.EVENT_PRIORITIES)
    for field in schemas.INGESTION_EVENT.names:
        known = known & F.col(f"event.{field}").isNotNull()
    accepted = F.coalesce(known, F.lit(False))
    return parsed.withColumn("outcome", F.when(accepted, "accepted").otherwise("rejected"))


def without_redelivery(
    events: DataFrame, key: str = "event_id", stamp: str = "ts", within: str | None = RETENTION
) -> DataFrame:
    """First delivery of each event.

    An event may be late as long as its topic keeps it, and keys are remembered that
    long, which covers the redelivery deadline of ``REDELIVERY``. ``within=None`` takes
    events of any age and remembers every key, for sources that end.
    """
    if within is None:
        return events.dropDuplicates([key])
    return events.withWatermark(stamp, within).dropDuplicatesWithinWatermark([key])


def tumbling(
    events: DataFrame, length: str, late_by: str, /, stamp: str = "ts", **aggregates: Column
) -> DataFrame:
    """Tumbling-window aggregates.

    Run in append mode, a stream drops rows later than ``late_by``, by default the time
    that a topic keeps them; run to its end in complete mode it drops none.
    """
    grouped = events.withWatermark(stamp, late_by).groupBy(F.window(stamp, length).alias("span"))
    aliased = [column.alias(name) for name, column in aggregates.items()]
    return grouped.agg(*aliased).select(
        F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"), *aggregates
    )


def volume(events: DataFrame, late_by: str = RETENTION) -> DataFrame:
    """Events and events per second of each 60 seconds."""
    counts = tumbling(events, V.VOLUME_WINDOW, late_by, events=F.count(F.lit(1)))
    return counts.withColumn("per_second", F.col("events") / F.lit(V.VOLUME_WINDOW_SECONDS))


def mean_of(
    events: DataFrame, metric: str, digits: int = 6, late_by: str = RETENTION
) -> DataFrame:
    """Mean of a metric over each 300 seconds."""
    return tumbling(events, V.QUALITY_WINDOW, late_by, mean=exact_mean(metric, digits))


def alerts(means: DataFrame, threshold: float, above: bool = False) -> DataFrame:
    """Windows whose mean is on the wrong side of the threshold."""
    mean = F.col("mean")
    return means.where(mean > threshold if above else mean < threshold)


def incidents(breaches: DataFrame, close_after: str = V.INCIDENT_CLOSE) -> DataFrame:
    """Runs of breaching windows; one ends when none starts within ``close_after``.

    The input has at most one row per window, so its size grows with time, not data.
    """
    session = F.session_window("window_start", close_after).alias("session")
    return breaches.groupBy(session).agg(
        F.min("window_start").alias("opened_at"),
        F.max("window_end").alias("last_breach_end"),
        F.count(F.lit(1)).alias("windows"),
        F.min("mean").alias("worst_mean"),
    ).drop("session")


def live_incidents(
    events: DataFrame,
    metric: str,
    threshold: float,
    series: str,
    above: bool = False,
    digits: int = 6,
    late_by: str = RETENTION,
    close_after: str = V.INCIDENT_CLOSE,
    stamp: str = "ts",
) -> DataFrame:
    """Incidents of each series as one stream: its means of 300 seconds, those that
    breach, runs of them.

    Two stateful steps after each other, in append mode: a window's mean is final when
    the watermark has passed its end, and an incident is written once, when it has passed
    the last breach by ``close_after``. Open windows and open incidents are state in the
    checkpoint and outlast a restart. On a table it gives every incident, as
    ``incidents`` does for one series.
    """
    means = (
        events.withWatermark(stamp, late_by)
        .groupBy(series, F.window(stamp, V.QUALITY_WINDOW).alias("span"))
        .agg(exact_mean(metric, digits).alias("mean"))
    )
    breaches = alerts(means, threshold, above).withColumn("breach_time", F.window_time("span"))
    worst = F.max("mean") if above else F.min("mean")
    return breaches.groupBy(series, F.session_window("breach_time", close_after).alias("session")).agg(
        F.min("span.start").alias("opened_at"),
        F.max("span.end").alias("last_breach_end"),
        F.count(F.lit(1)).alias("windows"),
        worst.alias("worst_mean"),
    ).drop("session")


def error_gauge(
    events: DataFrame, severity: str = "event_type", error: str = "error", payload: str = "props",
    path: str = "$.k", late_by: str = RETENTION,
) -> DataFrame:
    """Errors reported in the JSON payload over each 300 seconds."""
    reported = F.get_json_object(payload, path).try_cast("long")
    errors = events.where(F.col(severity) == error).withColumn("reported", reported)
    return tumbling(
        errors, V.QUALITY_WINDOW, late_by,
        error_events=F.count(F.lit(1)), error_count=F.sum("reported"),
    )


def daily_within_retention(events: DataFrame, keep: str = RETENTION) -> DataFrame:
    """Daily event counts and sums; a row is accepted while its topic would retain it."""
    return tumbling(
        events, "1 day", keep, events=F.count(F.lit(1)), total=exact_sum("value", 2)
    )
