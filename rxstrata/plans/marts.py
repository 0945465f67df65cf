"""The daily summary mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxstrata import fixed_values as V
from rxstrata import schemas
from rxstrata.functions.columns import as_date, count_where, fixed_point, ratio, start_of
from rxstrata.operators.topk import join_groups, top_k_arrays

SUMMARY_KEYS = ("drug_category", "therapeutic_class", "region")
TOP_DRUGS = 5


def summary_totals(enriched: DataFrame) -> DataFrame:
    """Counts, sums and means per category, class and region.

    Names are grouped first: the three conditional distinct counts become sums over
    one row per name, with one shuffle and without expanding every record per count.
    """
    sums = {
        "efficacy": "efficacy_score",
        "safety": "safety_score",
        "rate": "adverse_event_rate",
        "price": "price_usd",
    }
    flags = {
        "pipeline_drugs": F.col("development_stage").isin(*V.PIPELINE_STAGES),
        "patent_expiring_count": F.col("patent_status") == "EXPIRING_SOON",
        "high_risk_drugs": F.col("risk_category").isin(*V.HIGH_RISKS),
    }
    per_name = enriched.groupBy(*SUMMARY_KEYS, "drug_name").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("patient_count").alias("patients"),
        F.sum("adverse_events").alias("events"),
        F.try_sum(fixed_point("predicted_revenue")).alias("revenue"),
        *[F.try_sum(fixed_point(c)).alias(f"{name}_sum") for name, c in sums.items()],
        *[F.count(fixed_point(c)).alias(f"{name}_count") for name, c in sums.items()],
        *[F.bool_or(F.coalesce(flag, F.lit(False))).alias(name) for name, flag in flags.items()],
    )

    def mean(name: str) -> Column:
        return ratio(F.sum(f"{name}_sum"), F.sum(f"{name}_count"))

    return per_name.groupBy(*SUMMARY_KEYS).agg(
        F.sum("records").alias("total_drugs"),
        mean("efficacy").alias("avg_efficacy_score"),
        mean("safety").alias("avg_safety_score"),
        F.sum("patients").alias("total_patient_count"),
        F.sum("events").alias("total_adverse_events"),
        mean("rate").alias("avg_adverse_event_rate"),
        F.sum("revenue").cast("double").alias("total_revenue"),
        mean("price").alias("avg_price_usd"),
        *[
            count_where(F.col(name) & F.col("drug_name").isNotNull()).alias(name)
            for name in flags
        ],
    )


def summary_leaders(enriched: DataFrame, k: int = TOP_DRUGS) -> DataFrame:
    """The ``k`` records of greatest market share per group, and the first one's name."""
    order = [F.col("market_share").desc_nulls_last(), F.col("record_id").asc()]
    item = F.struct("drug_name", "market_share")
    tops = top_k_arrays(enriched, SUMMARY_KEYS, order, k, item, "top_drugs")
    return tops.withColumn("market_leader", F.get("top_drugs", F.lit(0))["drug_name"])


def daily_summary(enriched: DataFrame, as_of: str | dt.date) -> DataFrame:
    joined = join_groups(summary_totals(enriched), summary_leaders(enriched), SUMMARY_KEYS)
    stamped = joined.withColumns(
        {"summary_date": as_date(as_of), "created_timestamp": start_of(as_of)}
    )
    return stamped.select(*schemas.SUMMARY.names)
