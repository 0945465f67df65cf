"""Views over the layers. Each takes layer tables and returns a DataFrame.

Row order is part of a view here; a report on top that needs another order states
its own, and Catalyst drops the inner sort.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxstrata import fixed_values as V
from rxstrata.functions.columns import (
    as_date,
    count_where,
    exact_mean,
    exact_sum,
    first_match,
    ratio,
    start_of,
)
from rxstrata.operators.topk import join_groups, top_k_arrays
from rxstrata.schemas import LAYERS
from rxstrata.sources.files import latest_snapshot, rows_on, rows_since

Day = str | dt.date | Column

TOP_DRUGS = 5
TOP_RISKS = 10


def _high_risk() -> Column:
    return F.col("risk_category").isin(*V.HIGH_RISKS)


def _expiring() -> Column:
    return F.col("patent_status") == "EXPIRING_SOON"


def _rows() -> Column:
    return F.count(F.lit(1))


def _share(condition: Column, digits: int | None = None) -> Column:
    return ratio(count_where(condition), _rows(), digits)


def validated_on(validated: DataFrame, as_of: Day) -> DataFrame:
    return rows_on(validated, LAYERS["validated"], as_of)


def enriched_on(enriched: DataFrame, as_of: Day) -> DataFrame:
    return rows_on(enriched, LAYERS["enriched"], as_of)


def data_quality_summary(validated: DataFrame) -> DataFrame:
    """Records per status, mean score and pass rate of each date."""
    status = F.col("validation_status")
    return (
        validated.groupBy(F.to_date("validation_timestamp").alias("validation_date"))
        .agg(
            _rows().alias("total_records"),
            count_where(status == V.PASSED).alias("passed_records"),
            count_where(status == V.WARNING).alias("warning_records"),
            count_where(status == V.FAILED).alias("failed_records"),
            exact_mean("quality_score", 3).alias("avg_quality_score"),
            _share(status == V.PASSED, 3).alias("pass_rate"),
        )
        .orderBy(F.col("validation_date").desc())
    )


def common_validation_errors(validated: DataFrame, as_of: Day) -> DataFrame:
    """How often each error occurs, per record of the date."""
    today = validated_on(validated, as_of)
    records = today.select(_rows().alias("n")).scalar()
    return (
        today.select(F.explode("validation_errors").alias("error"))
        .groupBy("error")
        .agg(_rows().alias("error_count"))
        .withColumn("error_rate", ratio(F.col("error_count"), records, 3))
        .orderBy(F.col("error_count").desc(), "error")
    )


def market_analysis(enriched: DataFrame, as_of: Day) -> DataFrame:
    """Prices, revenue, demand and leading drugs per category and region."""
    today, by = enriched_on(enriched, as_of), ("drug_category", "region")
    totals = today.groupBy(*by).agg(
        F.count_distinct("drug_name").alias("drug_count"),
        exact_mean("price_usd", 2).alias("avg_price"),
        exact_sum("predicted_revenue", 2).alias("total_predicted_revenue"),
        exact_mean("demand_score", 3).alias("avg_demand_score"),
        count_where(_high_risk()).alias("high_risk_count"),
    )
    order = [F.col("market_share").desc_nulls_last(), F.col("record_id").asc()]
    item = F.struct("drug_name", "market_position")
    tops = top_k_arrays(today, by, order, TOP_DRUGS, item, "top_drugs")
    joined = join_groups(totals, tops, by)
    return joined.orderBy(F.col("total_predicted_revenue").desc_nulls_last(), *by)


def pipeline_performance(enriched: DataFrame, as_of: Day) -> DataFrame:
    """Scores, expiries and confidence per development stage."""
    return (
        enriched_on(enriched, as_of)
        .groupBy("development_stage")
        .agg(
            _rows().alias("drug_count"),
            exact_mean("efficacy_score", 3).alias("avg_efficacy"),
            exact_mean("safety_score", 3).alias("avg_safety"),
            count_where(_expiring()).alias("patent_expiring_soon"),
            exact_mean("confidence_score", 3).alias("avg_confidence"),
        )
        .orderBy(F.col("drug_count").desc(), "development_stage")
    )


def risk_analysis(enriched: DataFrame, as_of: Day) -> DataFrame:
    """Event rates, supply risk and the riskiest drugs per risk category and rating."""
    today, by = enriched_on(enriched, as_of), ("risk_category", "safety_rating")
    totals = today.groupBy(*by).agg(
        _rows().alias("drug_count"),
        exact_mean("adverse_event_rate", 4).alias("avg_adverse_rate"),
        exact_mean("supply_risk_score", 3).alias("avg_supply_risk"),
    )
    order = [F.col("adverse_event_rate").desc_nulls_last(), F.col("record_id").asc()]
    tops = top_k_arrays(today, by, order, TOP_RISKS, F.col("drug_name"), "highest_risk_drugs")
    return join_groups(totals, tops, by).orderBy(*by)


def pipeline_performance_monitor(
    raw: DataFrame, validated: DataFrame, enriched: DataFrame, as_of: Day, days: int = 30
) -> DataFrame:
    """Records, mean score and pass rate per date and stage, for the last ``days``.

    The date filter is below the aggregates, where it prunes.
    """
    since = F.date_sub(as_date(as_of), days)

    def stage(df: DataFrame, layer: str, name: str, score: Column, passed: Column) -> DataFrame:
        rows = rows_since(df, LAYERS[layer], since)
        return rows.groupBy(F.to_date(LAYERS[layer].dated_by).alias("process_date")).agg(
            F.lit(name).alias("stage"),
            _rows().alias("record_count"),
            score.alias("avg_quality_score"),
            passed.alias("pass_rate"),
        )

    nothing = F.lit(None).cast("double")
    confident = F.col("confidence_score") > V.CONFIDENT_ABOVE
    stages = [
        stage(raw, "raw", V.STAGE_ORDER[0], nothing, nothing),
        stage(
            validated, "validated", V.STAGE_ORDER[1],
            exact_mean("quality_score", 3), _share(F.col("validation_status") == V.PASSED, 3),
        ),
        stage(
            enriched, "enriched", V.STAGE_ORDER[2],
            exact_mean("confidence_score", 3), _share(confident, 3),
        ),
    ]
    union = stages[0].unionByName(stages[1]).unionByName(stages[2])
    position = first_match(
        ((F.col("stage") == name, i) for i, name in enumerate(V.STAGE_ORDER)), len(V.STAGE_ORDER)
    )
    return union.withColumn("last_updated", start_of(as_of)).orderBy(
        F.col("process_date").desc(), position
    )


def market_intelligence(enriched: DataFrame) -> DataFrame:
    """Latest snapshot per category and class, with revenue rank and share of revenue.

    Rank and total are windows over the aggregated groups only, one row per class.
    """
    current = latest_snapshot(enriched, LAYERS["enriched"])
    groups = current.groupBy("drug_category", "therapeutic_class").agg(
        F.count_distinct("drug_name").alias("total_drugs"),
        exact_sum("predicted_revenue", 2).alias("total_revenue"),
        exact_mean("efficacy_score", 3).alias("avg_efficacy"),
        exact_mean("safety_score", 3).alias("avg_safety"),
        exact_mean("demand_score", 3).alias("avg_demand"),
        count_where(_high_risk()).alias("high_risk_drugs"),
        count_where(_expiring()).alias("patent_expiring_drugs"),
    )
    by_revenue = Window.orderBy(F.col("total_revenue").desc_nulls_last())
    everything = Window.partitionBy()
    total = F.sum(F.col("total_revenue").cast("decimal(28,2)")).over(everything)
    return groups.select(
        "*",
        F.rank().over(by_revenue).alias("revenue_rank"),
        F.try_divide("total_revenue", total.cast("double")).alias("market_share_pct"),
    )


def monitoring_status() -> Column:
    return first_match(
        (
            (
                _high_risk() & (F.col("predicted_revenue") > V.CRITICAL_REVENUE_ABOVE),
                "CRITICAL_MONITOR",
            ),
            (_high_risk(), "HIGH_RISK"),
            (_expiring(), "PATENT_RISK"),
            (F.col("supply_risk_score") > V.SUPPLY_RISK_ABOVE, "SUPPLY_RISK"),
        ),
        "NORMAL",
    )


def drug_risk_matrix(enriched: DataFrame, as_of: Day) -> DataFrame:
    """Every drug of the date with its monitoring status, riskiest first."""
    position = first_match(
        ((F.col("risk_category") == r, i) for i, r in enumerate(V.RISK_ORDER)), len(V.RISK_ORDER)
    )
    return (
        enriched_on(enriched, as_of)
        .select(
            "record_id",
            "drug_name",
            "manufacturer",
            "drug_category",
            "risk_category",
            "safety_rating",
            F.round("adverse_event_rate", 4).alias("adverse_event_rate"),
            F.round("supply_risk_score", 3).alias("supply_risk_score"),
            "patent_status",
            F.round("predicted_revenue", 2).alias("predicted_revenue"),
            monitoring_status().alias("monitoring_status"),
        )
        .orderBy(position, F.col("predicted_revenue").desc_nulls_last(), "record_id")
    )


def executive_summary(enriched: DataFrame, as_of: Day) -> DataFrame:
    """One row over the whole portfolio of the date."""
    return enriched_on(enriched, as_of).agg(
        F.count_distinct("drug_name").alias("total_drugs"),
        F.count_distinct("manufacturer").alias("total_manufacturers"),
        F.count_distinct("drug_category").alias("total_categories"),
        exact_sum("predicted_revenue", 2).alias("total_predicted_revenue"),
        exact_mean("efficacy_score", 3).alias("avg_efficacy_score"),
        exact_mean("safety_score", 3).alias("avg_safety_score"),
        count_where(_high_risk()).alias("high_risk_drugs"),
        count_where(_expiring()).alias("patent_expiring_soon"),
        count_where(F.col("market_position") == "LEADER").alias("market_leaders"),
        F.max(start_of(as_of)).alias("report_timestamp"),
    )
