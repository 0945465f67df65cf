"""Dashboard and check queries on top of the views and layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxstrata.functions.columns import as_date, exact_mean, exact_sum
from rxstrata.plans import views
from rxstrata.plans.views import Day, enriched_on
from rxstrata.schemas import LAYERS
from rxstrata.sources.files import rows_on


def _by_revenue() -> list[Column]:
    return [F.col("predicted_revenue").desc_nulls_last(), F.col("record_id").asc()]


def _top_revenue(enriched: DataFrame, as_of: Day, k: int) -> DataFrame:
    """The ``k`` rows of greatest revenue; ties go by record id."""
    return enriched_on(enriched, as_of).orderBy(*_by_revenue()).limit(k)


def executive_summary(enriched: DataFrame, as_of: Day) -> DataFrame:
    return views.executive_summary(enriched, as_of)


def recent_pipeline_performance(monitor: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    return (
        monitor.where(F.col("process_date") >= F.date_sub(as_date(as_of), days))
        .select("process_date", "stage", "record_count", "avg_quality_score", "pass_rate")
        .orderBy(F.col("process_date").desc(), "stage")
    )


def top_drugs_by_revenue(enriched: DataFrame, as_of: Day, k: int = 10) -> DataFrame:
    return _top_revenue(enriched, as_of, k).select(
        "drug_name",
        "drug_category",
        "manufacturer",
        "market_position",
        F.round("predicted_revenue", 2).alias("predicted_revenue"),
        F.round("demand_score", 3).alias("demand_score"),
        "risk_category",
    )


def share_by_category(enriched: DataFrame) -> DataFrame:
    return (
        views.market_intelligence(enriched)
        .orderBy("revenue_rank", "drug_category", "therapeutic_class")
        .select(
            "drug_category",
            "total_drugs",
            "total_revenue",
            F.round(F.col("market_share_pct") * 100, 2).alias("market_share_pct"),
            "avg_efficacy",
            "avg_safety",
        )
    )


def high_risk_alert(enriched: DataFrame, as_of: Day, k: int = 20) -> DataFrame:
    matrix = views.drug_risk_matrix(enriched, as_of)
    risky = F.col("monitoring_status").isin("CRITICAL_MONITOR", "HIGH_RISK")
    return (
        matrix.where(risky)
        .orderBy(F.col("adverse_event_rate").desc_nulls_last(), "record_id")
        .limit(k)
        .select(
            "drug_name",
            "manufacturer",
            "risk_category",
            "safety_rating",
            "adverse_event_rate",
            "monitoring_status",
        )
    )


def quality_trend(validated: DataFrame, dates: int = 7) -> DataFrame:
    return (
        views.data_quality_summary(validated)
        .orderBy(F.col("validation_date").desc())
        .limit(dates)
        .select("validation_date", "total_records", "passed_records", "avg_quality_score", "pass_rate")
    )


def regional_performance(enriched: DataFrame, as_of: Day) -> DataFrame:
    return (
        enriched_on(enriched, as_of)
        .groupBy("region")
        .agg(
            F.count_distinct("drug_name").alias("drug_count"),
            exact_sum("predicted_revenue", 2).alias("total_revenue"),
            exact_mean("efficacy_score", 3).alias("avg_efficacy"),
            exact_mean("supply_risk_score", 3).alias("avg_supply_risk"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_last(), "region")
    )


def pipeline_today(monitor: DataFrame, as_of: Day) -> DataFrame:
    return monitor.where(F.col("process_date") == as_date(as_of)).select(
        "stage",
        "record_count",
        F.round("avg_quality_score", 3).alias("quality_score"),
        F.round(F.col("pass_rate") * 100, 1).alias("pass_rate_pct"),
    )


def top_revenue_short(enriched: DataFrame, as_of: Day, k: int = 5) -> DataFrame:
    return _top_revenue(enriched, as_of, k).select(
        "drug_name",
        "drug_category",
        F.round("predicted_revenue", 2).alias("revenue"),
        "market_position",
    )


def enrichment_check(enriched: DataFrame, as_of: Day) -> DataFrame:
    return enriched_on(enriched, as_of).agg(
        F.count(F.lit(1)).alias("total_enriched_records"),
        F.count_distinct("drug_category").alias("categories"),
        F.count_distinct("therapeutic_class").alias("therapeutic_classes"),
        F.count_distinct("region").alias("regions"),
        exact_mean("confidence_score", 3).alias("avg_confidence"),
        exact_sum("predicted_revenue", 2).alias("total_predicted_revenue"),
    )


def top_revenue_enrichment(enriched: DataFrame, as_of: Day, k: int = 10) -> DataFrame:
    return _top_revenue(enriched, as_of, k).select(
        "drug_name",
        "drug_category",
        "market_position",
        F.round("predicted_revenue", 2).alias("predicted_revenue"),
        F.round("demand_score", 3).alias("demand_score"),
        "risk_category",
    )


def validation_today(validated: DataFrame, as_of: Day) -> DataFrame:
    """The quality summary of one date; the filter is applied before aggregating."""
    return views.data_quality_summary(views.validated_on(validated, as_of))


def top_errors(validated: DataFrame, as_of: Day, k: int = 10) -> DataFrame:
    return (
        views.common_validation_errors(validated, as_of)
        .orderBy(F.col("error_count").desc(), "error")
        .limit(k)
    )


def raw_check(raw: DataFrame, as_of: Day | None = None) -> DataFrame:
    """Counts of records, drugs, manufacturers and categories, of one date or of all."""
    rows = raw if as_of is None else rows_on(raw, LAYERS["raw"], as_of)
    return rows.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("drug_name").alias("unique_drugs"),
        F.count_distinct("manufacturer").alias("unique_manufacturers"),
        F.count_distinct("drug_category").alias("unique_categories"),
    )
