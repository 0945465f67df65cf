"""Bronze, silver and gold marts.

The contracts fix the columns and their domains but no rule for the derived ones.
The rules and default limits below are this library's own choice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxstrata import schemas
from rxstrata.functions import text
from rxstrata.functions.columns import banded, count_where, exact_mean, first_match, ratio
from rxstrata.operators import distribution as dist
from rxstrata.operators.lookup import one_per_key
from rxstrata.operators.topk import join_groups
from rxstrata.session import stage


@dataclass(frozen=True)
class Limits:
    """Limits of the silver categories."""

    dosage: tuple[tuple[float, str], ...] = ((100.0, "LOW"), (300.0, "MEDIUM"))
    dosage_beyond: str = "HIGH"
    price: tuple[tuple[float, str], ...] = ((1000.0, "BUDGET"), (2000.0, "STANDARD"))
    price_beyond: str = "PREMIUM"
    specialty_price: float = 2000.0
    risk: tuple[tuple[float, str], ...] = ((0.5, "HIGH"), (0.9, "MEDIUM"))
    risk_beyond: str = "LOW"


DEFAULTS = Limits()
VERSION = "v1.0.0"


def standardise(bronze: DataFrame) -> DataFrame:
    """Identifier and standard forms of the NDC number, labeler and generic name."""
    digits = F.regexp_replace("ndc_number", "[^0-9]", "")
    generic = F.coalesce("generic_name", F.col("product_name"))
    return bronze.withColumns(
        {
            "drug_id": F.sha2(F.concat_ws("|", "ndc_number", "labeler_name"), 256),
            "ndc_number_clean": F.lpad(digits, 11, "0"),
            "labeler_name_clean": text.clean_drug_name(F.trim("labeler_name")),
            "generic_name_standardized": F.coalesce(text.product_name(generic), F.lit("UNKNOWN")),
        }
    )


def categorise(df: DataFrame, limits: Limits = DEFAULTS) -> DataFrame:
    """Dosage category, price tier, market segment, data quality and risk."""
    amount, price = text.strength_number(F.col("strength")), F.col("unit_price")
    dosage = F.when(amount.isNull(), "UNKNOWN").otherwise(
        banded(amount, limits.dosage, limits.dosage_beyond)
    )
    segment = first_match(
        (
            (price >= limits.specialty_price, "SPECIALTY"),
            (F.col("route") == "Injection", "HOSPITAL"),
        ),
        "CONSUMER",
    )
    optional = ("generic_name", "dosage_form", "route", "strength", "unit_price")
    filled = sum((F.col(c).isNotNull().cast("int") for c in optional), F.lit(0))
    quality = F.round(filled / F.lit(len(optional)), 3)
    return df.withColumns(
        {
            "dosage_category": dosage,
            "price_tier": banded(price, limits.price, limits.price_beyond),
            "market_segment": segment,
            "data_quality_score": quality,
            "risk_category": banded(quality, limits.risk, limits.risk_beyond),
        }
    )


def competition(standard: DataFrame) -> DataFrame:
    """Per generic: 1 minus the sum of squared labeler shares.

    Counts per (generic, labeler) come first, so the second step sees one row per
    labeler whatever the number of items.
    """
    counts = standard.groupBy("generic_name_standardized", "labeler_name_clean").agg(
        F.count(F.lit(1)).cast("decimal(19,0)").alias("n")
    )
    squares = F.sum((F.col("n") * F.col("n")).cast("decimal(38,0)"))
    total = F.sum("n").cast("double")
    index = 1 - F.try_divide(squares.cast("double"), total * total)
    return counts.groupBy("generic_name_standardized").agg(
        F.round(index, 6).alias("competition_index")
    )


def silver(
    bronze: DataFrame,
    processed_at: Column,
    limits: Limits = DEFAULTS,
    lookups: DataFrame | None = None,
) -> DataFrame:
    """Silver rows. ``lookups`` may give ``therapeutic_class`` and
    ``fda_approval_status`` per ``generic_name_standardized``; without it they are NULL.
    Of a name that it has twice the smaller pair counts."""
    rows = categorise(standardise(bronze), limits)
    index = stage(competition(rows), "competition")
    rows = join_groups(rows, index, ["generic_name_standardized"])
    if lookups is None:
        rows = rows.withColumns(
            {
                "therapeutic_class": F.lit(None).cast("string"),
                "fda_approval_status": F.lit(None).cast("string"),
            }
        )
    else:
        key, pair = "generic_name_standardized", F.struct("therapeutic_class", "fda_approval_status")
        once = one_per_key(lookups, key, F.min(pair).alias("pair")).select(key, "pair.*")
        rows = join_groups(rows, once, [key])
    known = F.when(F.col("dosage_category") == "UNKNOWN", 0.0).otherwise(0.5)
    return rows.withColumns(
        {
            "enrichment_confidence": F.round(F.col("data_quality_score") * 0.5 + known, 3),
            "processing_timestamp": F.unix_millis(processed_at),
            "enrichment_version": F.lit(VERSION),
        }
    ).select(
        *schemas.SILVER.names,
        *[c for c in ("unit_price", "market_date") if c in rows.columns],
    )


GOLD_KEYS = ("analysis_date", "therapeutic_class", "market_segment", "price_tier")


def gold(items: DataFrame, analysed_at: Column) -> DataFrame:
    """Gold rows from silver rows that carry ``analysis_date`` and ``unit_price``.

    Medians come from the price distribution, so no group's prices meet in one
    buffer. The standard deviation is the sample one.
    """
    price = F.col("unit_price")
    groups = items.groupBy(*GOLD_KEYS).agg(
        F.count(F.lit(1)).alias("drug_count"),
        exact_mean("unit_price").alias("avg_price"),
        F.stddev_samp(price).alias("price_std_dev"),
        exact_mean("competition_index").alias("avg_competition_index"),
        count_where(F.col("risk_category") == "HIGH").alias("high_risk_count"),
        exact_mean("data_quality_score").alias("quality_score_avg"),
    )
    measure = dist.Measure("price", "unit_price", by=GOLD_KEYS, keep_nulls=False)
    middle = dist.distribution(items, measure).medians(measure, "median_price")
    mart = join_groups(groups, middle, GOLD_KEYS)
    on_date = Window.partitionBy("analysis_date")
    in_series = Window.partitionBy(*GOLD_KEYS[1:]).orderBy("analysis_date")
    share = ratio(F.col("drug_count") * 100, F.sum("drug_count").over(on_date))
    return mart.withColumns(
        {
            "market_share_pct": share,
            "trend_direction": price_trend(F.col("avg_price"), in_series),
            "analysis_timestamp": F.unix_millis(analysed_at),
        }
    ).select(*schemas.GOLD.names)


def price_trend(price: Column, series) -> Column:
    """UP, DOWN or STABLE against the previous date; the first date is STABLE."""
    before = F.lag(price).over(series)
    return first_match(((price > before, "UP"), (price < before, "DOWN")), "STABLE")
