"""Record enrichment: classes, statuses, tiers, ranks, scores and forecasts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxstrata import fixed_values as V
from rxstrata import schemas
from rxstrata.functions.columns import as_date, banded, either, first_match, lookup, start_of
from rxstrata.functions.text import stable_suffix
from rxstrata.operators import distribution as dist
from rxstrata.operators import similar
from rxstrata.session import stage

Day = str | dt.date | Column

EFFICACY = dist.Measure("efficacy", "efficacy_score", by=("drug_category",))
SHARE = dist.Measure("share", "market_share", by=("drug_category",))


def measure_batch(validated: DataFrame) -> dist.Distribution:
    """Price, efficacy and share distributions of the batch, in one pass over it."""
    return dist.distribution(validated, EFFICACY, SHARE)


def add_classification(df: DataFrame) -> DataFrame:
    klass, category, name = F.col("therapeutic_class"), F.col("drug_category"), F.col("drug_name")
    subcategory = first_match(
        ((klass.contains(part), label) for part, label in V.SUBCATEGORY_BY_CLASS),
        V.SUBCATEGORY_DEFAULT,
    )
    by_name = [
        (category == wanted, first_match(((name.contains(p), s) for p, s in parts), rest))
        for wanted, parts, rest in V.SUBCLASS_BY_NAME
    ]
    subclass = first_match(by_name, F.concat(category, F.lit(V.SUBCLASS_SUFFIX)))
    code = F.concat(
        F.substring(category, 1, 1), F.substring(klass, -2, 2), stable_suffix(F.col("record_id"))
    )
    return df.withColumns(
        {"drug_subcategory": subcategory, "therapeutic_subclass": subclass, "atc_code": code}
    )


def add_patent_status(df: DataFrame, as_of: Day) -> DataFrame:
    days_left = F.datediff("patent_expiry_date", as_date(as_of))
    return df.withColumn("patent_status", banded(days_left, V.PATENT_BANDS, V.PATENT_BEYOND))


def price_quartiles(batch: DataFrame) -> DataFrame:
    """One row with the exact quartiles ``p25``, ``p50`` and ``p75`` of the price.

    Written, so that it is computed once however often a plan refers to it.
    """
    shares = {f"p{int(100 * q)}": q for q in V.QUARTILES}
    quartiles = dist.exact_quantiles(batch, "price_usd", **shares)
    return stage(quartiles, "quartiles")


def approximate_quartiles(df: DataFrame, accuracy: int = 10000) -> DataFrame:
    """The same row from the quantile sketch, within ``1 / accuracy`` of the rank."""
    sketch = F.percentile_approx("price_usd", F.array(*map(F.lit, V.QUARTILES)), accuracy)
    return df.select(sketch.alias("q")).select(
        *[F.get("q", F.lit(i)).alias(f"p{int(100 * q)}") for i, q in enumerate(V.QUARTILES)]
    )


def add_price_tier(df: DataFrame, quartiles: DataFrame) -> DataFrame:
    """Tier by quartile; the quartiles come in as a scalar subquery, not a join."""
    limits = quartiles.select(F.struct("p25", "p50", "p75")).scalar()
    bounds = [limits[name] for name in ("p25", "p50", "p75")]
    tier = banded(F.col("price_usd"), zip(bounds, V.QUARTILE_TIERS), V.QUARTILE_TIER_BEYOND)
    return df.withColumn("price_tier", tier)


def add_development_stage(df: DataFrame) -> DataFrame:
    by_phase = lookup(F.col("clinical_trial_phase"), V.STAGE_BY_PHASE, V.STAGE_UNKNOWN)
    return df.withColumn("development_stage", by_phase)


def add_region(df: DataFrame) -> DataFrame:
    return df.withColumn("region", lookup(F.col("country_code"), V.REGIONS, V.OTHER_REGION))


def add_efficacy_percentile(df: DataFrame, positions: DataFrame) -> DataFrame:
    percentile = F.round(dist.percent_rank() * 100, 1)
    return dist.attach_position(df, positions, EFFICACY, percentile, "efficacy_percentile")


def add_market_rank(df: DataFrame, positions: DataFrame) -> DataFrame:
    rank = dist.dense_rank_descending()
    return dist.attach_position(df, positions, SHARE, rank, "market_rank")


def add_safety_rating(df: DataFrame) -> DataFrame:
    cases = [
        ((F.col("safety_score") > above) & (F.col("adverse_event_rate") < below), label)
        for above, below, label in V.SAFETY_BANDS
    ]
    return df.withColumn("safety_rating", first_match(cases, V.SAFETY_BEYOND))


def add_risk_category(df: DataFrame) -> DataFrame:
    """Needs the patent status and the development stage."""
    events = F.coalesce("adverse_event_rate", F.lit(0.0))
    score = (
        (1 - F.col("safety_score")) * V.RISK_SAFETY_WEIGHT
        + events * V.RISK_EVENT_WEIGHT
        + either(F.col("patent_status") == "EXPIRED", (V.RISK_EXPIRED, 0.0))
        + either(F.col("development_stage") == "EARLY_DEVELOPMENT", (V.RISK_EARLY, 0.0))
    )
    return df.withColumn("risk_category", banded(score, V.RISK_BANDS, V.RISK_BEYOND))


def add_market_position(df: DataFrame) -> DataFrame:
    """Needs the market rank, the percentile, the price tier and the stage."""
    rank = F.col("market_rank")
    strong = F.col("efficacy_percentile") > V.CHALLENGER_PERCENTILE
    position = first_match(
        (
            (rank == V.LEADER_RANK, "LEADER"),
            (rank <= V.TOP_RANK, "TOP_3"),
            ((rank <= V.CHALLENGER_RANK) & strong, "CHALLENGER"),
            (F.col("price_tier") == "BUDGET", "VALUE_PLAYER"),
            (F.col("development_stage").isin(*V.PIPELINE_STAGES), "INNOVATOR"),
        ),
        "FOLLOWER",
    )
    return df.withColumn("market_position", position)


def add_revenue_forecast(df: DataFrame) -> DataFrame:
    revenue = (
        F.col("price_usd")
        * V.REVENUE_UNITS
        * F.col("market_share")
        * F.col("efficacy_score")
        * F.col("safety_score")
    )
    return df.withColumns(
        {
            "predicted_revenue": revenue,
            "revenue_forecast_6m": revenue * V.REVENUE_6M_SHARE,
            "revenue_forecast_12m": revenue,
        }
    )


def add_demand_score(df: DataFrame) -> DataFrame:
    """Needs the price tier, the patent status and the market position."""
    score = (
        F.col("efficacy_score") * V.DEMAND_EFFICACY
        + (1 - F.col("adverse_event_rate")) * V.DEMAND_SAFETY
        + lookup(F.col("price_tier"), V.DEMAND_TIER, V.DEMAND_TIER_OTHER)
        + either(F.col("patent_status") == "ACTIVE_LONG", V.DEMAND_LONG_PATENT)
        + either(F.col("market_position") == "LEADER", V.DEMAND_LEADER)
    )
    return df.withColumn("demand_score", F.round(score, 3))


def add_supply_risk(df: DataFrame) -> DataFrame:
    """Needs the region, the patent status and the development stage."""
    few = F.col("competitor_count") < V.SUPPLY_COMPETITORS_BELOW
    score = (
        either(F.col("region") == "Asia Pacific", V.SUPPLY_ASIA)
        + either(F.col("patent_status") == "EXPIRED", (V.SUPPLY_EXPIRED, 0.0))
        + either(few, V.SUPPLY_FEW_COMPETITORS)
        + either(F.col("development_stage") == "EARLY_DEVELOPMENT", (V.SUPPLY_EARLY, 0.0))
    )
    return df.withColumn("supply_risk_score", F.round(score, 3))


def add_similar_drugs(df: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The similar drugs from ``known`` (see ``operators.similar``); without it an empty
    list, since no similarity is fixed."""
    if known is None:
        return df.withColumn("similar_drugs", F.array().cast("array<string>"))
    return similar.attach_similar(df, known)


def similar_drugs(validated: DataFrame, k: int = similar.K, exact: bool = False) -> DataFrame:
    """The ``k`` nearest drugs of the same class for each drug of the batch."""
    return similar.similar_items(similar.profiles(enrichable(validated)), k, exact)


def add_confidence(df: DataFrame) -> DataFrame:
    score = (
        F.col("quality_score") * V.CONFIDENCE_QUALITY
        + lookup(F.col("validation_status"), V.CONFIDENCE_STATUS, 0.0)
        + either(F.size("validation_errors") == 0, V.CONFIDENCE_CLEAN)
    )
    return df.withColumn("confidence_score", F.round(score, 3))


def enrichable(validated: DataFrame) -> DataFrame:
    """Records that passed or passed with warnings; a NULL status drops too."""
    return validated.where(F.col("validation_status") != V.FAILED)


def enrich(
    validated: DataFrame,
    as_of: Day,
    run_at: Column | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """Enriched records of the batch.

    ``validated`` is read more than once, so pass a written table. ``known`` may give
    the similar drugs of each drug.
    """
    batch = enrichable(validated)
    measured = measure_batch(batch)
    positions = measured.positions(EFFICACY, SHARE)
    enriched = (
        batch.transform(add_classification)
        .transform(add_patent_status, as_of)
        .transform(add_price_tier, price_quartiles(batch))
        .transform(add_development_stage)
        .transform(add_region)
        .transform(add_efficacy_percentile, positions)
        .transform(add_safety_rating)
        .transform(add_risk_category)
        .transform(add_market_rank, positions)
        .transform(add_market_position)
        .transform(add_revenue_forecast)
        .transform(add_demand_score)
        .transform(add_supply_risk)
        .transform(add_similar_drugs, known)
        .transform(add_confidence)
        .withColumn("enrichment_timestamp", start_of(as_of) if run_at is None else run_at)
        .withColumn("ml_model_version", F.lit(V.MODEL_VERSION))
    )
    return keep_columns(enriched, schemas.ENRICHED.names)


def keep_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[name for name in wanted if name in df.columns])
