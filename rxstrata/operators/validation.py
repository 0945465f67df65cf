"""Record validation: flags, standard forms, quality score and error list.

Every step is a row-local ``DataFrame -> DataFrame`` function, so the same
steps run on a batch and on a stream.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxstrata import fixed_values as V
from rxstrata import schemas
from rxstrata.functions import text
from rxstrata.functions.columns import as_date, first_match, start_of
from rxstrata.operators.lookup import attach, constant_table, one_per_key

Day = str | dt.date | Column


def check_drug_name(df: DataFrame, strip_before_upper: bool = False) -> DataFrame:
    clean = text.clean_drug_name(F.col("drug_name"), strip_before_upper)
    size = F.length(clean)
    in_range = (size > V.NAME_LENGTH_ABOVE) & (size < V.NAME_LENGTH_BELOW)
    return df.withColumns(
        {"drug_name_clean": clean, "is_drug_name_valid": F.coalesce(in_range, F.lit(False))}
    )


def parse_strength(df: DataFrame) -> DataFrame:
    number, unit = text.strength_number(F.col("strength")), text.strength_unit(F.col("strength"))
    usable = (number > 0) & unit.isin(*V.STRENGTH_UNITS)
    return df.withColumns(
        {
            "strength_numeric": number,
            "strength_unit": unit,
            "is_strength_valid": F.coalesce(usable, F.lit(False)),
        }
    )


def code_countries(df: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Country codes by name; a country the mapping lacks stays as it is.

    ``mapping`` has the columns ``country_name`` and ``code``; of a name that it has
    twice the smaller code counts.
    """
    constant = mapping is None
    if constant:
        mapping = constant_table(df.sparkSession, V.COUNTRY_CODES, "country_name", "code")
    return attach(df, mapping, "country", "country_name", "code", "country_code", unique=constant)


def rate_adverse_events(df: DataFrame) -> DataFrame:
    counted = (F.col("patient_count") > 0) & (F.col("adverse_events") >= 0)
    rate = F.when(counted, F.round(F.try_divide("adverse_events", "patient_count"), 4))
    return df.withColumns(
        {
            "adverse_event_rate": rate,
            "is_adverse_rate_valid": F.coalesce(rate.between(0, 1), F.lit(True)),
        }
    )


def price_in_usd(df: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """Price in USD: as given, or times the rate of its currency.

    ``rates`` has the columns ``currency_code`` and ``usd_rate``; a currency it
    lacks keeps its price, of one that it has twice the smaller rate counts.
    """
    if rates is None:
        priced = df.withColumn("price_usd", F.col("price"))
    else:
        named = one_per_key(rates, "currency_code", F.min("usd_rate").alias("usd_rate"))
        named = named.withColumnRenamed("currency_code", "__code")
        priced = (
            df.join(named, F.col("currency") == F.col("__code"), "left")
            .withColumn("price_usd", F.col("price") * F.coalesce("usd_rate", F.lit(1.0)))
            .drop("__code", "usd_rate")
        )
    usable = (F.col("price_usd") > 0) & (F.col("price_usd") < V.MAX_PRICE_USD)
    return priced.withColumn("is_price_valid", F.coalesce(usable, F.lit(False)))


def check_dates(df: DataFrame, as_of: Day) -> DataFrame:
    approved = F.col("approval_date") <= as_date(as_of)
    in_force = F.col("patent_expiry_date") > F.date_sub(as_date(as_of), V.PATENT_GRACE_DAYS)
    return df.withColumns(
        {
            "is_approval_date_valid": F.coalesce(approved, F.lit(False)),
            "is_patent_date_valid": F.coalesce(in_force, F.lit(True)),
        }
    )


def check_scores(df: DataFrame) -> DataFrame:
    def within(score: str) -> Column:
        return F.coalesce(F.col(score).between(0, 1), F.lit(True))

    return df.withColumns(
        {
            "is_efficacy_valid": within("efficacy_score"),
            "is_safety_valid": within("safety_score"),
        }
    )


def count_competitors(df: DataFrame) -> DataFrame:
    return df.withColumn("competitor_count", text.list_size(F.col("competitor_drugs")))


def score_quality(df: DataFrame) -> DataFrame:
    weights = [F.when(F.col(flag), weight).otherwise(0.0) for flag, weight, _ in V.QUALITY_CHECKS]
    scored = df.withColumn("quality_score", F.round(reduce(add, weights), 3))
    status = first_match(
        (
            (F.col("quality_score") >= V.PASSED_FROM, V.PASSED),
            (F.col("quality_score") >= V.WARNING_FROM, V.WARNING),
        ),
        V.FAILED,
    )
    return scored.withColumn("validation_status", status)


def list_errors(df: DataFrame) -> DataFrame:
    messages = [F.when(~F.col(flag), message) for flag, _, message in V.QUALITY_CHECKS]
    return df.withColumn("validation_errors", F.array_compact(F.array(*messages)))


def flag_records(df: DataFrame, as_of: Day) -> DataFrame:
    """All checks, the score, the status and the errors, next to the raw columns."""
    return (
        df.transform(check_drug_name)
        .transform(parse_strength)
        .transform(code_countries)
        .transform(rate_adverse_events)
        .transform(price_in_usd)
        .transform(check_dates, as_of)
        .transform(check_scores)
        .transform(count_competitors)
        .transform(score_quality)
        .transform(list_errors)
    )


def validate(raw: DataFrame, as_of: Day, run_at: Column | None = None) -> DataFrame:
    """Validated records. ``run_at`` stamps them, by default midnight of ``as_of``."""
    stamp = start_of(as_of) if run_at is None else run_at
    flagged = flag_records(raw, as_of).withColumn("validation_timestamp", stamp)
    return flagged.select(*schemas.VALIDATED.names)
