import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import DAY, by_id, raw_rows
from rxstrata import schemas
from rxstrata.operators import enrichment as en
from rxstrata.operators.validation import validate


def table(spark, schema, *rows):
    return spark.createDataFrame(
        [(str(i), *row) for i, row in enumerate(rows)], "record_id string, " + schema
    )


def test_classification(spark):
    schema = "drug_category string, therapeutic_class string, drug_name string"
    rows = en.add_classification(
        table(
            spark, schema,
            ("Cardiovascular", "X-Alpha", "Betacor"),
            ("Cardiovascular", "X-Beta", "vasopres"),
            ("Cardiovascular", "X-Gamma", "CORPRES"),
            ("Neurological", "X-Delta", "neurocal"),
            ("Neurological", None, "Ketopain"),
            ("Neurological", "X-alpha", "other"),
            ("Oncology", "X-Beta", "Betacor"),
            (None, "X-Beta", "Betacor"),
        )
    )
    assert by_id(rows, "drug_subcategory") == [
        "Primary", "Secondary", "Tertiary", "General", "General", "General", "Secondary", "Secondary",
    ]
    assert by_id(rows, "therapeutic_subclass") == [
        "Coronary", "Hypertension", "General Cardio", "Central Nervous", "Pain Management",
        "General Neuro", "Oncology - Standard", None,
    ]
    code = by_id(rows, "atc_code")[0]
    assert code[:3] == "Cha" and len(code) == 6 and code[3:].isdigit()


def test_patent_bands(spark):
    days = [-1, 0, 179, 180, 729, 730, None]
    dates = [(None if d is None else DAY + dt.timedelta(d),) for d in days]
    rows = en.add_patent_status(table(spark, "patent_expiry_date date", *dates), DAY)
    assert by_id(rows, "patent_status") == [
        "EXPIRED", "EXPIRING_SOON", "EXPIRING_SOON", "ACTIVE_SHORT", "ACTIVE_SHORT",
        "ACTIVE_LONG", "ACTIVE_LONG",
    ]


def test_price_tiers(spark):
    rows = table(spark, "price_usd double", *[(float(p),) for p in (1, 2, 3, 4)], (None,))
    quartiles = spark.createDataFrame([(2.0, 3.0, 4.0)], "p25 double, p50 double, p75 double")
    assert by_id(en.add_price_tier(rows, quartiles), "price_tier") == [
        "BUDGET", "STANDARD", "PREMIUM", "LUXURY", "LUXURY",
    ]


def test_approximate_quartiles_are_close(spark):
    rows = spark.range(100000).select(F.col("id").cast("double").alias("price_usd"))
    row = en.approximate_quartiles(rows).first()
    for got, want in zip(row, (25000, 50000, 75000)):
        assert abs(got - want) <= 100000 / 10000 + 1


def test_stage_region_rating(spark):
    phases = [("Phase I",), ("Phase IV",), ("Approved",), ("phase i",), (None,)]
    rows = en.add_development_stage(table(spark, "clinical_trial_phase string", *phases))
    assert by_id(rows, "development_stage") == [
        "EARLY_DEVELOPMENT", "POST_MARKET", "MARKETED", "UNKNOWN", "UNKNOWN",
    ]
    codes = [("US",), ("IT",), ("AU",), ("Brazil",), (None,)]
    rows = en.add_region(table(spark, "country_code string", *codes))
    assert by_id(rows, "region") == ["North America", "Europe", "Asia Pacific", "Other", "Other"]
    scores = [(0.81, 0.049), (0.8, 0.049), (0.61, 0.05), (0.5, 0.19), (0.9, None), (None, 0.0)]
    rows = en.add_safety_rating(table(spark, "safety_score double, adverse_event_rate double", *scores))
    assert by_id(rows, "safety_rating") == [
        "EXCELLENT", "GOOD", "GOOD", "MODERATE", "POOR", "POOR",
    ]


def test_risk(spark):
    schema = (
        "safety_score double, adverse_event_rate double, patent_status string, "
        "development_stage string"
    )
    rows = en.add_risk_category(
        table(
            spark, schema,
            (1.0, None, "ACTIVE_LONG", "MARKETED"),
            (0.6, 0.2, "ACTIVE_LONG", "MARKETED"),
            (0.6, 0.2, "EXPIRED", "MARKETED"),
            (0.0, 0.2, "EXPIRED", "EARLY_DEVELOPMENT"),
            (None, 0.0, "ACTIVE_LONG", "MARKETED"),
        )
    )
    assert by_id(rows, "risk_category") == ["LOW", "MEDIUM", "HIGH", "VERY_HIGH", "VERY_HIGH"]


def test_market_position(spark):
    schema = (
        "market_rank long, efficacy_percentile double, price_tier string, development_stage string"
    )
    rows = en.add_market_position(
        table(
            spark, schema,
            (1, 0.0, "BUDGET", "MARKETED"),
            (3, 0.0, "BUDGET", "MARKETED"),
            (10, 70.1, "BUDGET", "MARKETED"),
            (10, 70.0, "BUDGET", "MARKETED"),
            (11, 99.0, "LUXURY", "CLINICAL_TESTING"),
            (11, 99.0, "LUXURY", "MARKETED"),
        )
    )
    assert by_id(rows, "market_position") == [
        "LEADER", "TOP_3", "CHALLENGER", "VALUE_PLAYER", "INNOVATOR", "FOLLOWER",
    ]


def test_scores(spark):
    schema = (
        "efficacy_score double, adverse_event_rate double, price_tier string, patent_status string,"
        "market_position string, region string, competitor_count long, development_stage string"
    )
    rows = table(
        spark, schema,
        (0.5, 0.1, "BUDGET", "ACTIVE_LONG", "LEADER", "Asia Pacific", 2, "EARLY_DEVELOPMENT"),
        (0.5, 0.1, "LUXURY", "EXPIRED", "FOLLOWER", "Europe", 3, "MARKETED"),
        (0.5, None, "STANDARD", "EXPIRED", "FOLLOWER", "Europe", 3, "MARKETED"),
    )
    assert by_id(en.add_demand_score(rows), "demand_score") == [0.83, 0.58, None]
    assert by_id(en.add_supply_risk(rows), "supply_risk_score") == [0.8, 0.4, 0.4]


def test_confidence(spark):
    schema = "quality_score double, validation_status string, validation_errors array<string>"
    rows = table(
        spark, schema, (1.0, "PASSED", []), (0.7, "WARNING", ["e"]), (0.1, None, ["e"])
    )
    assert by_id(en.add_confidence(rows), "confidence_score") == [1.0, 0.6, 0.15]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_pipeline_does_not_depend_on_partitioning(spark, partitions):
    changes = [
        {
            "market_share": (i % 7) / 10, "efficacy_score": None if i % 5 == 0 else (i % 11) / 10,
            "price": 10.0 + i, "drug_category": "Oncology" if i % 3 == 0 else "Cardiovascular",
            "competitor_drugs": None if i % 2 else "A,B,C",
        }
        for i in range(60)
    ]
    checked = validate(raw_rows(spark, *changes), DAY)
    want = sorted(en.enrich(checked, DAY).collect(), key=str)
    got = en.enrich(checked.repartition(partitions), DAY)
    assert got.columns == schemas.ENRICHED.names
    assert sorted(got.collect(), key=str) == want


def test_failed_and_unknown_status_drop(spark):
    rows = table(spark, "validation_status string", ("PASSED",), ("FAILED",), (None,), ("WARNING",))
    assert by_id(en.enrichable(rows), "validation_status") == ["PASSED", "WARNING"]
