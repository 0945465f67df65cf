"""Physical plans: broadcasts, shuffles and pruning as intended."""

import pytest
from rxstrata.checks import queries as q
from rxstrata.operators import enrichment as en
from rxstrata.plans import contracts, views

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_country_table_is_broadcast_without_shuffle(spark):
    text = plan(q.va.code_countries(q.validated(spark, FOLDER).withColumnRenamed("country_code", "country")))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_enrichment_rows_are_not_shuffled(spark):
    text = plan(en.enrich(q.validated(spark, FOLDER), q.AS_OF))
    assert text.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in text


def test_positions_too_large_to_broadcast_are_merged(spark):
    rows = q.batch(spark, FOLDER)
    want = en.enrich(q.validated(spark, FOLDER), q.AS_OF).select("record_id", "market_position")
    want = sorted(map(tuple, want.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = en.enrich(rows, q.AS_OF)
        assert "SortMergeJoin" in plan(merged) and "BroadcastHashJoin" not in plan(merged)
        assert sorted(map(tuple, merged.select("record_id", "market_position").collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_views_read_only_their_columns_and_date(spark):
    text = plan(views.executive_summary(q.enriched(spark, FOLDER), q.AS_OF))
    assert "PartitionFilters: [isnotnull(enrichment_date" in text
    schema = text[text.index("ReadSchema"):]
    assert "drug_name" in schema and "strength_unit" not in schema


def test_summary_has_no_expand(spark):
    from rxstrata.plans import marts

    text = plan(marts.summary_totals(q.enriched(spark, FOLDER)))
    assert "Expand" not in text and text.count("Exchange hashpartitioning") == 2


def test_competition_counts_before_it_joins(spark):
    rows = contracts.standardise(q._bronze(spark, FOLDER))
    text = plan(contracts.competition(rows))
    assert "partial_count" in text and "Join" not in text


@pytest.mark.parametrize(
    "name", ["vw_02_common_errors", "vw_03_market_analysis", "vw_08_drug_risk_matrix", "dq_03_top_revenue", "dq_12_validation_today"]
)
def test_views_prune_to_their_date(spark, name):
    """The stored layers hold three dates; a view reads one partition of them."""
    text = plan(q.QUERIES[name](spark, FOLDER))
    assert "PartitionFilters: [isnotnull(enrichment_date" in text or "PartitionFilters: [isnotnull(validation_date" in text
    assert q.validated_days(spark, FOLDER).select("validation_date").distinct().count() == 3


@pytest.mark.parametrize(
    "name", ["src_02_raw_by_date", "src_03_validated_by_date", "vw_06_stage_monitor", "dq_02_recent_stages",
             "dq_08_stages_today", "dq_14_raw_check_dated"]
)
def test_daily_queries_push_their_dates_to_stored_layers(spark, name):
    text = plan(q.QUERIES[name](spark, FOLDER))
    scans = text.split("FileScan")[1:]
    assert scans and all("GreaterThanOrEqual(" in scan and "daily-" in scan for scan in scans)
    assert "Join" not in text


def test_daily_views_read_stored_scores(spark):
    text = plan(q.QUERIES["vw_01_data_quality_summary"](spark, FOLDER))
    schema = text[text.index("ReadSchema"):]
    assert "quality_score" in schema and "drug_name" not in schema and "Join" not in text
