"""Table contracts: columns, date partition and clustering keys of each layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, DOUBLE, LONG, INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()
STRINGS = T.ArrayType(STRING)


def struct(*fields: tuple[str, T.DataType], required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in fields])


RECORD_KEYS = ("record_id", "drug_name", "manufacturer", "drug_category")

RAW = struct(
    ("record_id", STRING),
    ("drug_name", STRING),
    ("drug_code", STRING),
    ("manufacturer", STRING),
    ("drug_category", STRING),
    ("active_ingredient", STRING),
    ("strength", STRING),
    ("dosage_form", STRING),
    ("route_of_administration", STRING),
    ("therapeutic_class", STRING),
    ("approval_date", DATE),
    ("patent_expiry_date", DATE),
    ("price", DOUBLE),
    ("currency", STRING),
    ("country", STRING),
    ("clinical_trial_phase", STRING),
    ("efficacy_score", DOUBLE),
    ("safety_score", DOUBLE),
    ("patient_count", LONG),
    ("adverse_events", LONG),
    ("market_share", DOUBLE),
    ("competitor_drugs", STRING),
    ("ingestion_timestamp", TIMESTAMP),
    ("source_file", STRING),
    ("raw_data", STRING),
)

VALIDATED = struct(
    ("record_id", STRING),
    ("drug_name", STRING),
    ("drug_code", STRING),
    ("manufacturer", STRING),
    ("drug_category", STRING),
    ("active_ingredient", STRING),
    ("strength_numeric", DOUBLE),
    ("strength_unit", STRING),
    ("dosage_form", STRING),
    ("route_of_administration", STRING),
    ("therapeutic_class", STRING),
    ("approval_date", DATE),
    ("patent_expiry_date", DATE),
    ("price_usd", DOUBLE),
    ("country_code", STRING),
    ("clinical_trial_phase", STRING),
    ("efficacy_score", DOUBLE),
    ("safety_score", DOUBLE),
    ("patient_count", LONG),
    ("adverse_events", LONG),
    ("adverse_event_rate", DOUBLE),
    ("market_share", DOUBLE),
    ("competitor_count", LONG),
    ("validation_timestamp", TIMESTAMP),
    ("validation_status", STRING),
    ("validation_errors", STRINGS),
    ("quality_score", DOUBLE),
    required=RECORD_KEYS,
)

ENRICHED = struct(
    ("record_id", STRING),
    ("drug_name", STRING),
    ("drug_code", STRING),
    ("manufacturer", STRING),
    ("drug_category", STRING),
    ("drug_subcategory", STRING),
    ("active_ingredient", STRING),
    ("strength_numeric", DOUBLE),
    ("strength_unit", STRING),
    ("dosage_form", STRING),
    ("route_of_administration", STRING),
    ("therapeutic_class", STRING),
    ("therapeutic_subclass", STRING),
    ("atc_code", STRING),
    ("approval_date", DATE),
    ("patent_expiry_date", DATE),
    ("patent_status", STRING),
    ("price_usd", DOUBLE),
    ("price_tier", STRING),
    ("country_code", STRING),
    ("region", STRING),
    ("clinical_trial_phase", STRING),
    ("development_stage", STRING),
    ("efficacy_score", DOUBLE),
    ("efficacy_percentile", DOUBLE),
    ("safety_score", DOUBLE),
    ("safety_rating", STRING),
    ("patient_count", LONG),
    ("adverse_events", LONG),
    ("adverse_event_rate", DOUBLE),
    ("risk_category", STRING),
    ("market_share", DOUBLE),
    ("market_position", STRING),
    ("competitor_count", LONG),
    ("similar_drugs", STRINGS),
    ("predicted_revenue", DOUBLE),
    ("revenue_forecast_6m", DOUBLE),
    ("revenue_forecast_12m", DOUBLE),
    ("demand_score", DOUBLE),
    ("supply_risk_score", DOUBLE),
    ("enrichment_timestamp", TIMESTAMP),
    ("ml_model_version", STRING),
    ("confidence_score", DOUBLE),
    required=RECORD_KEYS,
)

SUMMARY = struct(
    ("summary_date", DATE),
    ("drug_category", STRING),
    ("therapeutic_class", STRING),
    ("region", STRING),
    ("total_drugs", LONG),
    ("avg_efficacy_score", DOUBLE),
    ("avg_safety_score", DOUBLE),
    ("total_patient_count", LONG),
    ("total_adverse_events", LONG),
    ("avg_adverse_event_rate", DOUBLE),
    ("total_revenue", DOUBLE),
    ("avg_price_usd", DOUBLE),
    ("market_leader", STRING),
    ("top_drugs", T.ArrayType(struct(("drug_name", STRING), ("market_share", DOUBLE)))),
    ("pipeline_drugs", LONG),
    ("patent_expiring_count", LONG),
    ("high_risk_drugs", LONG),
    ("created_timestamp", TIMESTAMP),
)

QUALITY_METRICS = struct(
    ("check_timestamp", TIMESTAMP),
    ("table_name", STRING),
    ("check_type", STRING),
    ("metric_name", STRING),
    ("metric_value", DOUBLE),
    ("threshold", DOUBLE),
    ("status", STRING),
    ("details", STRING),
)

PIPELINE_RUNS = struct(
    ("run_id", STRING),
    ("pipeline_name", STRING),
    ("start_timestamp", TIMESTAMP),
    ("end_timestamp", TIMESTAMP),
    ("status", STRING),
    ("total_records", LONG),
    ("processed_records", LONG),
    ("failed_records", LONG),
    ("error_details", STRING),
    ("duration_seconds", LONG),
    ("cost_estimate", DOUBLE),
)

INGESTION_EVENT = struct(
    ("file_path", STRING),
    ("file_size", LONG),
    ("timestamp", LONG),
    ("source_system", STRING),
    ("data_type", STRING),
    ("priority", STRING),
)

CSV_NAMES = struct(("id", STRING), ("drug_name", STRING), ("dosage", STRING))

BRONZE_FILE = struct(
    ("ndc_number", STRING),
    ("labeler_name", STRING),
    ("product_name", STRING),
    ("generic_name", STRING),
    ("dosage_form", STRING),
    ("route", STRING),
    ("strength", STRING),
    ("unit_price", DOUBLE),
    ("package_size", INT),
    ("market_date", STRING),
)

BRONZE = struct(
    *((f.name, f.dataType) for f in BRONZE_FILE),
    ("ingestion_timestamp", LONG),
    ("source_file", STRING),
    ("data_version", STRING),
    required=(
        "ndc_number", "labeler_name", "product_name",
        "ingestion_timestamp", "source_file", "data_version",
    ),
)

SILVER = struct(
    ("drug_id", STRING),
    ("ndc_number_clean", STRING),
    ("labeler_name_clean", STRING),
    ("generic_name_standardized", STRING),
    ("therapeutic_class", STRING),
    ("dosage_category", STRING),
    ("price_tier", STRING),
    ("risk_category", STRING),
    ("market_segment", STRING),
    ("competition_index", DOUBLE),
    ("fda_approval_status", STRING),
    ("enrichment_confidence", DOUBLE),
    ("data_quality_score", DOUBLE),
    ("processing_timestamp", LONG),
    ("enrichment_version", STRING),
    required=(
        "drug_id", "ndc_number_clean", "labeler_name_clean", "generic_name_standardized",
        "dosage_category", "price_tier", "risk_category", "market_segment",
        "competition_index", "enrichment_confidence", "data_quality_score",
        "processing_timestamp", "enrichment_version",
    ),
)

GOLD = struct(
    ("analysis_date", STRING),
    ("therapeutic_class", STRING),
    ("market_segment", STRING),
    ("price_tier", STRING),
    ("drug_count", LONG),
    ("avg_price", DOUBLE),
    ("median_price", DOUBLE),
    ("price_std_dev", DOUBLE),
    ("market_share_pct", DOUBLE),
    ("avg_competition_index", DOUBLE),
    ("high_risk_count", LONG),
    ("quality_score_avg", DOUBLE),
    ("trend_direction", STRING),
    ("analysis_timestamp", LONG),
)

CLINICAL_TRIALS = struct(
    ("trial_id", STRING),
    ("trial_name", STRING),
    ("phase", STRING),
    ("status", STRING),
    ("start_date", DATE),
    ("end_date", DATE),
    ("participants", LONG),
    ("created_at", TIMESTAMP),
    required=("trial_id",),
)

DRUG_EFFICACY = struct(
    ("drug_id", STRING),
    ("drug_name", STRING),
    ("efficacy_score", DOUBLE),
    ("trial_count", LONG),
    ("avg_participants", DOUBLE),
    ("success_rate", DOUBLE),
    ("processed_date", TIMESTAMP),
    required=("drug_id",),
)


@dataclass(frozen=True)
class Layer:
    """How one layer is stored: its date partition column is derived from ``dated_by``."""

    name: str
    schema: T.StructType
    dated_by: str
    partition: str
    cluster: tuple[str, ...] = ()


LAYERS = {
    layer.name: layer
    for layer in (
        Layer("raw", RAW, "ingestion_timestamp", "ingest_date",
              ("drug_category", "manufacturer", "country")),
        Layer("validated", VALIDATED, "validation_timestamp", "validation_date",
              ("drug_category", "therapeutic_class", "country_code")),
        Layer("enriched", ENRICHED, "enrichment_timestamp", "enrichment_date",
              ("drug_category", "therapeutic_class", "region", "risk_category")),
        Layer("summary", SUMMARY, "summary_date", "summary_date",
              ("drug_category", "therapeutic_class", "region")),
        Layer("quality_metrics", QUALITY_METRICS, "check_timestamp", "check_date",
              ("table_name", "check_type")),
        Layer("pipeline_runs", PIPELINE_RUNS, "start_timestamp", "start_date",
              ("pipeline_name", "status")),
    )
}
