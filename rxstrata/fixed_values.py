"""Tables, thresholds, patterns and labels that define the results.

Everything here is data. The logic that applies it lives in ``operators``,
``functions`` and ``plans``.
"""

from typing import NamedTuple

# --- Fixed values: names, strengths and countries -------------------------------

NAME_DISALLOWED = r"[^A-Z0-9\s\-]"
NAME_LENGTH_ABOVE = 2
NAME_LENGTH_BELOW = 100

STRENGTH_NUMBER = r"(\d+\.?\d*)"
STRENGTH_NUMBER_AND_UNIT = r"(\d+\.?\d*)\s*(\w+)"
STRENGTH_UNITS = ("mg", "mcg", "g", "ml", "iu")

COUNTRY_CODES = {
    "USA": "US",
    "United States": "US",
    "UK": "GB",
    "United Kingdom": "GB",
    "Germany": "DE",
    "France": "FR",
    "Japan": "JP",
    "Canada": "CA",
    "Australia": "AU",
    "Italy": "IT",
}

REGIONS = {
    "US": "North America",
    "CA": "North America",
    "GB": "Europe",
    "DE": "Europe",
    "FR": "Europe",
    "IT": "Europe",
    "JP": "Asia Pacific",
    "AU": "Asia Pacific",
}
OTHER_REGION = "Other"

# --- Fixed values: validation ---------------------------------------------------

MAX_PRICE_USD = 100000
PATENT_GRACE_DAYS = 365

# flag column, weight in the quality score, message when the flag is false
QUALITY_CHECKS = (
    ("is_drug_name_valid", 0.20, "Invalid drug name"),
    ("is_strength_valid", 0.10, "Invalid strength format"),
    ("is_adverse_rate_valid", 0.15, "Invalid adverse event rate"),
    ("is_price_valid", 0.15, "Invalid price"),
    ("is_approval_date_valid", 0.10, "Invalid approval date"),
    ("is_patent_date_valid", 0.05, "Invalid patent date"),
    ("is_efficacy_valid", 0.15, "Invalid efficacy score"),
    ("is_safety_valid", 0.10, "Invalid safety score"),
)
PASSED_FROM = 0.8
WARNING_FROM = 0.6
PASSED, WARNING, FAILED = "PASSED", "WARNING", "FAILED"

PASS_RATE_THRESHOLD = 0.8
PASS_RATE_METRIC = "validation_pass_rate"
PASS_RATE_CHECK = "data_validation"

# --- Fixed values: enrichment ---------------------------------------------------

SUBCATEGORY_BY_CLASS = (("Alpha", "Primary"), ("Beta", "Secondary"), ("Gamma", "Tertiary"))
SUBCATEGORY_DEFAULT = "General"

# category, (name fragment, subclass)..., subclass of the rest
SUBCLASS_BY_NAME = (
    ("Cardiovascular", (("cor", "Coronary"), ("pres", "Hypertension")), "General Cardio"),
    ("Neurological", (("neuro", "Central Nervous"), ("pain", "Pain Management")), "General Neuro"),
)
SUBCLASS_SUFFIX = " - Standard"

# upper bound in days to expiry (exclusive), status
PATENT_BANDS = ((0, "EXPIRED"), (180, "EXPIRING_SOON"), (730, "ACTIVE_SHORT"))
PATENT_BEYOND = "ACTIVE_LONG"

QUARTILES = (0.25, 0.5, 0.75)
QUARTILE_TIERS = ("BUDGET", "STANDARD", "PREMIUM")
QUARTILE_TIER_BEYOND = "LUXURY"

STAGE_BY_PHASE = {
    "Phase I": "EARLY_DEVELOPMENT",
    "Phase II": "CLINICAL_TESTING",
    "Phase III": "LATE_STAGE",
    "Phase IV": "POST_MARKET",
    "Approved": "MARKETED",
}
STAGE_UNKNOWN = "UNKNOWN"
PIPELINE_STAGES = ("EARLY_DEVELOPMENT", "CLINICAL_TESTING")

# safety score above, event rate below, rating
SAFETY_BANDS = ((0.8, 0.05, "EXCELLENT"), (0.6, 0.1, "GOOD"), (0.4, 0.2, "MODERATE"))
SAFETY_BEYOND = "POOR"

RISK_SAFETY_WEIGHT = 0.4
RISK_EVENT_WEIGHT = 0.3
RISK_EXPIRED = 0.2
RISK_EARLY = 0.1
RISK_BANDS = ((0.2, "LOW"), (0.4, "MEDIUM"), (0.6, "HIGH"))
RISK_BEYOND = "VERY_HIGH"
HIGH_RISKS = ("HIGH", "VERY_HIGH")

LEADER_RANK = 1
TOP_RANK = 3
CHALLENGER_RANK = 10
CHALLENGER_PERCENTILE = 70

REVENUE_UNITS = 1000
REVENUE_6M_SHARE = 0.5

DEMAND_EFFICACY = 0.3
DEMAND_SAFETY = 0.2
DEMAND_TIER = {"BUDGET": 0.2, "STANDARD": 0.15}
DEMAND_TIER_OTHER = 0.1
DEMAND_LONG_PATENT = (0.2, 0.1)
DEMAND_LEADER = (0.1, 0.05)

SUPPLY_ASIA = (0.3, 0.1)
SUPPLY_EXPIRED = 0.2
SUPPLY_FEW_COMPETITORS = (0.3, 0.1)
SUPPLY_COMPETITORS_BELOW = 3
SUPPLY_EARLY = 0.2

CONFIDENCE_QUALITY = 0.5
CONFIDENCE_STATUS = {"PASSED": 0.3, "WARNING": 0.15}
CONFIDENCE_CLEAN = (0.2, 0.1)
CONFIDENT_ABOVE = 0.7
MODEL_VERSION = "v1.0.0"

# --- Fixed values: reports ------------------------------------------------------

CRITICAL_REVENUE_ABOVE = 100000
SUPPLY_RISK_ABOVE = 0.5
STAGE_ORDER = ("raw_data", "validated_data", "enriched_data")
RISK_ORDER = ("VERY_HIGH", "HIGH", "MEDIUM")

# --- Fixed values: scalar functions offered to SQL users ------------------------

PRODUCT_FORM_SUFFIX = r"\s+(TABLET|CAPSULE|INJECTION|SOLUTION|CREAM|GEL)S?$"
PRODUCT_UNIT_SUFFIX = r"\s+(MG|MCG|ML|GM?)$"
LABEL_STRENGTH = r"(?i)([0-9.]+)\s*(mg|mcg|g|ml|iu|%)?"



class LabelRules(NamedTuple):
    """Labels in order, each with alternatives of limits that must all be met."""

    cases: tuple
    default: str


DRUG_RISK = LabelRules(
    (
        ([[("event_rate", ">", 0.1)], [("safety", "<", 0.5)]], "HIGH"),
        ([[("event_rate", ">", 0.05)], [("safety", "<", 0.7)]], "MEDIUM"),
        ([[("patients", "<", 100)]], "UNKNOWN"),
    ),
    "LOW",
)
FIXED_PRICE_TIER = LabelRules(
    (
        ([[("price", "<", 10)]], "LOW"),
        ([[("price", "<", 100)]], "MEDIUM"),
        ([[("price", "<", 1000)]], "HIGH"),
    ),
    "PREMIUM",
)
FIXED_TIER_NULL = "UNKNOWN"
FIXED_POSITION = LabelRules(
    (
        ([[("share", ">", 0.3)]], "LEADER"),
        ([[("share", ">", 0.15), ("efficacy", ">", 0.7)]], "CHALLENGER"),
        ([[("price", "<", 50), ("efficacy", ">", 0.6)]], "VALUE_PLAYER"),
        ([[("efficacy", ">", 0.8)]], "INNOVATOR"),
    ),
    "FOLLOWER",
)

RECORD_TEXT_POINTS = {"drug_name": 20, "manufacturer": 15, "drug_category": 15}
# field, points, upper bound (lower bound 0)
RECORD_NUMBER_POINTS = (
    ("price", 10, 10000),
    ("efficacy_score", 20, 1),
    ("safety_score", 20, 1),
)

# --- Fixed values: events and alerts --------------------------------------------

EVENT_PRIORITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
VOLUME_WINDOW = "60 seconds"
VOLUME_WINDOW_SECONDS = 60
QUALITY_WINDOW = "300 seconds"
QUALITY_ALERT_BELOW = 0.8
INCIDENT_CLOSE = "1800 seconds"
BYTES_ALERT_ABOVE = 10 * 1024**3
RAW_RETENTION_DAYS = 90
#: Seconds that each topic keeps its messages: 7 days, 1 day and 3 days.
TOPIC_RETENTION = {"data-processing": 604800, "data-quality-alerts": 86400, "pipeline-notifications": 259200}

# --- Fixed values: synthetic records --------------------------------------------

GENERATED_NAMES = tuple(f"{a}{b}" for a in ("Alu", "Bero", "Cavi", "Domo", "Elfa") for b in ("ril", "san", "tex", "vor", "zan"))
GENERATED_MANUFACTURERS = tuple(f"Maker {chr(ord('A') + i)}" for i in range(10))
GENERATED_CATEGORIES = (
    "Cardiovascular", "Respiratory", "Neurological", "Gastrointestinal", "Endocrine",
    "Anti-infective", "Oncology", "Immunology", "Analgesic", "Psychiatric",
)
GENERATED_STRENGTHS = (10, 20, 25, 50, 100, 200, 250, 500, 1000)
GENERATED_UNITS = (" mg", " mcg", " ml", " g")
GENERATED_FORMS = ("Tablet", "Capsule", "Injection", "Solution", "Cream", "Inhaler")
GENERATED_ROUTES = ("Oral", "Injection", "Topical", "Inhalation", "Sublingual")
GENERATED_CLASSES = ("Alpha", "Beta", "Gamma", "Delta")
GENERATED_COUNTRIES = (
    "USA", "Canada", "UK", "Germany", "Japan", "Australia", "France", "Italy",
)
GENERATED_SAMPLE_RATE = 0.4
GENERATED_COMPETITORS = 3
