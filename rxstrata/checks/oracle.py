"""The same queries as SQL for DuckDB, written from the rules and not from the plans.

Rounding is spelled out: a double is rounded half up on its decimal digits, a mean
or sum is taken over exact decimals. Dates are shown as text, arrays joined.
"""

from __future__ import annotations

from rxstrata import fixed_values as V

AS_OF = "date '2001-06-01'"


# --- building blocks ------------------------------------------------------------


def r(x: str, digits: int) -> str:
    """Round a double half up, as its shortest decimal form reads."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,18)), {digits}) as double)"


def _units(x: str) -> str:
    return f"sum(cast(cast(cast({x} as varchar) as decimal(38,12)) * 1000000000000 as hugeint))"


def mean(x: str, digits: int) -> str:
    scale = 10**digits
    top = f"2 * {_units(x)} * {scale} + count({x}) * 1000000000000"
    return f"cast(({top}) // nullif(2 * count({x}) * 1000000000000, 0) as double) / {scale}e0"


def total(x: str, digits: int) -> str:
    scale = 10**digits
    return f"cast((2 * {_units(x)} * {scale} + 1000000000000) // 2000000000000 as double) / {scale}e0"


def share(condition: str, digits: int) -> str:
    return r(f"count(*) filter (where {condition}) / nullif(count(*), 0)", digits)


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def pick(labels: tuple, key: str) -> str:
    shown = ", ".join("NULL" if x is None else f"'{x}'" for x in labels)
    return f"([{shown}])[({key}) % {len(labels)} + 1]"


STRENGTH = f"""case when l_partkey % 17 = 0 then 'n/a' when l_partkey % 19 = 0 then null
  else cast(cast(trunc(l_quantity) as bigint) * 10 as varchar)
       || {pick((' mg', 'mcg', ' ml', ' g', ' %'), 'l_linenumber')} end"""
CATEGORY = pick(("Cardiovascular", "Neurological", "Oncology", "Endocrine"), "l_partkey")
FORM = pick(("Tablet", "Capsule", "Injection"), "l_linenumber")
ROUTE = "case when l_linenumber % 3 = 2 then 'Injection' else 'Oral' end"

LINES = """lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
  join orders on l_orderkey = o_orderkey"""

RAW = f"""raw as (select
  l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as record_id,
  upper(substr(p_name, 1, 1)) || substr(p_name, 2)
    || {pick((' XR', ' SR', ''), 'l_partkey')} as drug_name,
  'DRG-' || (1000 + p_partkey) as drug_code,
  s_name as manufacturer,
  {CATEGORY} as drug_category,
  p_name || '-Active' as active_ingredient,
  {STRENGTH} as strength,
  {FORM} as dosage_form,
  {ROUTE} as route_of_administration,
  {CATEGORY} || {pick(('-Alpha', '-Beta', '-Gamma', '-Delta'), 'l_suppkey')} as therapeutic_class,
  cast(o_orderdate as date) as approval_date,
  cast(cast(o_orderdate as date) + p_size * 100 as date) as patent_expiry_date,
  l_extendedprice as price,
  'USD' as currency,
  {pick(('USA', 'Canada', 'UK', 'Germany', 'Japan', 'Australia', 'France', 'Italy',
         'United States', 'Brazil'), 's_nationkey')} as country,
  case left(o_orderpriority, 1) when '1' then 'Phase I' when '2' then 'Phase II'
    when '3' then 'Phase III' when '4' then 'Phase IV' when '5' then 'Approved' end
    as clinical_trial_phase,
  case when l_orderkey % 23 <> 0
    then ((l_orderkey * 7919 + l_partkey * 31 + l_linenumber) % 1021) / 1000e0 end
    as efficacy_score,
  ((l_orderkey * 104729 + l_suppkey * 17) % 1021) / 1000e0 as safety_score,
  (l_orderkey * 13) % 500 as patient_count,
  (l_partkey * 11) % 60 as adverse_events,
  ((l_orderkey * 37 + l_partkey * 101 + l_suppkey) % 499) / 1000e0 as market_share,
  {pick((None, 'A', 'A, B', 'A, B, C'), 'l_suppkey')} as competitor_drugs,
  cast(l_shipdate as timestamp) as ingestion_timestamp,
  'lineitem.parquet' as source_file,
  cast(null as varchar) as raw_data
  from {LINES})"""

FLAGS = rf"""flags as (select *,
  regexp_replace(upper(drug_name), '[^A-Z0-9\s\-]', '', 'g') as drug_name_clean,
  coalesce(length(regexp_replace(upper(drug_name), '[^A-Z0-9\s\-]', '', 'g'))
    between 3 and 99, false) as is_drug_name_valid,
  try_cast(nullif(regexp_extract(strength, '(\d+\.?\d*)', 1), '') as double) as strength_numeric,
  lower(regexp_extract(strength, '(\d+\.?\d*)\s*(\w+)', 2)) as strength_unit,
  coalesce(try_cast(nullif(regexp_extract(strength, '(\d+\.?\d*)', 1), '') as double) > 0
    and lower(regexp_extract(strength, '(\d+\.?\d*)\s*(\w+)', 2))
      in ('mg', 'mcg', 'g', 'ml', 'iu'), false) as is_strength_valid,
  case country when 'USA' then 'US' when 'United States' then 'US' when 'UK' then 'GB'
    when 'United Kingdom' then 'GB' when 'Germany' then 'DE' when 'France' then 'FR'
    when 'Japan' then 'JP' when 'Canada' then 'CA' when 'Australia' then 'AU'
    when 'Italy' then 'IT' else country end as country_code,
  case when patient_count > 0 and adverse_events >= 0
    then {r('adverse_events / patient_count', 4)} end as adverse_event_rate,
  case when patient_count > 0 and adverse_events >= 0
    then adverse_events / patient_count <= 1.00005e0 else true end as is_adverse_rate_valid,
  price as price_usd,
  coalesce(price > 0 and price < 100000, false) as is_price_valid,
  coalesce(approval_date <= {AS_OF}, false) as is_approval_date_valid,
  patent_expiry_date is null or patent_expiry_date > {AS_OF} - 365 as is_patent_date_valid,
  efficacy_score is null or efficacy_score between 0 and 1 as is_efficacy_valid,
  safety_score is null or safety_score between 0 and 1 as is_safety_valid,
  case when competitor_drugs is null then 0
    else length(competitor_drugs) - length(replace(competitor_drugs, ',', '')) + 1 end
    as competitor_count
  from raw)"""

_POINTS = """(case when is_drug_name_valid then 20 else 0 end)
    + (case when is_strength_valid then 10 else 0 end)
    + (case when is_adverse_rate_valid then 15 else 0 end)
    + (case when is_price_valid then 15 else 0 end)
    + (case when is_approval_date_valid then 10 else 0 end)
    + (case when is_patent_date_valid then 5 else 0 end)
    + (case when is_efficacy_valid then 15 else 0 end)
    + (case when is_safety_valid then 10 else 0 end)"""
_MESSAGES = """case when not is_drug_name_valid then 'Invalid drug name' end,
    case when not is_strength_valid then 'Invalid strength format' end,
    case when not is_adverse_rate_valid then 'Invalid adverse event rate' end,
    case when not is_price_valid then 'Invalid price' end,
    case when not is_approval_date_valid then 'Invalid approval date' end,
    case when not is_patent_date_valid then 'Invalid patent date' end,
    case when not is_efficacy_valid then 'Invalid efficacy score' end,
    case when not is_safety_valid then 'Invalid safety score' end"""

SCORED = f"""scored as (select *, ({_POINTS}) / 100e0 as quality_score,
  case when ({_POINTS}) >= 80 then 'PASSED' when ({_POINTS}) >= 60 then 'WARNING'
    else 'FAILED' end as validation_status,
  list_filter([{_MESSAGES}], lambda m: m is not null) as validation_errors
  from flags)"""

BATCH = "batch as (select * from scored where validation_status <> 'FAILED')"

STAGES = f"""stages as (select *,
  case when contains(therapeutic_class, 'Alpha') then 'Primary'
    when contains(therapeutic_class, 'Beta') then 'Secondary'
    when contains(therapeutic_class, 'Gamma') then 'Tertiary' else 'General' end
    as drug_subcategory,
  case when drug_category = 'Cardiovascular' then
      case when contains(drug_name, 'cor') then 'Coronary'
        when contains(drug_name, 'pres') then 'Hypertension' else 'General Cardio' end
    when drug_category = 'Neurological' then
      case when contains(drug_name, 'neuro') then 'Central Nervous'
        when contains(drug_name, 'pain') then 'Pain Management' else 'General Neuro' end
    else drug_category || ' - Standard' end as therapeutic_subclass,
  left(drug_category, 1) || right(therapeutic_class, 2)
    || lpad(cast(cast('0x' || substr(md5(record_id), 1, 6) as bigint) % 1000 as varchar), 3, '0')
    as atc_code,
  case when patent_expiry_date - {AS_OF} < 0 then 'EXPIRED'
    when patent_expiry_date - {AS_OF} < 180 then 'EXPIRING_SOON'
    when patent_expiry_date - {AS_OF} < 730 then 'ACTIVE_SHORT' else 'ACTIVE_LONG' end
    as patent_status,
  case when price_usd < (select quantile_disc(price_usd, 0.25) from batch) then 'BUDGET'
    when price_usd < (select quantile_disc(price_usd, 0.5) from batch) then 'STANDARD'
    when price_usd < (select quantile_disc(price_usd, 0.75) from batch) then 'PREMIUM'
    else 'LUXURY' end as price_tier,
  case clinical_trial_phase when 'Phase I' then 'EARLY_DEVELOPMENT'
    when 'Phase II' then 'CLINICAL_TESTING' when 'Phase III' then 'LATE_STAGE'
    when 'Phase IV' then 'POST_MARKET' when 'Approved' then 'MARKETED' else 'UNKNOWN' end
    as development_stage,
  case when country_code in ('US', 'CA') then 'North America'
    when country_code in ('GB', 'DE', 'FR', 'IT') then 'Europe'
    when country_code in ('JP', 'AU') then 'Asia Pacific' else 'Other' end as region,
  {r('100 * percent_rank() over (partition by drug_category order by efficacy_score nulls first)', 1)}
    as efficacy_percentile,
  dense_rank() over (partition by drug_category order by market_share desc nulls last)
    as market_rank,
  case when safety_score > 0.8e0 and adverse_event_rate < 0.05e0 then 'EXCELLENT'
    when safety_score > 0.6e0 and adverse_event_rate < 0.1e0 then 'GOOD'
    when safety_score > 0.4e0 and adverse_event_rate < 0.2e0 then 'MODERATE'
    else 'POOR' end as safety_rating,
  price_usd * 1000e0 * market_share * efficacy_score * safety_score as predicted_revenue
  from batch)"""

RISKS = """risks as (select *,
  (1e0 - safety_score) * 0.4e0 + coalesce(adverse_event_rate, 0e0) * 0.3e0
    + (case when patent_status = 'EXPIRED' then 0.2e0 else 0e0 end)
    + (case when development_stage = 'EARLY_DEVELOPMENT' then 0.1e0 else 0e0 end) as risk_score,
  case when market_rank = 1 then 'LEADER' when market_rank <= 3 then 'TOP_3'
    when market_rank <= 10 and efficacy_percentile > 70 then 'CHALLENGER'
    when price_tier = 'BUDGET' then 'VALUE_PLAYER'
    when development_stage in ('EARLY_DEVELOPMENT', 'CLINICAL_TESTING') then 'INNOVATOR'
    else 'FOLLOWER' end as market_position
  from stages)"""

_DEMAND = """efficacy_score * 0.3e0 + (1e0 - adverse_event_rate) * 0.2e0
  + (case price_tier when 'BUDGET' then 0.2e0 when 'STANDARD' then 0.15e0 else 0.1e0 end)
  + (case when patent_status = 'ACTIVE_LONG' then 0.2e0 else 0.1e0 end)
  + (case when market_position = 'LEADER' then 0.1e0 else 0.05e0 end)"""
_SUPPLY = """(case when region = 'Asia Pacific' then 0.3e0 else 0.1e0 end)
  + (case when patent_status = 'EXPIRED' then 0.2e0 else 0e0 end)
  + (case when competitor_count < 3 then 0.3e0 else 0.1e0 end)
  + (case when development_stage = 'EARLY_DEVELOPMENT' then 0.2e0 else 0e0 end)"""
_CONFIDENCE = """quality_score * 0.5e0
  + (case validation_status when 'PASSED' then 0.3e0 when 'WARNING' then 0.15e0 else 0e0 end)
  + (case when len(validation_errors) = 0 then 0.2e0 else 0.1e0 end)"""

ENRICHED = f"""enriched as (select *,
  case when risk_score < 0.2e0 then 'LOW' when risk_score < 0.4e0 then 'MEDIUM'
    when risk_score < 0.6e0 then 'HIGH' else 'VERY_HIGH' end as risk_category,
  predicted_revenue * 0.5e0 as revenue_forecast_6m,
  predicted_revenue as revenue_forecast_12m,
  {r(_DEMAND, 3)} as demand_score,
  {r(_SUPPLY, 3)} as supply_risk_score,
  {r(_CONFIDENCE, 3)} as confidence_score
  from risks)"""

_CHAIN = {
    "raw": (RAW,),
    "flags": (RAW, FLAGS),
    "scored": (RAW, FLAGS, SCORED),
    "batch": (RAW, FLAGS, SCORED, BATCH),
    "enriched": (RAW, FLAGS, SCORED, BATCH, STAGES, RISKS, ENRICHED),
}


def over(base: str, body: str) -> str:
    """``body`` with the tables up to ``base`` defined before it."""
    return "with " + ",\n".join(_CHAIN[base]) + "\n" + body


HIGH = "risk_category in ('HIGH', 'VERY_HIGH')"
EXPIRING = "patent_status = 'EXPIRING_SOON'"
EARLY = "development_stage in ('EARLY_DEVELOPMENT', 'CLINICAL_TESTING')"


def n_if(condition: str) -> str:
    return f"count(*) filter (where {condition})"


ORACLES: dict[str, str] = {}

# --- sources and sinks ----------------------------------------------------------

_NAME_FILE = "select record_id as id, drug_name, strength as dosage"
_CSV_NAME = "replace(replace(upper(trim(drug_name)), '-', ' '), 'MG', '')"

ORACLES |= {
    "src_01_csv_scan": over("raw", f"{_NAME_FILE} from raw"),
    "src_02_raw_by_date": over(
        "raw",
        f"""select record_id, drug_name, price, country,
          {stamp('ingestion_timestamp')} as ingestion_timestamp
          from raw where cast(ingestion_timestamp as date) = {AS_OF}""",
    ),
    "src_03_validated_by_date": over(
        "scored",
        f"""select record_id, validation_status, quality_score from scored
          where cast(ingestion_timestamp as date) = {AS_OF} and validation_status <> 'FAILED'""",
    ),
    "src_04_latest_snapshot": over(
        "scored",
        f"""select record_id, {stamp('ingestion_timestamp')} as validation_timestamp, quality_score
          from scored where cast(ingestion_timestamp as date)
            = (select max(cast(ingestion_timestamp as date)) from scored)""",
    ),
    "src_06_schema_evolution": over(
        "raw",
        """select record_id, drug_name,
          case when route_of_administration = 'Injection' then price end as price from raw""",
    ),
    "src_07_country_table": over(
        "raw",
        """select country_name, code, count(country) as records
          from (values ('USA', 'US'), ('United States', 'US'), ('UK', 'GB'),
            ('United Kingdom', 'GB'), ('Germany', 'DE'), ('France', 'FR'), ('Japan', 'JP'),
            ('Canada', 'CA'), ('Australia', 'AU'), ('Italy', 'IT')) t(country_name, code)
          left join raw on country = country_name group by all""",
    ),
    "src_08_array_as_table": over(
        "raw",
        """select category, count(drug_category) as records
          from unnest(['Cardiovascular', 'Respiratory', 'Neurological', 'Gastrointestinal',
            'Endocrine', 'Anti-infective', 'Oncology', 'Immunology', 'Analgesic',
            'Psychiatric']) t(category)
          left join raw on category = drug_category group by all""",
    ),
    "snk_01_overwrite_parquet": over(
        "raw", f"{_NAME_FILE}, {_CSV_NAME} as clean_drug_name from raw"
    ),
}

_VALIDATED = f"""record_id, drug_name, drug_code, manufacturer, drug_category, active_ingredient,
  strength_numeric, strength_unit, dosage_form, route_of_administration, therapeutic_class,
  {day('approval_date')} as approval_date, {day('patent_expiry_date')} as patent_expiry_date,
  price_usd, country_code, clinical_trial_phase, efficacy_score, safety_score, patient_count,
  adverse_events, adverse_event_rate, market_share, competitor_count, validation_status,
  array_to_string(validation_errors, '|') as validation_errors, quality_score"""

ORACLES |= {
    "snk_02_write_validated": over(
        "scored",
        f"""select {_VALIDATED}, '2001-06-01 00:00:00' as validation_timestamp,
          '2001-06-01' as validation_date from scored""",
    ),
}

_METRIC = f"""'2001-06-01 00:00:00' as check_timestamp, 'validated' as table_name,
  'data_validation' as check_type, 'validation_pass_rate' as metric_name,
  {r("count(*) filter (where validation_status = 'PASSED') / nullif(count(*), 0)", 6)}
    as metric_value,
  0.8e0 as threshold,
  case when count(*) filter (where validation_status = 'PASSED') / nullif(count(*), 0) > 0.8e0
    then 'PASSED' else 'FAILED' end as status,
  'Processed ' || count(*) || ' records' as details"""

ORACLES |= {
    "snk_05_write_metric": over(
        "scored", f"select {_METRIC}, '2001-06-01' as check_date from scored"
    ),
    # the run of all records, and before it those of the records of earlier days
    "snk_08_run_ledger": over(
        "scored",
        " union all ".join(
            f"""select {run} as run, 'validation' as pipeline_name, 'SUCCEEDED' as status,
          count(*) as total_records,
          {n_if("validation_status <> 'FAILED'")} as processed_records,
          {n_if("validation_status = 'FAILED'")} as failed_records
          from scored where patient_count % {divisor} = 0"""
            for run, divisor in ((1, 3), (2, 5), (3, 1))
        ),
    ),
}

ORACLES |= {
    "snk_02_clustered_validated": over(
        "scored",
        """select record_id, drug_category, country_code, price_usd from scored
          where country_code = 'DE'""",
    ),
    "snk_03_clustered_enriched": over(
        "enriched",
        """select record_id, therapeutic_class, region, risk_category from enriched
          where risk_category = 'LOW' and therapeutic_class >= 'Neurological'""",
    ),
}

ORACLES["src_06_contract_resolution"] = over(
    "raw",
    """, v as (select *, route_of_administration = 'Injection' as second,
      case when route_of_administration = 'Injection' and patient_count % 7 = 0 then 'patients: null' end as r1,
      case when clinical_trial_phase = 'Phase IV' then 'phase: unknown symbol Phase IV' end as r2 from raw)
    select record_id, case when ok then drug_name end as name,
      case when ok then cast(patient_count as double) end as patients,
      case when ok then clinical_trial_phase end as phase,
      case when ok then case when second then cast(cast(floor(price) as float) as double) else -1 end end as price,
      cast(null as varchar) as origin,
      case when not ok then concat_ws('|', r1, r2) end as reasons
    from (select *, r1 is null and r2 is null as ok from v)""",
)

# --- projections, predicates, joins ---------------------------------------------

ORACLES |= {
    "prj_03_tolerant_projection": over("raw", "select record_id, drug_name, price from raw"),
    "prd_01_null_logic": over(
        "raw",
        f"""select {n_if("efficacy_score > 0.5 and strength <> 'n/a'")} as both,
          {n_if("efficacy_score > 0.5 or strength <> 'n/a'")} as one,
          {n_if("not efficacy_score > 0.5")} as not_high,
          {n_if("strength is null")} as no_strength,
          {n_if("country in ('USA', 'UK')")} as listed from raw""",
    ),
    "prd_02_rolling_dates": over(
        "raw",
        f"""select {day('ingestion_timestamp')} as day, count(*) as records from raw
          where cast(ingestion_timestamp as date) >= {AS_OF} - 30 group by 1""",
    ),
    "prd_06_seeded_sample": over(
        "raw",
        """select record_id, drug_name from raw
          where cast('0x' || substr(md5('sample|' || record_id), 1, 7) as bigint)
            / 268435456e0 < 0.4e0""",
    ),
    "jn_01_country_left_join": over(
        "flags", "select country, country_code, count(*) as records from flags group by all"
    ),
    "jn_02_dimension_grid": over(
        "raw",
        """select category, phase, form, count(record_id) as records
          from unnest(['Cardiovascular', 'Neurological', 'Oncology', 'Endocrine']) c(category)
          cross join unnest(['Phase I', 'Phase II', 'Phase III', 'Phase IV', 'Approved']) p(phase)
          cross join unnest(['Tablet', 'Capsule', 'Injection']) f(form)
          left join raw on drug_category = category and clinical_trial_phase = phase
            and dosage_form = form group by all""",
    ),
    "jn_03_unnest_errors": over(
        "scored", "select record_id, unnest(validation_errors) as error from scored"
    ),
    "jn_04_other_names": over(
        "raw",
        """select record_id, array_to_string(list_transform(list_sort(list_transform(
            list_filter(['Cardiovascular', 'Respiratory', 'Neurological', 'Gastrointestinal',
              'Endocrine', 'Anti-infective', 'Oncology', 'Immunology', 'Analgesic',
              'Psychiatric'], lambda x: x <> drug_category),
            lambda x: md5(record_id || '|' || x) || x))[1:3], lambda x: substr(x, 33)), ', ') as others
          from raw""",
    ),
    "jn_05_quartiles_on_rows": over(
        "batch",
        """select record_id, price_usd, p25, p50, p75 from batch,
          (select quantile_disc(price_usd, 0.25) as p25, quantile_disc(price_usd, 0.5) as p50,
             quantile_disc(price_usd, 0.75) as p75 from batch) q""",
    ),
    "jn_06_scalar_divisor": over(
        "scored",
        f"""select country_code, count(*) as records,
          {r('count(*) / (select count(*) from scored)', 6)} as share
          from scored group by country_code""",
    ),
}

# --- aggregates -----------------------------------------------------------------

_TOTALS = f"""count(*) as total_records,
  {n_if("validation_status = 'PASSED'")} as passed_records,
  {n_if("validation_status = 'WARNING'")} as warning_records,
  {n_if("validation_status = 'FAILED'")} as failed_records"""

_SUMMARY = f"""drug_category, therapeutic_class, region, count(*) as total_drugs,
  {mean('efficacy_score', 6)} as avg_efficacy_score,
  {mean('safety_score', 6)} as avg_safety_score,
  cast(sum(patient_count) as bigint) as total_patient_count,
  cast(sum(adverse_events) as bigint) as total_adverse_events,
  {mean('adverse_event_rate', 6)} as avg_adverse_event_rate,
  {total('predicted_revenue', 2)} as total_revenue,
  {mean('price_usd', 6)} as avg_price_usd,
  count(distinct drug_name) filter (where {EARLY}) as pipeline_drugs,
  count(distinct drug_name) filter (where {EXPIRING}) as patent_expiring_count,
  count(distinct drug_name) filter (where {HIGH}) as high_risk_drugs"""


def top_list(item: str, order: str, k: int) -> str:
    """First ``k`` items joined by a bar; rows must carry ``rn`` by that order."""
    return f"string_agg({item}, '|' order by {order}) filter (where rn <= {k})"


_TOP_SHARE = """(select *, row_number() over (partition by {by}
  order by market_share desc nulls last, record_id) as rn from enriched)"""
_TOP_RATE = """(select *, row_number() over (partition by risk_category, safety_rating
  order by adverse_event_rate desc nulls last, record_id) as rn from enriched)"""
_BY_CLASS = "drug_category, therapeutic_class, region"

ORACLES |= {
    "ag_01_status_totals": over(
        "scored",
        f"select {_TOTALS}, {mean('quality_score', 6)} as avg_quality_score from scored",
    ),
    "ag_02_group_summary": over(
        "enriched", f"select {_SUMMARY} from enriched group by {_BY_CLASS}"
    ),
    "ag_03_conditional_distinct": over(
        "enriched",
        f"""select drug_category,
          count(distinct case when {EARLY} then drug_name end) as pipeline_drugs,
          count(distinct case when {EXPIRING} then drug_name end) as patent_expiring_count,
          count(distinct case when {HIGH} then drug_name end) as high_risk_drugs
          from enriched group by drug_category""",
    ),
    "ag_04_count_if": over(
        "scored",
        f"""select clinical_trial_phase, {n_if("validation_status = 'PASSED'")} as passed,
          {share("validation_status = 'PASSED'", 6)} as pass_rate
          from scored group by clinical_trial_phase""",
    ),
    "ag_05_count_distinct": over(
        "enriched",
        """select count(distinct drug_name) as drugs, count(distinct manufacturer) as manufacturers,
          count(distinct therapeutic_class) as classes from enriched""",
    ),
    "ag_06_rounded_aggregates": over(
        "enriched",
        f"""select region, price_tier, {mean('price_usd', 2)} as avg_price,
          {total('predicted_revenue', 2)} as revenue from enriched group by all""",
    ),
    "ag_07_top_structs": over(
        "enriched",
        f"""select drug_category, region,
          {top_list("drug_name || '/' || market_position", 'rn', 5)} as top_drugs
          from {_TOP_SHARE.format(by='drug_category, region')} group by drug_category, region""",
    ),
    "ag_08_top_names": over(
        "enriched",
        f"""select risk_category, safety_rating,
          {top_list('drug_name', 'rn', 10)} as highest_risk_drugs
          from {_TOP_RATE} group by risk_category, safety_rating""",
    ),
    "ag_09_price_quartiles": over(
        "batch",
        """select quantile_disc(price_usd, 0.25) as p25, quantile_disc(price_usd, 0.5) as p50,
          quantile_disc(price_usd, 0.75) as p75 from batch""",
    ),
    "ag_10_group_by_date": over(
        "raw",
        f"""select {day('ingestion_timestamp')} as process_date, count(*) as record_count
          from raw group by 1""",
    ),
    "ag_11_leaders": over(
        "enriched",
        f"""select {_BY_CLASS}, {top_list("drug_name || '/' || market_share", 'rn', 5)} as top_drugs,
          max(drug_name) filter (where rn = 1) as market_leader
          from {_TOP_SHARE.format(by=_BY_CLASS)} group by {_BY_CLASS}""",
    ),
    "ag_13_latest_date": over(
        "raw", f"select {day('max(ingestion_timestamp)')} as latest from raw"
    ),
}

# --- windows, order, union ------------------------------------------------------

_INTELLIGENCE = f"""(select *, rank() over (order by total_revenue desc nulls last) as revenue_rank,
    total_revenue / cast(sum(cast(total_revenue as decimal(28,2))) over () as double)
      as market_share_pct
  from (select drug_category, therapeutic_class,
    count(distinct drug_name) as total_drugs,
    {total('predicted_revenue', 2)} as total_revenue,
    {mean('efficacy_score', 3)} as avg_efficacy,
    {mean('safety_score', 3)} as avg_safety,
    {mean('demand_score', 3)} as avg_demand,
    {n_if(HIGH)} as high_risk_drugs,
    {n_if(EXPIRING)} as patent_expiring_drugs
    from enriched group by drug_category, therapeutic_class))"""

ORACLES |= {
    "wn_01_efficacy_percentile": over(
        "batch",
        f"""select record_id, drug_category,
          {r('''100 * percent_rank() over (partition by drug_category
                order by efficacy_score nulls first)''', 1)} as efficacy_percentile from batch""",
    ),
    "wn_02_market_rank": over(
        "batch",
        """select record_id, drug_category, dense_rank() over (partition by drug_category
          order by market_share desc nulls last) as market_rank from batch""",
    ),
    "wn_03_revenue_rank": over(
        "enriched", f"select drug_category, therapeutic_class, revenue_rank from {_INTELLIGENCE}"
    ),
    "wn_04_share_of_total": over(
        "enriched",
        f"""select drug_category, therapeutic_class,
          {r('market_share_pct', 6)} as market_share_pct from {_INTELLIGENCE}""",
    ),
    "so_01_multi_key_sort": over(
        "enriched",
        """select * from (select risk_category, region, count(*) as n from enriched group by all)
          order by case when risk_category = 'VERY_HIGH' then 1 else 2 end, n desc, region""",
    ),
    "so_02_sorted_limit": over(
        "enriched",
        """select record_id, drug_name, risk_category from enriched
          order by predicted_revenue desc nulls last, record_id limit 20""",
    ),
    "set_01_union_with_nulls": over(
        "scored",
        f"""select drug_category, 'raw_data' as stage, count(*) as records,
            cast(null as double) as score from raw group by drug_category
          union all select drug_category, 'validated_data', count(*), {mean('quality_score', 3)}
            from scored group by drug_category""",
    ),
}

# --- scalar functions -----------------------------------------------------------

ORACLES |= {
    "fn_04_strings": over(
        "raw",
        """select record_id, length(drug_name) as size, right(drug_name, 2) as last_two,
          strength || '|' || drug_name as joined,
          lpad(cast(patient_count as varchar), 3, '0') as padded,
          replace(lower(drug_name), ' ', '_') as underscored from raw""",
    ),
    "fn_05_list_size": over(
        "raw",
        """select record_id, coalesce(len(string_split(competitor_drugs, ',')), 0) as parts
          from raw""",
    ),
    "fn_14_dates": over(
        "raw",
        f"""select record_id, {day('approval_date + 365')} as plus_year,
          {day('approval_date - 30')} as minus_month,
          patent_expiry_date - approval_date as term_days,
          strftime(approval_date, '%Y%m%d') as stamp from raw""",
    ),
    "fn_15_arithmetic": over(
        "raw",
        f"""select record_id, {r('price * market_share', 2)} as weighted,
          patient_count % 7 as remainder,
          {r('adverse_events / nullif(patient_count, 0)', 4)} as rate from raw""",
    ),
    "fn_17_stable_suffix": over(
        "raw",
        """select record_id, lpad(cast(cast('0x' || substr(md5(record_id), 1, 6) as bigint) % 1000
          as varchar), 3, '0') as suffix from raw""",
    ),
    "fn_19_json_field": """select event_id,
        try_cast(json_extract_string(props, '$.k') as bigint) as k from events""",
}

# --- validation -----------------------------------------------------------------

ORACLES |= {
    "va_01_drug_name": over(
        "flags", "select record_id, drug_name_clean, is_drug_name_valid from flags"
    ),
    "va_01_drug_name_capitals": over(
        "raw",
        r"""select record_id,
          upper(regexp_replace(drug_name, '[^A-Z0-9\s\-]', '', 'g')) as drug_name_clean,
          length(regexp_replace(drug_name, '[^A-Z0-9\s\-]', '', 'g')) between 3 and 99
            as is_drug_name_valid from raw""",
    ),
    "va_02_strength": over(
        "flags", "select record_id, strength_numeric, strength_unit, is_strength_valid from flags"
    ),
    "va_03_country_code": over("flags", "select record_id, country_code from flags"),
    "va_04_adverse_event_rate": over(
        "flags", "select record_id, adverse_event_rate, is_adverse_rate_valid from flags"
    ),
    "va_05_price": over("flags", "select record_id, price_usd, is_price_valid from flags"),
    "va_06_dates": over(
        "flags", "select record_id, is_approval_date_valid, is_patent_date_valid from flags"
    ),
    "va_07_scores": over("flags", "select record_id, is_efficacy_valid, is_safety_valid from flags"),
    "va_08_quality_score": over(
        "scored", "select record_id, quality_score, validation_status from scored"
    ),
    "va_09_errors": over(
        "scored",
        "select record_id, array_to_string(validation_errors, '|') as validation_errors from scored",
    ),
    "va_10_competitor_count": over("flags", "select record_id, competitor_count from flags"),
    "va_11_validate": over(
        "scored",
        f"""select {_VALIDATED}, {stamp('ingestion_timestamp')} as validation_timestamp
          from scored""",
    ),
    "va_12_pass_rate": over("scored", f"select {_METRIC} from scored"),
    "va_13_run_report": over(
        "scored",
        f"""select {_TOTALS}, {mean('quality_score', 3)} as avg_quality_score,
          {r("100 * count(*) filter (where validation_status = 'PASSED') / count(*)", 1)}
            as passed_pct,
          {r("100 * count(*) filter (where validation_status = 'WARNING') / count(*)", 1)}
            as warning_pct,
          {r("100 * count(*) filter (where validation_status = 'FAILED') / count(*)", 1)}
            as failed_pct from scored""",
    ),
}

# --- enrichment -----------------------------------------------------------------

for _key, _columns in {
    "en_01_subcategory": "drug_subcategory",
    "en_02_subclass": "therapeutic_subclass",
    "en_03_atc_code": "atc_code",
    "en_04_patent_status": "patent_status",
    "en_05_price_tier": "price_tier",
    "en_06_development_stage": "development_stage",
    "en_07_region": "region",
    "en_08_efficacy_percentile": "efficacy_percentile",
    "en_09_safety_rating": "safety_rating",
    "en_10_risk_category": "risk_category",
    "en_11_market_position": "market_position",
    "en_13_demand_score": "demand_score",
    "en_14_supply_risk": "supply_risk_score",
    "en_15_similar_drugs": "cast(0 as bigint) as similar",
    "en_16_confidence": "confidence_score",
}.items():
    ORACLES[_key] = over("enriched", f"select record_id, {_columns} from enriched")

_SIMILAR = ("price_usd", "efficacy_score", "safety_score", "adverse_event_rate", "market_share")
_SCALED = ", ".join(
    f"""case when {a} is null then 500 when max({a}) over () = min({a}) over () then 0
      else cast(floor(1000e0 * ({a} - min({a}) over ()) / (max({a}) over () - min({a}) over ())) as bigint) end as {a}"""
    for a in _SIMILAR
)
_APART = " + ".join(f"(x.{a} - y.{a}) * (x.{a} - y.{a})" for a in _SIMILAR)
ORACLES["en_15_nearest_drugs"] = over(
    "batch",
    f"""select therapeutic_class, drug_code, coalesce(string_agg(other, '|' order by rn), '') as similar
    from (select therapeutic_class, drug_code, other,
            row_number() over (partition by therapeutic_class, drug_code order by apart, other) as rn
          from (select x.therapeutic_class, x.drug_code, y.drug_code as other, {_APART} as apart
                from scaled x left join scaled y
                  on x.therapeutic_class = y.therapeutic_class and x.drug_code <> y.drug_code))
    where rn <= 5 group by therapeutic_class, drug_code""",
).replace(
    BATCH,
    BATCH
    + f""", means as (select therapeutic_class, drug_code, {", ".join(f"{mean(a, 6)} as {a}" for a in _SIMILAR)}
    from batch group by therapeutic_class, drug_code),
  scaled as (select therapeutic_class, drug_code, {_SCALED} from means)""",
)

_MONEY = f"""{r('predicted_revenue', 4)} as predicted_revenue,
  {r('revenue_forecast_6m', 4)} as revenue_forecast_6m,
  {r('revenue_forecast_12m', 4)} as revenue_forecast_12m"""

ORACLES |= {
    "en_12_revenue": over("enriched", f"select record_id, {_MONEY} from enriched"),
    "en_17_enrich": over(
        "enriched",
        f"""select record_id, drug_name, drug_code, manufacturer, drug_category, drug_subcategory,
          active_ingredient, strength_numeric, strength_unit, dosage_form, route_of_administration,
          therapeutic_class, therapeutic_subclass, atc_code,
          {day('approval_date')} as approval_date,
          {day('patent_expiry_date')} as patent_expiry_date, patent_status, price_usd, price_tier,
          country_code, region, clinical_trial_phase, development_stage, efficacy_score,
          efficacy_percentile, safety_score, safety_rating, patient_count, adverse_events,
          adverse_event_rate, risk_category, market_share, market_position, competitor_count,
          '' as similar_drugs, {_MONEY}, demand_score, supply_risk_score,
          '2001-06-01 00:00:00' as enrichment_timestamp, 'v1.0.0' as ml_model_version,
          confidence_score from enriched""",
    ),
    "en_18_run_metrics": over(
        "enriched",
        f"""select count(*) as total_enriched, {mean('confidence_score', 6)} as avg_confidence,
          count(distinct drug_category) as categories, count(distinct region) as regions,
          {mean('predicted_revenue', 2)} as avg_predicted_revenue from enriched""",
    ),
    "en_19_daily_summary": over(
        "enriched",
        f"""select '2001-06-01' as summary_date, {_SUMMARY},
          max(drug_name) filter (where rn = 1) as market_leader,
          {top_list("drug_name || '/' || market_share", 'rn', 5)} as top_drugs,
          '2001-06-01 00:00:00' as created_timestamp
          from {_TOP_SHARE.format(by=_BY_CLASS)} group by {_BY_CLASS}""",
    ),
}

ORACLES |= {
    "snk_03_write_enriched": ORACLES["en_17_enrich"].replace(
        "confidence_score from enriched",
        "confidence_score, '2001-06-01' as enrichment_date from enriched",
    ),
    "snk_04_write_summary": ORACLES["en_19_daily_summary"],
}

# --- functions for SQL users ----------------------------------------------------

_PRODUCT = r"""regexp_replace(regexp_replace(
    trim(regexp_replace(regexp_replace(upper(concat_ws('  ', drug_name, strength,
      dosage_form || 's')), '[^A-Z0-9\s\-]', '', 'g'), '\s+', ' ', 'g')),
    '\s+(TABLET|CAPSULE|INJECTION|SOLUTION|CREAM|GEL)S?$', ''), '\s+(MG|MCG|ML|GM?)$', '')"""
_LABEL = r"""try_cast(nullif(regexp_extract(regexp_extract(strength,
      '(?i)([0-9.]+)\s*(mg|mcg|g|ml|iu|%)?', 1), '^(\d*\.?\d*)', 1), '') as double)
    as numeric_value,
  nullif(lower(regexp_extract(strength, '(?i)([0-9.]+)\s*(mg|mcg|g|ml|iu|%)?', 2)), '') as unit"""
_TIER = """case when price is null then 'UNKNOWN' when price / 100 < 10 then 'LOW'
  when price / 100 < 100 then 'MEDIUM' when price / 100 < 1000 then 'HIGH' else 'PREMIUM' end"""

ORACLES |= {
    "ud_01_file_name": over(
        "raw",
        """select record_id, replace(replace(upper(trim(concat_ws('-', drug_name,
          upper(strength)))), '-', ' '), 'MG', '') as name from raw""",
    ),
    "ud_02_product_name": over("raw", f"select record_id, {_PRODUCT} as name from raw"),
    "ud_02_product_name_sql": over("raw", f"select record_id, {_PRODUCT} as name from raw"),
    "ud_03_strength": over("raw", f"select record_id, {_LABEL} from raw"),
    "ud_03_strength_sql": over("raw", f"select record_id, {_LABEL} from raw"),
    "ud_04_drug_risk": over(
        "flags",
        """select record_id, case
          when adverse_event_rate > 0.1e0 or safety_score < 0.5e0 then 'HIGH'
          when adverse_event_rate > 0.05e0 or safety_score < 0.7e0 then 'MEDIUM'
          when patient_count < 100 then 'UNKNOWN' else 'LOW' end as risk from flags""",
    ),
    "ud_05_price_tier": over("raw", f"select record_id, {_TIER} as tier from raw"),
    "ud_05_price_tier_sql": over("raw", f"select record_id, {_TIER} as tier from raw"),
    "ud_06_market_position": over(
        "raw",
        """select record_id, case when market_share > 0.3e0 then 'LEADER'
          when market_share > 0.15e0 and efficacy_score > 0.7e0 then 'CHALLENGER'
          when price / 100 < 50 and efficacy_score > 0.6e0 then 'VALUE_PLAYER'
          when efficacy_score > 0.8e0 then 'INNOVATOR' else 'FOLLOWER' end as position from raw""",
    ),
    "ud_07_record_quality": over(
        "raw",
        """select record_id, ((case when length(drug_name) > 0 then 20 else 0 end)
          + (case when length(manufacturer) > 0 then 15 else 0 end)
          + (case when length(drug_category) > 0 then 15 else 0 end)
          + (case when price between 0 and 10000 then 10 else 0 end)
          + (case when efficacy_score between 0 and 1 then 20 else 0 end)
          + (case when safety_score between 0 and 1 then 20 else 0 end)) / 100e0 as quality
          from raw""",
    ),
}

for _key in ("ud_04_drug_risk", "ud_06_market_position", "ud_07_record_quality"):
    ORACLES[f"{_key}_sql"] = ORACLES[_key]

# --- views ----------------------------------------------------------------------

_QUALITY_BY_DAY = f"""select {day('ingestion_timestamp')} as validation_date, {_TOTALS},
  {mean('quality_score', 3)} as avg_quality_score,
  {share("validation_status = 'PASSED'", 3)} as pass_rate from scored group by 1"""

_ERRORS = f"""select error, count(*) as error_count,
  {r('count(*) / (select count(*) from scored)', 3)} as error_rate
  from (select unnest(validation_errors) as error from scored) group by error"""

_MONITOR = f"""select process_date, stage, record_count, avg_quality_score, pass_rate from (
  select cast(ingestion_timestamp as date) as d, {day('ingestion_timestamp')} as process_date,
    'raw_data' as stage, count(*) as record_count, cast(null as double) as avg_quality_score,
    cast(null as double) as pass_rate from raw group by 1, 2
  union all select cast(ingestion_timestamp as date), {day('ingestion_timestamp')},
    'validated_data', count(*), {mean('quality_score', 3)},
    {share("validation_status = 'PASSED'", 3)} from scored group by 1, 2
  union all select cast(ingestion_timestamp as date), {day('ingestion_timestamp')},
    'enriched_data', count(*), {mean('confidence_score', 3)},
    {share('confidence_score > 0.7e0', 3)}
    from (select ingestion_timestamp, {r(_CONFIDENCE, 3)} as confidence_score from scored
      where validation_status <> 'FAILED') group by 1, 2)
  where d >= {AS_OF} - """

_MATRIX = f"""(select record_id, drug_name, manufacturer, drug_category, risk_category,
  safety_rating, {r('adverse_event_rate', 4)} as adverse_event_rate,
  {r('supply_risk_score', 3)} as supply_risk_score, patent_status,
  {r('predicted_revenue', 2)} as predicted_revenue,
  case when {HIGH} and predicted_revenue > 100000 then 'CRITICAL_MONITOR'
    when {HIGH} then 'HIGH_RISK' when {EXPIRING} then 'PATENT_RISK'
    when supply_risk_score > 0.5e0 then 'SUPPLY_RISK' else 'NORMAL' end as monitoring_status
  from enriched)"""

_EXECUTIVE = f"""select count(distinct drug_name) as total_drugs,
  count(distinct manufacturer) as total_manufacturers,
  count(distinct drug_category) as total_categories,
  {total('predicted_revenue', 2)} as total_predicted_revenue,
  {mean('efficacy_score', 3)} as avg_efficacy_score,
  {mean('safety_score', 3)} as avg_safety_score,
  {n_if(HIGH)} as high_risk_drugs, {n_if(EXPIRING)} as patent_expiring_soon,
  {n_if("market_position = 'LEADER'")} as market_leaders,
  '2001-06-01 00:00:00' as report_timestamp from enriched"""

ORACLES |= {
    "vw_01_data_quality_summary": over("scored", _QUALITY_BY_DAY),
    "vw_02_common_errors": over("scored", _ERRORS),
    "vw_03_market_analysis": over(
        "enriched",
        f"""select drug_category, region, count(distinct drug_name) as drug_count,
          {mean('price_usd', 2)} as avg_price,
          {total('predicted_revenue', 2)} as total_predicted_revenue,
          {mean('demand_score', 3)} as avg_demand_score,
          {n_if(HIGH)} as high_risk_count,
          {top_list("drug_name || '/' || market_position", 'rn', 5)} as top_drugs
          from {_TOP_SHARE.format(by='drug_category, region')} group by drug_category, region""",
    ),
    "vw_04_stage_performance": over(
        "enriched",
        f"""select development_stage, count(*) as drug_count,
          {mean('efficacy_score', 3)} as avg_efficacy, {mean('safety_score', 3)} as avg_safety,
          {n_if(EXPIRING)} as patent_expiring_soon,
          {mean('confidence_score', 3)} as avg_confidence
          from enriched group by development_stage""",
    ),
    "vw_05_risk_analysis": over(
        "enriched",
        f"""select risk_category, safety_rating, count(*) as drug_count,
          {mean('adverse_event_rate', 4)} as avg_adverse_rate,
          {mean('supply_risk_score', 3)} as avg_supply_risk,
          {top_list('drug_name', 'rn', 10)} as highest_risk_drugs
          from {_TOP_RATE} group by risk_category, safety_rating""",
    ),
    "vw_06_stage_monitor": over(
        "scored",
        f"select *, '2001-06-01 00:00:00' as last_updated from ({_MONITOR} 30)",
    ),
    "vw_07_market_intelligence": over(
        "enriched",
        f"""select * replace ({r('market_share_pct', 6)} as market_share_pct)
          from {_INTELLIGENCE}""",
    ),
    "vw_08_drug_risk_matrix": over("enriched", f"select * from {_MATRIX}"),
    "vw_09_executive_summary": over("enriched", _EXECUTIVE),
}

# --- reports --------------------------------------------------------------------


def _top_revenue(columns: str, k: int) -> str:
    return over(
        "enriched",
        f"""select {columns} from enriched
          order by enriched.predicted_revenue desc nulls last, record_id limit {k}""",
    )


_REVENUE = f"{r('predicted_revenue', 2)} as predicted_revenue"
_DEMAND_3 = f"{r('demand_score', 3)} as demand_score"

ORACLES |= {
    "dq_01_executive_summary": over("enriched", _EXECUTIVE),
    "dq_02_recent_stages": over("scored", f"{_MONITOR} 7"),
    "dq_03_top_revenue": _top_revenue(
        f"""drug_name, drug_category, manufacturer, market_position, {_REVENUE}, {_DEMAND_3},
        risk_category""",
        10,
    ),
    "dq_04_share_by_category": over(
        "enriched",
        f"""select drug_category, total_drugs, total_revenue,
          {r('market_share_pct * 100', 2)} as market_share_pct, avg_efficacy, avg_safety
          from {_INTELLIGENCE}""",
    ),
    "dq_05_high_risk_alert": over(
        "enriched",
        f"""select drug_name, manufacturer, risk_category, safety_rating, adverse_event_rate,
          monitoring_status from {_MATRIX}
          where monitoring_status in ('CRITICAL_MONITOR', 'HIGH_RISK')
          order by adverse_event_rate desc nulls last, record_id limit 20""",
    ),
    "dq_06_quality_trend": over(
        "scored",
        f"""select validation_date, total_records, passed_records, avg_quality_score, pass_rate
          from ({_QUALITY_BY_DAY}) order by validation_date desc limit 7""",
    ),
    "dq_07_regional_performance": over(
        "enriched",
        f"""select region, count(distinct drug_name) as drug_count,
          {total('predicted_revenue', 2)} as total_revenue,
          {mean('efficacy_score', 3)} as avg_efficacy,
          {mean('supply_risk_score', 3)} as avg_supply_risk from enriched group by region""",
    ),
    "dq_08_stages_today": over(
        "scored",
        f"""select stage, record_count, {r('avg_quality_score', 3)} as quality_score,
          {r('pass_rate * 100', 1)} as pass_rate_pct from ({_MONITOR} 30)
          where process_date = '2001-06-01'""",
    ),
    "dq_09_top_five": _top_revenue(
        f"drug_name, drug_category, {r('predicted_revenue', 2)} as revenue, market_position", 5
    ),
    "dq_10_enrichment_check": over(
        "enriched",
        f"""select count(*) as total_enriched_records,
          count(distinct drug_category) as categories,
          count(distinct therapeutic_class) as therapeutic_classes,
          count(distinct region) as regions, {mean('confidence_score', 3)} as avg_confidence,
          {total('predicted_revenue', 2)} as total_predicted_revenue from enriched""",
    ),
    "dq_11_top_enrichment": _top_revenue(
        f"drug_name, drug_category, market_position, {_REVENUE}, {_DEMAND_3}, risk_category", 10
    ),
    "dq_12_validation_today": over(
        "scored",
        f"""select '2001-06-01' as validation_date, {_TOTALS},
          {mean('quality_score', 3)} as avg_quality_score,
          {share("validation_status = 'PASSED'", 3)} as pass_rate from scored""",
    ),
    "dq_13_top_errors": over("scored", f"{_ERRORS} order by error_count desc, error limit 10"),
    "dq_14_raw_check_dated": over(
        "raw",
        f"""select count(*) as total_records, count(distinct drug_name) as unique_drugs,
          count(distinct manufacturer) as unique_manufacturers,
          count(distinct drug_category) as unique_categories from raw
          where cast(ingestion_timestamp as date) = {AS_OF}""",
    ),
    "dq_14_raw_check": over(
        "raw",
        """select count(*) as total_records, count(distinct drug_name) as unique_drugs,
          count(distinct manufacturer) as unique_manufacturers,
          count(distinct drug_category) as unique_categories from raw""",
    ),
}

# --- streaming ------------------------------------------------------------------
# Every window of the table is there, the last ones too.


def windows(length: str, columns: str, where: str = "true") -> str:
    start = f"time_bucket(interval '{length}', ts)"
    return f"""select {stamp(start)} as window_start,
      {stamp(f"{start} + interval '{length}'")} as window_end, {columns}
      from events where {where} group by 1, 2"""


_SCORES = windows("300 seconds", f"{mean('value / 100', 6)} as mean")

ORACLES |= {
    "st_01_ingestion_events": f"""select event_id,
        case when ok then 'events/' || event_id end as file_path,
        case when ok then event_id * 7 end as file_size,
        case when ok then cast(floor(epoch(ts)) as bigint) end as timestamp,
        case when ok then 'user-' || user_id end as source_system,
        case when ok then event_type end as data_type,
        case when ok then priority end as priority,
        case when ok and priority <> 'URGENT' then 'accepted' else 'rejected' end as outcome,
        case when not ok then 'not json' when priority = 'URGENT' then
          '{{"file_path":"events/' || event_id || '","file_size":' || (event_id * 7)
          || ',"timestamp":' || cast(floor(epoch(ts)) as bigint)
          || ',"source_system":"user-' || user_id || '","data_type":"' || event_type
          || '","priority":"URGENT"}}' end as rejected_body
        from (select *, event_id % 11 <> 0 as ok,
          {pick(('LOW', 'MEDIUM', 'HIGH', 'CRITICAL', 'URGENT'), 'event_id')} as priority
          from events)""",
    "st_02_deduplicated_events": "select distinct event_id, event_type, value from events",
    "st_03_daily_within_retention": windows(
        "1 day", f"count(*) as events, {total('value', 2)} as total"
    ),
    "st_04_volume": windows(
        "60 seconds", f"count(*) as events, {r('count(*) / 60', 6)} as per_second"
    ),
    "st_05_quality_5min": _SCORES,
    "st_06_quality_incidents": f"""with low as (
        select cast(window_start as timestamp) as s, cast(window_end as timestamp) as e, mean
        from ({_SCORES}) where mean < 0.8e0),
      marked as (select *, case when s - lag(s) over (order by s) <= interval '1800 seconds'
        then 0 else 1 end as opens from low),
      numbered as (select *, sum(opens) over (order by s) as incident from marked)
      select {stamp('min(s)')} as opened_at, {stamp('max(e)')} as last_breach_end,
        count(*) as windows, min(mean) as worst_mean from numbered group by incident""",
    "st_07_bytes_alert": f"""select * from (
        {windows('300 seconds', f"{mean('value * 268435456e0', 0)} as mean")})
        where mean > 10737418240""",
    "st_08_error_gauge": windows(
        "300 seconds",
        """count(*) as error_events,
          cast(sum(try_cast(json_extract_string(props, '$.k') as bigint)) as bigint)
            as error_count""",
        where="event_type = 'error'",
    ),
    "st_09_retention": over(
        "raw",
        f"""select {day('ingestion_timestamp')} as ingest_date, count(*) as records from raw
          where cast(ingestion_timestamp as date) >= {AS_OF} - 90 group by 1""",
    ),
    "st_10_streaming_validation": over(
        "scored",
        """select record_id, validation_status, quality_score,
          array_to_string(validation_errors, '|') as validation_errors from scored""",
    ),
}

ORACLES["st_06_live_incidents"] = f"""with low as (
    select event_type, time_bucket(interval '300 seconds', ts) as s, {mean('value / 100', 6)} as mean
    from events group by all having mean < 0.8e0),
  marked as (select *, case when s - lag(s) over w <= interval '1800 seconds' then 0 else 1 end as opens
    from low window w as (partition by event_type order by s)),
  numbered as (select *, sum(opens) over (partition by event_type order by s) as incident from marked)
  select event_type, {stamp('min(s)')} as opened_at, {stamp("max(s) + interval '300 seconds'")} as last_breach_end,
    count(*) as windows, min(mean) as worst_mean from numbered group by event_type, incident"""
ORACLES["st_03_late_events"] = """with t as (select *, event_id % 4 as batch,
    case event_type when 'error' then 'data-quality-alerts' when 'signup' then 'pipeline-notifications'
      when 'view' then 'old-topic' else 'data-processing' end as topic from events),
  kept as (select *, case topic when 'data-quality-alerts' then interval '1 day'
    when 'pipeline-notifications' then interval '3 days' else interval '7 days' end as keeps
    from t where topic <> 'old-topic'),
  judged as (select k.event_id, k.topic, case when k.ts < max(m.ts) - any_value(k.keeps)
      then 'older than its topic keeps' else '' end as late_reason
    from kept k left join
      (select topic, batch, max(ts) as ts from kept group by topic, batch) m
      on m.topic = k.topic and m.batch < k.batch
    group by k.event_id, k.topic, k.ts, k.batch)
  select * from judged union all
  select event_id, topic, 'unknown topic' from t where topic = 'old-topic'"""

ORACLES["st_10_streaming_tiers"] = over(
    "batch",
    """, snaps as (
      select date '1996-01-01' as valid_from, quantile_disc(price_usd, [0.25, 0.5, 0.75]) as q
      from batch where patient_count % 3 = 0 union all
      select date '1998-06-15', quantile_disc(price_usd, [0.25, 0.5, 0.75])
      from batch where patient_count % 5 = 0 union all
      select date '2000-03-01', quantile_disc(price_usd, [0.25, 0.5, 0.75]) from batch),
    picked as (select s.record_id, s.price_usd, max(n.valid_from) as valid_from
      from scored s left join snaps n on n.valid_from <= cast(s.ingestion_timestamp as date)
      group by s.record_id, s.price_usd)
    select record_id, case when q is null then null when price_usd < q[1] then 'BUDGET'
        when price_usd < q[2] then 'STANDARD' when price_usd < q[3] then 'PREMIUM' else 'LUXURY' end as price_tier,
      strftime(p.valid_from, '%Y-%m-%d') as snapshot_from
    from picked p left join snaps on snaps.valid_from = p.valid_from""",
)

# --- contract marts -------------------------------------------------------------

BRONZE = f"""bronze as (select
  lpad(cast(l_suppkey % 100000 as varchar), 5, '0') || '-'
    || lpad(cast(l_partkey % 1000 as varchar), 3, '0') || '-'
    || lpad(cast(l_linenumber % 100 as varchar), 2, '0') as ndc_number,
  s_name as labeler_name,
  p_name || ' ' || {FORM} || 's' as product_name,
  case when l_partkey % 13 <> 0 then p_name end as generic_name,
  {FORM} as dosage_form,
  {ROUTE} as route,
  {STRENGTH} as strength,
  case when l_orderkey % 29 <> 0 then {r('l_extendedprice / l_quantity', 2)} end as unit_price,
  cast(trunc(l_quantity) as bigint) as package_size,
  {day('l_shipdate')} as market_date
  from {LINES})"""

STANDARD = r"""standard as (select *,
  sha256(ndc_number || '|' || labeler_name) as drug_id,
  lpad(regexp_replace(ndc_number, '[^0-9]', '', 'g'), 11, '0') as ndc_number_clean,
  regexp_replace(upper(trim(labeler_name)), '[^A-Z0-9\s\-]', '', 'g') as labeler_name_clean,
  regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(
      upper(coalesce(generic_name, product_name)), '[^A-Z0-9\s\-]', '', 'g'), '\s+', ' ', 'g')),
    '\s+(TABLET|CAPSULE|INJECTION|SOLUTION|CREAM|GEL)S?$', ''), '\s+(MG|MCG|ML|GM?)$', '')
    as generic_name_standardized
  from bronze)"""

SORTED = rf"""sorted as (select *,
  case when amount is null then 'UNKNOWN' when amount < 100 then 'LOW'
    when amount < 300 then 'MEDIUM' else 'HIGH' end as dosage_category,
  case when unit_price < 1000 then 'BUDGET' when unit_price < 2000 then 'STANDARD'
    else 'PREMIUM' end as price_tier,
  case when unit_price >= 2000 then 'SPECIALTY' when route = 'Injection' then 'HOSPITAL'
    else 'CONSUMER' end as market_segment,
  case when filled / 5e0 < 0.5 then 'HIGH' when filled / 5e0 < 0.9 then 'MEDIUM'
    else 'LOW' end as risk_category,
  filled / 5e0 as data_quality_score
  from (select *,
    try_cast(nullif(regexp_extract(strength, '(\d+\.?\d*)', 1), '') as double) as amount,
    (generic_name is not null)::int + (dosage_form is not null)::int + (route is not null)::int
      + (strength is not null)::int + (unit_price is not null)::int as filled
    from standard))"""

RIVALS = f"""rivals as (select generic_name_standardized,
  {r('1e0 - sum(n * n) / (cast(sum(n) as double) * cast(sum(n) as double))', 6)}
    as competition_index
  from (select generic_name_standardized, labeler_name_clean, cast(count(*) as double) as n
    from standard group by all) group by generic_name_standardized)"""

SILVER = f"""silver as (select *,
  {pick(('Alpha', 'Beta', 'Gamma'), 'length(generic_name_standardized)')} as therapeutic_class,
  'APPROVED' as fda_approval_status,
  {r("data_quality_score * 0.5e0 + (case when dosage_category = 'UNKNOWN' then 0e0 else 0.5e0 end)", 3)}
    as enrichment_confidence,
  substr(market_date, 1, 7) as analysis_date
  from sorted join rivals using (generic_name_standardized))"""


def marts(*tables: str, body: str) -> str:
    return "with " + ",\n".join((BRONZE, *tables)) + "\n" + body


_GOLD_BY = "analysis_date, therapeutic_class, market_segment, price_tier"
_SERIES = "therapeutic_class, market_segment, price_tier"
_MILLIS = "epoch_ms(timestamp '2001-06-01 00:00:00')"
_TREND = f"""case when p > lag(p) over w then 'UP' when p < lag(p) over w then 'DOWN'
  else 'STABLE' end as trend_direction"""

ORACLES |= {
    "src_05_bronze_sample": marts(
        body=f"""select *, {_MILLIS} as ingestion_timestamp, '1' as data_version from bronze"""
    ),
    "ct_01_standard_forms": marts(
        STANDARD,
        body="""select drug_id, ndc_number_clean, labeler_name_clean, generic_name_standardized
          from standard""",
    ),
    "ct_02_categories": marts(
        STANDARD, SORTED,
        body="""select dosage_category, price_tier, market_segment, risk_category,
          data_quality_score, count(*) as items from sorted group by all""",
    ),
    "ct_03_silver": marts(
        STANDARD, SORTED, RIVALS, SILVER,
        body=f"""select drug_id, ndc_number_clean, labeler_name_clean, generic_name_standardized,
          therapeutic_class, dosage_category, price_tier, risk_category, market_segment,
          competition_index, fda_approval_status, enrichment_confidence, data_quality_score,
          {_MILLIS} as processing_timestamp, 'v1.0.0' as enrichment_version from silver""",
    ),
    "ct_04_gold": marts(
        STANDARD, SORTED, RIVALS, SILVER,
        body=f"""select {_GOLD_BY}, drug_count, avg_price, median_price, price_std_dev,
          {r('100 * drug_count / sum(drug_count) over (partition by analysis_date)', 4)}
            as market_share_pct,
          avg_competition_index, high_risk_count, quality_score_avg, {_TREND},
          {_MILLIS} as analysis_timestamp
          from (select {_GOLD_BY}, count(*) as drug_count, {mean('unit_price', 4)} as avg_price,
            {mean('unit_price', 12)} as p,
            {r('median(unit_price)', 4)} as median_price,
            {r('stddev_samp(unit_price)', 3)} as price_std_dev,
            {mean('competition_index', 6)} as avg_competition_index,
            {n_if("risk_category = 'HIGH'")} as high_risk_count,
            {mean('data_quality_score', 6)} as quality_score_avg
            from silver group by {_GOLD_BY})
          window w as (partition by {_SERIES} order by analysis_date)""",
    ),
    "wn_05_price_trend": marts(
        STANDARD, SORTED, RIVALS, SILVER,
        body=f"""select {_GOLD_BY}, {_TREND}
          from (select {_GOLD_BY}, {mean('unit_price', 12)} as p from silver group by {_GOLD_BY})
          window w as (partition by {_SERIES} order by analysis_date)""",
    ),
    "ag_12_group_medians": marts(
        STANDARD,
        body=f"""select generic_name_standardized, {r('median(unit_price)', 4)} as median_price
          from standard where unit_price is not null group by generic_name_standardized""",
    ),
}
