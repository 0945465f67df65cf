"""Small literal tables."""

import datetime as dt

from rxstrata import schemas

DAY = dt.date(2001, 6, 1)

GOOD = {
    "record_id": "r",
    "drug_name": "Alphacor XR",
    "drug_code": "DRG-1",
    "manufacturer": "Maker",
    "drug_category": "Cardiovascular",
    "active_ingredient": "Alphacor-Active",
    "strength": "50 mg",
    "dosage_form": "Tablet",
    "route_of_administration": "Oral",
    "therapeutic_class": "Cardiovascular-Alpha",
    "approval_date": dt.date(2000, 1, 1),
    "patent_expiry_date": dt.date(2010, 1, 1),
    "price": 100.0,
    "currency": "USD",
    "country": "USA",
    "clinical_trial_phase": "Approved",
    "efficacy_score": 0.9,
    "safety_score": 0.9,
    "patient_count": 1000,
    "adverse_events": 10,
    "market_share": 0.2,
    "competitor_drugs": "A, B",
    "ingestion_timestamp": dt.datetime(2001, 6, 1, 12),
    "source_file": "f",
    "raw_data": None,
}


def raw_rows(spark, *changes):
    """One good raw record per set of changes, numbered in ``record_id``."""
    rows = [{**GOOD, "record_id": str(i), **change} for i, change in enumerate(changes)]
    return spark.createDataFrame(
        [tuple(row[name] for name in schemas.RAW.names) for row in rows], schemas.RAW
    )


def by_id(df, column):
    return [row[column] for row in df.orderBy(df.record_id.cast("int")).collect()]
