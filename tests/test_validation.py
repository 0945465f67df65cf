import datetime as dt
import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import DAY, raw_rows, by_id
from rxstrata import fixed_values as V
from rxstrata import schemas
from rxstrata.operators import validation as va


def check(spark, step, field, values, column, *args):
    rows = raw_rows(spark, *[{field: value} for value in values])
    return by_id(step(rows, *args), column)


def test_name_length_bounds(spark):
    names = ["ab", "abc", "a" * 99, "a" * 100, None, "", "!!abc!!", "é" * 5]
    flags = check(spark, va.check_drug_name, "drug_name", names, "is_drug_name_valid")
    assert flags == [False, True, True, False, False, False, True, False]


def test_name_upper_first_or_capitals_only(spark):
    rows = raw_rows(spark, {"drug_name": "Aspirinol XR"}, {"drug_name": "Aspirinol"})
    assert by_id(va.check_drug_name(rows), "drug_name_clean") == ["ASPIRINOL XR", "ASPIRINOL"]
    capitals = va.check_drug_name(rows, strip_before_upper=True)
    assert by_id(capitals, "drug_name_clean") == ["A XR", "A"]
    assert by_id(capitals, "is_drug_name_valid") == [True, False]


def test_strength(spark):
    texts = ["", "500", "2.5 mg", "50 %", "1.2.3", None, "n/a", "10 IU", "0 mg", "7 kg"]
    rows = va.parse_strength(raw_rows(spark, *[{"strength": t} for t in texts]))
    assert by_id(rows, "strength_numeric") == [
        None, 500.0, 2.5, 50.0, 1.2, None, None, 10.0, 0.0, 7.0,
    ]
    assert by_id(rows, "strength_unit")[:4] == ["", "0", "mg", "0"]
    assert by_id(rows, "is_strength_valid") == [
        False, False, True, False, False, False, False, True, False, False,
    ]


def test_countries(spark):
    names = ["USA", "United Kingdom", "usa", "Brazil", None]
    codes = check(spark, va.code_countries, "country", names, "country_code")
    assert codes == ["US", "GB", "usa", "Brazil", None]


def test_countries_with_own_mapping(spark):
    mapping = spark.createDataFrame([("Brazil", "BR")], "country_name string, code string")
    rows = raw_rows(spark, {"country": "Brazil"}, {"country": "USA"})
    assert by_id(va.code_countries(rows, mapping), "country_code") == ["BR", "USA"]


def test_adverse_event_rate(spark):
    pairs = [(100, 5), (0, 5), (100, -1), (3, 1), (10, 20), (None, 1), (10, None)]
    rows = raw_rows(spark, *[{"patient_count": p, "adverse_events": e} for p, e in pairs])
    rated = va.rate_adverse_events(rows)
    assert by_id(rated, "adverse_event_rate") == [0.05, None, None, 0.3333, 2.0, None, None]
    assert by_id(rated, "is_adverse_rate_valid") == [True, True, True, True, False, True, True]


def test_price_bounds_and_rates(spark):
    prices = [0.0, 0.01, 99999.99, 100000.0, None, -1.0]
    flags = check(spark, va.price_in_usd, "price", prices, "is_price_valid")
    assert flags == [False, True, True, False, False, False]
    rates = spark.createDataFrame([("EUR", 2.0)], "currency_code string, usd_rate double")
    rows = raw_rows(spark, {"currency": "EUR"}, {"currency": "USD"}, {"currency": None})
    assert by_id(va.price_in_usd(rows, rates), "price_usd") == [200.0, 100.0, 100.0]


def test_dates(spark):
    approvals = [DAY, DAY + dt.timedelta(1), None]
    got = check(spark, va.check_dates, "approval_date", approvals, "is_approval_date_valid", DAY)
    assert got == [True, False, False]
    patents = [DAY - dt.timedelta(365), DAY - dt.timedelta(364), None]
    got = check(spark, va.check_dates, "patent_expiry_date", patents, "is_patent_date_valid", DAY)
    assert got == [False, True, True]


def test_scores(spark):
    scores = [0.0, 1.0, -0.001, 1.001, None]
    want = [True, True, False, False, True]
    assert check(spark, va.check_scores, "efficacy_score", scores, "is_efficacy_valid") == want
    assert check(spark, va.check_scores, "safety_score", scores, "is_safety_valid") == want


def test_competitors(spark):
    lists = [None, "", "A", "A, B, C"]
    assert check(spark, va.count_competitors, "competitor_drugs", lists, "competitor_count") == [
        0, 1, 1, 3,
    ]


def test_score_status_and_errors_for_all_flag_sets(spark):
    flags = [flag for flag, _, _ in V.QUALITY_CHECKS]
    sets = list(itertools.product([True, False], repeat=len(flags)))
    table = spark.createDataFrame(sets, ", ".join(f"{f} boolean" for f in flags))
    for row in va.list_errors(va.score_quality(table)).collect():
        points = sum(round(w * 100) for f, w, _ in V.QUALITY_CHECKS if row[f])
        assert row.quality_score == points / 100
        status = "PASSED" if points >= 80 else "WARNING" if points >= 60 else "FAILED"
        assert row.validation_status == status
        assert row.validation_errors == [m for f, _, m in V.QUALITY_CHECKS if not row[f]]


def test_validate_columns_and_stamp(spark):
    rows = va.validate(raw_rows(spark, {}), DAY)
    assert rows.columns == schemas.VALIDATED.names
    row = rows.first()
    assert (row.quality_score, row.validation_status, row.validation_errors) == (1.0, "PASSED", [])
    assert row.validation_timestamp == dt.datetime(2001, 6, 1)


def test_record_with_every_error(spark):
    bad = {
        "drug_name": "x", "strength": "?", "adverse_events": 2000, "price": 0.0,
        "approval_date": None, "patent_expiry_date": dt.date(1990, 1, 1),
        "efficacy_score": 2.0, "safety_score": -1.0,
    }
    row = va.validate(raw_rows(spark, bad), DAY).first()
    assert row.quality_score == 0.0 and row.validation_status == "FAILED"
    assert row.validation_errors == [m for _, _, m in V.QUALITY_CHECKS]


@pytest.mark.parametrize("name", schemas.RAW.names[1:])
def test_null_in_any_column(spark, name):
    row = va.validate(raw_rows(spark, {name: None}), DAY).first()
    assert 0 <= row.quality_score <= 1 and row.validation_errors is not None


def test_empty_table(spark):
    assert va.validate(raw_rows(spark, {}).where("false"), DAY).count() == 0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.fixed_dictionaries(
            {
                "drug_name": st.one_of(st.none(), st.text(max_size=120)),
                "strength": st.one_of(st.none(), st.text(max_size=12)),
                "price": st.one_of(st.none(), st.floats(-1e6, 1e6)),
                "efficacy_score": st.one_of(st.none(), st.floats(-2, 2)),
                "patient_count": st.one_of(st.none(), st.integers(-5, 1000)),
            }
        ),
        min_size=1,
        max_size=20,
    )
)
def test_score_and_errors_agree(spark, changes):
    rows = va.validate(raw_rows(spark, *changes), DAY)
    clean = F.size("validation_errors") == 0
    assert rows.where(~F.col("quality_score").between(0, 1)).count() == 0
    assert rows.where(clean != (F.col("quality_score") == 1)).count() == 0
