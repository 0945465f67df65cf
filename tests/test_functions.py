import pytest
from pyspark.sql import functions as F

from rxstrata.functions import classifiers as c
from rxstrata.functions import columns, text


def one(spark, schema, values, column):
    table = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r.out for r in table.select("i", column.alias("out")).orderBy("i").collect()]


def test_file_drug_name(spark):
    names = [("Paracetamol-500MG",), ("ibuprofen 200mg",), (" \tAspirin-81mg\n",), (None,), ("",), ("  ",)]
    assert one(spark, "n string", names, text.file_drug_name(F.col("n"))) == [
        "PARACETAMOL 500", "IBUPROFEN 200", "ASPIRIN 81", "", "", "",
    ]


PRODUCT_NAMES = [
    ("Aspirin  500 mg Tablets", "ASPIRIN 500"),
    ("  cold-ex (night) GEL ", "COLD-EX NIGHT"),
    ("Ibuprofen 200 mcg", "IBUPROFEN 200"),
    ("tablet", "TABLET"),
    ("Syrup G", "SYRUP"),
    ("", None),
    (None, None),
]


def test_product_name(spark):
    names = [(n,) for n, _ in PRODUCT_NAMES]
    want = [w for _, w in PRODUCT_NAMES]
    assert one(spark, "n string", names, text.product_name(F.col("n"))) == want
    c.register_sql_functions(spark)
    assert one(spark, "n string", names, F.expr("standardize_drug_name(n)")) == want


STRENGTHS = [
    ("500 MG", (500.0, "mg")),
    ("2.5mcg", (2.5, "mcg")),
    ("1.2.3 ml", (1.2, "ml")),
    ("10 %", (10.0, "%")),
    ("7 drops", (7.0, None)),
    ("5.", (5.0, None)),
    ("none", (None, None)),
    ("", (None, None)),
    (None, (None, None)),
]


def test_label_strength(spark):
    texts, want = [(t,) for t, _ in STRENGTHS], [w for _, w in STRENGTHS]
    c.register_sql_functions(spark)
    for column in (text.label_strength(F.col("s")), F.expr("extract_strength(s)")):
        assert [tuple(r) for r in one(spark, "s string", texts, column)] == want


def test_drug_risk(spark):
    values = [
        (0.11, 0.9, 500), (0.0, 0.49, 500), (0.1, 0.9, 500), (0.05, 0.69, 500), (0.05, 0.7, 99),
        (0.05, 0.7, 100), (None, None, None), (None, 0.4, None),
    ]
    want = ["HIGH", "HIGH", "MEDIUM", "MEDIUM", "UNKNOWN", "LOW", "LOW", "HIGH"]
    c.register_sql_functions(spark)
    native = c.drug_risk(F.col("r"), F.col("s"), F.col("p"))
    for column in (native, F.expr("classify_drug_risk(r, s, p)")):
        assert one(spark, "r double, s double, p long", values, column) == want


def test_fixed_price_tier(spark):
    prices = [(None,), (9.99,), (10.0,), (99.99,), (100.0,), (999.99,), (1000.0,)]
    want = ["UNKNOWN", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "PREMIUM"]
    c.register_sql_functions(spark)
    for column in (c.price_tier_fixed(F.col("p")), F.expr("classify_price_tier(p)")):
        assert one(spark, "p double", prices, column) == want


def test_fixed_market_position(spark):
    values = [
        (0.31, 0.0, 99.0), (0.3, 0.71, 99.0), (0.3, 0.7, 49.0), (0.1, 0.81, 50.0), (0.1, 0.8, 50.0),
        (None, None, None),
    ]
    want = ["LEADER", "CHALLENGER", "VALUE_PLAYER", "INNOVATOR", "FOLLOWER", "FOLLOWER"]
    c.register_sql_functions(spark)
    native = c.market_position_fixed(F.col("m"), F.col("e"), F.col("p"))
    for column in (native, F.expr("calculate_market_position(m, e, p)")):
        assert one(spark, "m double, e double, p double", values, column) == want


def test_record_quality(spark):
    schema = (
        "drug_name string, manufacturer string, drug_category string, price double, "
        "efficacy_score double, safety_score double"
    )
    values = [
        ("a", "b", "c", 1.0, 0.5, 0.5), ("", None, "c", 10001.0, 1.0, -0.1),
        (None,) * 6, ("a", "b", "c", 0.0, 0.0, 1.0),
    ]
    record = F.struct(*[f.split()[0] for f in schema.split(", ")])
    c.register_sql_functions(spark)
    for column in (
        c.record_quality(record),
        F.expr(
            "calculate_quality_score(struct(drug_name, manufacturer, drug_category, price, "
            "efficacy_score, safety_score))"
        ),
    ):
        assert one(spark, schema, values, column) == [1.0, 0.35, 0.0, 1.0]


def test_exact_mean_sees_ties_in_any_order(spark):
    values = [0.95] * 10 + [0.85] * 6 + [0.55, 0.45] * 2 + [0.9] * 4
    want = spark.createDataFrame([(v,) for v in values], "v double").agg(
        columns.exact_mean("v", 3)
    ).first()[0]
    for order in (sorted(values), sorted(values, reverse=True)):
        table = spark.createDataFrame([(v,) for v in order], "v double").repartition(7)
        assert table.agg(columns.exact_mean("v", 3)).first()[0] == want


def test_mean_rounds_half_up(spark):
    table = spark.createDataFrame([(0.0185,), (0.0185,), (0.0185,)], "v double")
    assert table.agg(columns.exact_mean("v", 3)).first()[0] == 0.019


def test_ratio_of_nothing_and_of_huge_sums(spark):
    row = spark.range(1).select(
        columns.ratio(F.lit(1), F.lit(0)).alias("none"),
        columns.ratio(F.lit("123456789012345678901234567890").cast("decimal(38,8)"), F.lit(10), 2)
        .alias("huge"),
        columns.ratio(F.lit("30000000000000000000000000").cast("decimal(38,12)"), F.lit(20)).alias("large"),
    ).first()
    assert row.none is None and row.huge is None and row.large == 1.5e24


def test_lookup_of_missing_and_null(spark):
    column = columns.lookup(F.col("k"), {"a": "A"}, "other")
    assert one(spark, "k string", [("a",), ("b",), (None,)], column) == ["A", "other", "other"]
