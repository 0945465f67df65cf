import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import DAY, raw_rows
from rxstrata import fixed_values as V
from rxstrata import schemas, session
from rxstrata.functions.columns import exact_mean, exact_sum
from rxstrata.operators.lookup import attach
from rxstrata.operators.validation import price_in_usd, validate
from rxstrata.plans import marts, reports, runs
from rxstrata.sinks import layers, tables
from rxstrata.sources import files, generator
from rxstrata.sources.commerce import raw_records


@pytest.fixture
def store(spark, tmp_path):
    return runs.Store(spark, str(tmp_path))


def stamped(spark, *days):
    return raw_rows(
        spark,
        *[
            {"ingestion_timestamp": dt.datetime(2001, 6, d, 12), "strength": None if d % 2 else "5 mg"}
            for d in days
        ],
    )


def test_rewriting_a_date_leaves_the_others(spark, store):
    store.write("raw", stamped(spark, 1, 1, 2, 3))
    before = {r.ingest_date: r["count"] for r in store.read("raw").groupBy("ingest_date").count().collect()}
    store.write("raw", stamped(spark, 1, 1, 2, 3))
    store.write("raw", stamped(spark, 2))
    after = {r.ingest_date: r["count"] for r in store.read("raw").groupBy("ingest_date").count().collect()}
    assert before == after == {dt.date(2001, 6, 1): 2, dt.date(2001, 6, 2): 1, dt.date(2001, 6, 3): 1}


def test_date_filter_prunes_partitions(spark, store):
    store.write("raw", stamped(spark, 1, 2))
    plan = store.read("raw", DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_latest_snapshot_prunes_by_subquery(spark, store):
    store.write("raw", stamped(spark, 1, 2, 2))
    newest = files.latest_snapshot(store.read("raw"), schemas.LAYERS["raw"])
    assert newest.count() == 2
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "Subquery" in plan


def test_retention(spark, store):
    store.write("raw", stamped(spark, 1, 2, 3))
    kept = layers.within_retention(store.read("raw"), schemas.LAYERS["raw"], dt.date(2001, 6, 3), 1)
    assert kept.count() == 2


def test_runs_fill_every_layer_and_are_safe_to_repeat(spark, store):
    store.write("raw", stamped(spark, 1, 1, 1, 2))
    for _ in range(2):
        report = runs.run_validation(store, DAY).first()
        totals = runs.run_enrichment(store, DAY).first()
    assert (report.total_records, report.passed_pct) == (3, 100.0)
    assert totals.total_enriched == 3
    assert store.read("validated").count() == store.read("enriched").count() == 3
    assert store.read("summary").count() == 1
    metric = store.read("quality_metrics").collect()
    assert len(metric) == 1 and metric[0].status == "PASSED" and metric[0].metric_value == 1.0
    ledger = store.read("pipeline_runs").collect()
    assert sorted(r.pipeline_name for r in ledger) == ["enrichment"] * 2 + ["validation"] * 2
    assert {r.total_records for r in ledger} == {3} and len({r.run_id for r in ledger}) == 4


def day_counts(store):
    return {name: store.read(name, DAY).count() for name in ("validated", "enriched", "summary")}


BAD = {"drug_name": None, "price": -1.0, "strength": None, "approval_date": None, "efficacy_score": 7.0}


@pytest.mark.parametrize(
    "second, want",
    [
        ([{}], (1, 1, 1)),
        ([BAD], (1, 0, 0)),
        ([], (0, 0, 0)),
    ],
)
def test_a_second_run_leaves_only_its_rows(spark, store, second, want):
    """A day that shrinks, fails whole, or has become empty; other days stay."""
    runs.run_validation(store, dt.date(2001, 5, 31), raw_rows(spark, {}))
    runs.run_validation(store, DAY, raw_rows(spark, {}, {"country": "Brazil"}, {}))
    runs.run_enrichment(store, dt.date(2001, 5, 31))
    runs.run_enrichment(store, DAY)
    assert day_counts(store)["validated"] == 3
    raw = raw_rows(spark, *second) if second else raw_rows(spark, {}).where("false")
    report = runs.run_validation(store, DAY, raw).first()
    runs.run_enrichment(store, DAY)
    assert tuple(day_counts(store).values()) == want and report.total_records == want[0]
    metric = store.read("quality_metrics", DAY).collect()
    assert [m.details for m in metric] == [f"Processed {want[0]} records"]
    assert store.read("validated").count() == want[0] + 1 and store.read("enriched").count() == want[1] + 1


def test_a_dying_write_leaves_the_stored_day(spark, store, monkeypatch):
    """In the job, and between the two renames."""
    store.write("raw", stamped(spark, 1, 1, 2), None)
    bad = stamped(spark, 1).withColumn("price", F.expr("raise_error('dies')").cast("double"))
    for day in (None, DAY):
        with pytest.raises(Exception, match="dies"):
            store.write("raw", bad, day)
        assert store.read("raw").count() == 3 and store.read("raw", DAY).count() == 2
    moved = layers.file_system
    taken = []

    def without_new(spark, path):
        fs, at = moved(spark, path)
        if "_new-" in path and path.count("=") and not taken:
            taken.append(path)
            at = moved(spark, path + "-gone")[1]
        return fs, at

    monkeypatch.setattr(layers, "file_system", without_new)
    with pytest.raises(OSError, match="cannot move the new rows"):
        store.write("raw", stamped(spark, 1), DAY)
    assert store.read("raw", DAY).count() == 2
    fs, at = moved(spark, store.path("raw"))
    assert all(s.getPath().getName().startswith(("ingest_date=", "_SUCCESS")) for s in fs.listStatus(at))
    assert store.write("raw", stamped(spark, 1, 3)) == [DAY, dt.date(2001, 6, 3)]
    assert store.read("raw", DAY).count() == 1


def test_totals_of_a_run_cover_its_dates(spark, store):
    """Two runs stamped by the records: the second counts nothing of the first."""
    at = F.col("ingestion_timestamp")
    for days, want in (((1, 1, 1, 1), 4), ((2, 2, 3), 3)):
        raw = stamped(spark, *days).withColumn("strength", F.lit("5 mg"))
        report = runs.run_validation(store, dt.date(2001, 6, days[0]), raw, at).first()
        assert report.total_records == want
        validated = store.read("validated").where(F.day("validation_date").isin(*days))
        totals = runs.run_enrichment(store, dt.date(2001, 6, days[0]), validated, F.col("validation_timestamp")).first()
        assert totals.total_enriched == want
        summary = store.read("summary", dt.date(2001, 6, days[0]))
        assert summary.agg(F.sum("total_drugs")).first()[0] == want
        metric = store.read("quality_metrics", dt.date(2001, 6, days[0])).first()
        assert metric.details == f"Processed {want} records"
    assert sorted(r.total_records for r in store.read("pipeline_runs").collect()) == [3, 3, 4, 4]
    assert store.read("validated").count() == 7
    undated = stamped(spark, 1).withColumn("ingestion_timestamp", F.lit(None).cast("timestamp"))
    assert runs.run_validation(store, DAY, undated, at).first().total_records == 1


def test_a_failing_run_is_in_the_ledger(spark, store):
    with pytest.raises(Exception, match="no_such"):
        runs.run_validation(store, DAY, raw_rows(spark, {}).withColumn("price", F.expr("raise_error('no_such')").cast("double")))
    row = store.read("pipeline_runs").first()
    assert row.status == "FAILED" and "no_such" in row.error_details and row.total_records is None


def test_runs_leave_only_their_layers(spark, store):
    fs, at = session.file_system(spark, session.shared_dir(spark))
    folder = f"{session.shared_dir(spark)}/{spark.sparkContext.applicationId}"

    def staged():
        fs, at = session.file_system(spark, folder)
        return {s.getPath().getName() for s in fs.listStatus(at)} if fs.exists(at) else set()

    before = staged()
    runs.run_validation(store, DAY, raw_rows(spark, {}, {}))
    runs.run_enrichment(store, DAY)
    assert staged() == before
    with pytest.raises(ZeroDivisionError), session.scratch(spark):
        session.stage(raw_rows(spark, {}), "left")
        raise ZeroDivisionError
    assert staged() == before


def test_values_out_of_range_neither_stop_nor_bend_a_run(spark, store):
    odd = [{"price": x} for x in (1e21, float("inf"), float("-inf"), float("nan"), 1e-9, None)]
    raw = raw_rows(spark, {"price": 2.0}, {"price": 4.0}, *odd)
    runs.run_validation(store, DAY, raw)
    totals = runs.run_enrichment(store, DAY).first()
    assert totals.total_enriched == 8
    values = spark.createDataFrame([(1.0,), (3.0,), (float("inf"),), (float("nan"),), (None,), (1e40,)], "x double")
    row = values.agg(exact_mean("x").alias("mean"), exact_sum("x").alias("sum")).first()
    assert (row["mean"], row["sum"]) == (2.0, 4.0)
    small = spark.createDataFrame([(3e-9,), (4e-9,)], "x double")
    assert small.agg(exact_mean("x").alias("mean")).first()["mean"] == 3.5e-9


def test_summary_means_count_what_they_sum(spark):
    keys = ", ".join(f"{k} string" for k in marts.SUMMARY_KEYS)
    inf, nan = float("inf"), float("nan")
    measures = ("efficacy_score", "safety_score", "adverse_event_rate", "price_usd")
    odd = [1.0, 3.0, inf, -inf, nan, 1e40, None]
    rows = spark.createDataFrame(
        [("c", "t", "r", name, x, x, x, x) for name in ("a", "b") for x in odd] + [("c", "t", "none", "a", inf, nan, None, 1e40)],
        f"{keys}, drug_name string, " + ", ".join(f"{m} double" for m in measures),
    ).selectExpr(
        "*", "1L AS patient_count", "1L AS adverse_events", "1.0D AS predicted_revenue",
        "'x' AS development_stage", "'x' AS patent_status", "'x' AS risk_category",
    )
    means = {r.region: [r[f"avg_{m}"] for m in measures] for r in marts.summary_totals(rows).collect()}
    assert means == {"r": [2.0] * 4, "none": [None] * 4}


def test_repeated_lookup_keys_multiply_nothing(spark):
    rows = raw_rows(spark, {"currency": "EUR"}, {"currency": "XXX"})
    rates = spark.createDataFrame([("EUR", 2.0), ("EUR", 3.0)], "currency_code string, usd_rate double")
    assert sorted(r.price_usd for r in price_in_usd(rows, rates).collect()) == [100.0, 200.0]
    names = spark.createDataFrame([("USA", "b"), ("USA", "a")], "k string, v string")
    assert {r.code for r in attach(rows, names, "country", "k", "v", "code").collect()} == {"a"}
    assert attach(rows, names, "country", "k", "v", "code").count() == 2


def test_latest_date_and_expiry_by_folder_names(spark, store):
    layer = schemas.LAYERS["raw"]
    assert files.stored_days(spark, store.path("raw"), layer) == []
    store.write("raw", stamped(spark, 1, 2, 2, 3))
    assert store.read_latest("raw").count() == 1
    assert store.read_latest("raw", "2001-06-02").count() == 2
    assert store.read_latest("raw", "2001-05-01").count() == 0
    plan = store.read_latest("raw", "2001-06-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "Subquery" not in plan
    gone = layers.drop_expired(spark, store.path("raw"), layer, "2001-06-03", 1)
    assert gone == [dt.date(2001, 6, 1)] and store.read("raw").count() == 3


def test_layer_schemas_round_trip(spark, store):
    store.write("raw", stamped(spark, 1))
    runs.run_validation(store, DAY)
    runs.run_enrichment(store, DAY)
    for name in ("raw", "validated", "enriched", "summary"):
        layer = schemas.LAYERS[name]
        got = store.read(name, DAY)
        assert [f.name for f in got.schema][: len(layer.schema)] == layer.schema.names
        assert got.count() == 1


def test_pass_rate_of_nothing_fails(spark):
    totals = runs.status_totals(validate(raw_rows(spark, {}).where("false"), DAY))
    row = runs.pass_rate_metric(totals, "t", F.current_timestamp()).first()
    assert row.metric_value is None and row.status == "FAILED" and row.details == "Processed 0 records"


def test_pass_rate_must_exceed_the_threshold(spark):
    totals = spark.createDataFrame([(5, 4)], "total_records long, passed_records long")
    assert runs.pass_rate_metric(totals, "t", F.current_timestamp()).first().status == "FAILED"


def test_name_file_cleaner(spark, tmp_path):
    source = tmp_path / "names.csv"
    source.write_text("id,drug_name,dosage\n1,Paracetamol-500MG,500\n2,,\n")
    rows = runs.clean_csv(spark, str(source), str(tmp_path / "out")).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", "Paracetamol-500MG", "500", "PARACETAMOL 500"), ("2", None, None, "")]


def test_bronze_file_lineage(spark, tmp_path):
    source = tmp_path / "items.csv"
    header = ",".join(schemas.BRONZE_FILE.names)
    source.write_text(f"{header}\n1-2-3,Lab,Prod,Gen,Tablet,Oral,200mg,0.15,100,2023-01-15\n")
    row = files.read_bronze(spark, str(source), F.lit(DAY).cast("timestamp"), "v1").first()
    assert (row.unit_price, row.package_size, row.source_file, row.data_version) == (0.15, 100, "items.csv", "v1")
    assert row.ingestion_timestamp == 991353600000


def test_union_of_evolving_parts(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "n")], "x int, y string")
    assert sorted(map(tuple, files.union_evolving(a, b).collect())) == [(1, None), (2, "n")]


def test_tables_and_views(spark, store):
    store.write("raw", stamped(spark, 1, 2))
    try:
        names = tables.create_tables(spark, "rx_test", store.root)
        assert len(names) == len(schemas.LAYERS)
        tables.refresh_partitions(spark, "rx_test.raw")
        assert spark.table("rx_test.raw").count() == 2
        tables.create_views({"raw_counts": reports.raw_check(store.read("raw"))})
        assert spark.sql("SELECT total_records FROM raw_counts").first()[0] == 2
    finally:
        spark.sql("DROP DATABASE IF EXISTS rx_test CASCADE")


def test_generator_bounds_and_repeatability(spark):
    rows = generator.synthetic_records(spark, DAY, copies=2, seed=3)
    assert rows.columns == schemas.RAW.names
    n = rows.count()
    assert abs(n / (2 * 2500) - V.GENERATED_SAMPLE_RATE) < 0.05
    assert rows.select("record_id").distinct().count() == n
    assert rows.exceptAll(generator.synthetic_records(spark, DAY, copies=2, seed=3)).count() == 0
    check = reports.raw_check(rows).first()
    assert (check.unique_manufacturers, check.unique_categories) == (10, 10)
    bad = rows.where(
        ~F.col("price").between(10, 1000) | ~F.col("efficacy_score").between(0.5, 1)
        | ~F.col("safety_score").between(0.4, 1) | ~F.col("patient_count").between(100, 9999)
        | (F.size(F.split("competitor_drugs", ", ")) != 3) | F.col("strength").isNull()
        | F.expr("contains(competitor_drugs, split(drug_name, ' ')[0])")
    )
    assert bad.count() == 0
    passed = validate(rows, DAY).where("validation_status = 'PASSED'").count()
    assert passed == n


def test_generator_rows_do_not_depend_on_partitions(spark):
    few = generator.synthetic_records(spark, DAY)
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    try:
        assert few.exceptAll(generator.synthetic_records(spark, DAY)).count() == 0
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_ship_date_reaches_the_scan(spark):
    rows = raw_records(spark, "/root/testdata/sf0.001", ingested_on=DAY)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
