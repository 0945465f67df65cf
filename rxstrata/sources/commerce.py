"""Raw product records and bronze items derived from order, part and supplier tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxstrata import schemas
from rxstrata.session import file_system

# Labels of the derived columns, picked by a key modulo their number.
CATEGORIES = ("Cardiovascular", "Neurological", "Oncology", "Endocrine")
RELEASES = (" XR", " SR", "")
UNITS = (" mg", "mcg", " ml", " g", " %")
FORMS = ("Tablet", "Capsule", "Injection")
CLASSES = ("-Alpha", "-Beta", "-Gamma", "-Delta")
COUNTRIES = (
    "USA", "Canada", "UK", "Germany", "Japan", "Australia", "France", "Italy",
    "United States", "Brazil",
)
PHASES = {"1": "Phase I", "2": "Phase II", "3": "Phase III", "4": "Phase IV", "5": "Approved"}
COMPETITORS = (None, "A", "A, B", "A, B, C")

TASK_BYTES = 4_000_000  # stored bytes of line items per task that sorts whole records


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sorting_tasks(spark: SparkSession, folder: str) -> int:
    """Tasks in which whole records can be sorted in memory, by the size of the line items."""
    fs, at = file_system(spark, f"{folder}/lineitem.parquet")
    stored = fs.getContentSummary(at).getLength()
    return max(spark.sparkContext.defaultParallelism, -(-stored // TASK_BYTES))


def pick(labels: tuple, key: Column) -> Column:
    """The label at ``key`` modulo the number of labels."""
    return F.get(F.array(*map(F.lit, labels)), (key % len(labels)).cast("int"))


def _thousandths(number: Column, below: int) -> Column:
    return (number % below) / F.lit(1000.0)


def order_lines(
    spark: SparkSession,
    folder: str,
    shipped_on: str | dt.date | None = None,
    lines: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Line items with their part, supplier and order.

    ``shipped_on`` is compared with the stored column itself, so it reaches the
    scan. ``lines`` may be a stream of line items.

    Orders, which grow like the lines, are merged first, while a row is still a few
    numbers; names come in last. The plan is the same at every size, and its shuffle deals
    the lines, which may be stored as one row group, to all tasks. AQE makes these tasks by
    shuffled bytes, which are few beside those of a record: a reader that sorts records
    gives a number of ``tasks``, among which the merged rows are dealt once more.
    """
    if lines is None:
        lines = table(spark, folder, "lineitem")
    if shipped_on is not None:
        day = dt.date.fromisoformat(str(shipped_on))
        first, after = (
            F.lit(str(d)).cast("timestamp_ntz") for d in (day, day + dt.timedelta(days=1))
        )
        lines = lines.where((F.col("l_shipdate") >= first) & (F.col("l_shipdate") < after))
    parts, suppliers = table(spark, folder, "part"), table(spark, folder, "supplier")
    orders = table(spark, folder, "orders")
    merged = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    if tasks is not None:
        merged = merged.repartition(tasks, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return (
        merged.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )


def strength_label() -> Column:
    amount = (F.col("l_quantity").cast("int") * 10).cast("string")
    return (
        F.when(F.col("l_partkey") % 17 == 0, "n/a")
        .when(F.col("l_partkey") % 19 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(amount, pick(UNITS, F.col("l_linenumber"))))
    )


def raw_records(
    spark: SparkSession,
    folder: str,
    ingested_on: str | dt.date | None = None,
    lines: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Raw records, one per line item."""
    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    line = F.col("l_linenumber")
    category = pick(CATEGORIES, part)
    injected = line % 3 == 2
    ordered = F.col("o_orderdate").cast("date")
    phases = F.create_map(*[F.lit(x) for item in PHASES.items() for x in item])
    columns = {
        "record_id": F.concat_ws("-", order, line, part, supplier),
        "drug_name": F.concat(
            F.upper(F.substring("p_name", 1, 1)),
            F.expr("substring(p_name, 2)"),
            pick(RELEASES, part),
        ),
        "drug_code": F.concat(F.lit("DRG-"), (part + 1000).cast("string")),
        "manufacturer": F.col("s_name"),
        "drug_category": category,
        "active_ingredient": F.concat("p_name", F.lit("-Active")),
        "strength": strength_label(),
        "dosage_form": pick(FORMS, line),
        "route_of_administration": F.when(injected, "Injection").otherwise("Oral"),
        "therapeutic_class": F.concat(category, pick(CLASSES, supplier)),
        "approval_date": ordered,
        "patent_expiry_date": F.date_add(ordered, (F.col("p_size") * 100).cast("int")),
        "price": F.col("l_extendedprice"),
        "currency": F.lit("USD"),
        "country": pick(COUNTRIES, F.col("s_nationkey")),
        "clinical_trial_phase": phases[F.substring("o_orderpriority", 1, 1)],
        "efficacy_score": F.when(
            order % 23 != 0, _thousandths(order * 7919 + part * 31 + line, 1021)
        ),
        "safety_score": _thousandths(order * 104729 + supplier * 17, 1021),
        "patient_count": order * 13 % 500,
        "adverse_events": part * 11 % 60,
        "market_share": _thousandths(order * 37 + part * 101 + supplier, 499),
        "competitor_drugs": pick(COMPETITORS, supplier),
        "ingestion_timestamp": F.col("l_shipdate").cast("timestamp"),
        "source_file": F.lit("lineitem.parquet"),
        "raw_data": F.lit(None).cast("string"),
    }
    joined = order_lines(spark, folder, ingested_on, lines, tasks)
    return joined.select(*[columns[name].alias(name) for name in schemas.RAW.names])


def bronze_items(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze file columns, one row per line item."""
    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    line = F.col("l_linenumber")
    columns = {
        "ndc_number": F.concat_ws(
            "-",
            F.lpad((supplier % 100000).cast("string"), 5, "0"),
            F.lpad((part % 1000).cast("string"), 3, "0"),
            F.lpad((line % 100).cast("string"), 2, "0"),
        ),
        "labeler_name": F.col("s_name"),
        "product_name": F.concat("p_name", F.lit(" "), pick(FORMS, line), F.lit("s")),
        "generic_name": F.when(part % 13 != 0, F.col("p_name")),
        "dosage_form": pick(FORMS, line),
        "route": F.when(line % 3 == 2, "Injection").otherwise("Oral"),
        "strength": strength_label(),
        "unit_price": F.when(order % 29 != 0, F.round(F.col("l_extendedprice") / F.col("l_quantity"), 2)),
        "package_size": F.col("l_quantity").cast("int"),
        "market_date": F.date_format(F.col("l_shipdate").cast("date"), "yyyy-MM-dd"),
    }
    lines = order_lines(spark, folder)
    return lines.select(*[columns[name].alias(name) for name in schemas.BRONZE_FILE.names])
