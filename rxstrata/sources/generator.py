"""Reproducible synthetic raw records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxstrata import fixed_values as V
from rxstrata import schemas
from rxstrata.functions.columns import as_date
from rxstrata.sources.commerce import pick


RELEASES = (" XR", " SR", "")
LABELS = {
    "dosage_form": V.GENERATED_FORMS,
    "route_of_administration": V.GENERATED_ROUTES,
    "country": V.GENERATED_COUNTRIES,
    "clinical_trial_phase": ("Phase II", "Phase III", "Phase IV", "Approved"),
    "currency": ("USD",),
}
#: (lowest, highest, digits), (lowest, first beyond), days from the date of the run
DECIMALS = {
    "price": (10, 1000, 2),
    "efficacy_score": (0.5, 1, 3),
    "safety_score": (0.4, 1, 3),
    "market_share": (0, 0.5, 3),
}
COUNTS = {"patient_count": (100, 10000), "adverse_events": (0, 100)}
DAYS = {"approval_date": (-3650, 1), "patent_expiry_date": (365, 4015), "ingested_on": (-29, 1)}


def draw(key: Column, what: str, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on ``key``, the purpose and the seed alone."""
    bits = F.xxhash64(F.lit(seed), F.lit(what), key).bitwiseAND(F.lit((1 << 53) - 1))
    return bits / F.lit(float(1 << 53))


def draw_from_md5(key: Column, what: str) -> Column:
    """The same from the first 7 hex digits of an MD5, which other engines share."""
    digest = F.md5(F.concat(F.lit(f"{what}|"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("long") / F.lit(float(16**7))


def sampled(df: DataFrame, key: Column, rate: float, what: str = "sample") -> DataFrame:
    """Rows whose draw is below ``rate``: the same rows on every run."""
    return df.where(draw_from_md5(key, what) < rate)


def other_names(own: Column, names: tuple[str, ...], key: Column, k: int) -> Column:
    """``k`` of ``names`` other than ``own``, in an order that depends on ``key``."""
    others = F.filter(F.array(*map(F.lit, names)), lambda n: n != own)
    keyed = F.transform(
        others, lambda n: F.struct(F.md5(F.concat_ws("|", key.cast("string"), n)).alias("h"), n.alias("n"))
    )
    return F.transform(F.slice(F.array_sort(keyed), 1, k), lambda e: e["n"])


def synthetic_records(
    spark: SparkSession, as_of: str | dt.date, copies: int = 1, seed: int = 0
) -> DataFrame:
    """Raw records over all names, manufacturers and categories, thinned by the sample rate.

    The combinations are counted off a range, so any number of copies is spread
    over the cluster without a join.
    """
    names, makers, groups = V.GENERATED_NAMES, V.GENERATED_MANUFACTURERS, V.GENERATED_CATEGORIES
    cells = len(names) * len(makers) * len(groups)
    cell = F.col("id")
    base = spark.range(cells * copies).select(
        "id",
        pick(names, F.floor(cell / (len(makers) * len(groups)))).alias("name"),
        pick(makers, F.floor(cell / len(groups))).alias("manufacturer"),
        pick(groups, cell).alias("drug_category"),
    )

    def u(what: str) -> Column:
        return draw(F.col("id"), what, seed)

    def choice(labels: tuple, what: str) -> Column:
        return F.get(F.array(*map(F.lit, labels)), F.floor(u(what) * len(labels)).cast("int"))

    def whole(low: int, high: int, what: str) -> Column:
        return F.floor(low + u(what) * (high - low)).cast("int")

    today = as_date(as_of)
    columns = {name: F.col(name) for name in ("manufacturer", "drug_category")}
    columns |= {
        name: F.round(low + u(name) * (high - low), digits)
        for name, (low, high, digits) in DECIMALS.items()
    }
    columns |= {name: whole(low, high, name).cast("long") for name, (low, high) in COUNTS.items()}
    columns |= {name: choice(labels, name) for name, labels in LABELS.items()}
    columns |= {
        name: F.date_add(today, whole(first, last, name)) for name, (first, last) in DAYS.items()
    }
    rivals = other_names(F.col("name"), names, F.col("id"), V.GENERATED_COMPETITORS)
    columns |= {
        "record_id": F.sha2(F.concat_ws("|", F.lit(seed), F.col("id")), 256),
        "drug_name": F.concat("name", choice(RELEASES, "release")),
        "drug_code": F.format_string("DRG-%04d", whole(1000, 10000, "code")),
        "active_ingredient": F.format_string("%s-Active", "name"),
        "strength": F.concat(
            choice(V.GENERATED_STRENGTHS, "strength").cast("string"), choice(V.GENERATED_UNITS, "unit")
        ),
        "therapeutic_class": F.concat_ws("-", "drug_category", choice(V.GENERATED_CLASSES, "class")),
        "ingestion_timestamp": columns.pop("ingested_on").cast("timestamp"),
        "competitor_drugs": F.array_join(rivals, ", "),
        "source_file": F.format_string("generated/%s", today.cast("string")),
        "raw_data": F.format_string("record %d of seed %d", "id", F.lit(seed)),
    }
    kept = base.where(u("keep") < V.GENERATED_SAMPLE_RATE)
    return kept.select(*[columns[name].alias(name) for name in schemas.RAW.names])
