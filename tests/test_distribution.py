"""Ranks and quantiles against Spark's own windows and percentiles, under skew."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rxstrata.operators import distribution as dist
from rxstrata.operators.topk import top_k_arrays

M = dist.Measure("m", "x", by=("k",))
GLOBAL = dist.Measure("g", "x", keep_nulls=False)


@pytest.fixture(scope="module", autouse=True)
def many_slices(spark):
    """Keep all slices of these small tables, as large ones would have."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows in one group, a third of that group on one value, NULLs, a lone row."""
    i = F.col("id")
    key = F.when(i == 0, "single").when(i % 3 == 0, "hot").when(i % 50 == 1, None).otherwise(
        F.concat(F.lit("k"), i % 17)
    )
    value = F.when(i % 9 == 0, 0.5).when(i % 31 == 0, None).otherwise((i * 7919 % 4001) / 1000)
    return spark.range(20000).select("id", key.alias("k"), value.alias("x")).cache()


def test_ranks_equal_window_ranks(rows):
    positions = dist.distribution(rows, M).positions(M)
    mine = dist.attach_position(rows, positions, M, dist.percent_rank(), "p")
    mine = dist.attach_position(mine, positions, M, dist.dense_rank_descending(), "d")
    up = Window.partitionBy("k").orderBy(F.col("x").asc_nulls_first())
    down = Window.partitionBy("k").orderBy(F.col("x").desc_nulls_last())
    want = rows.select(
        "id", "k", "x", F.percent_rank().over(up).alias("p"),
        F.dense_rank().over(down).cast("long").alias("d"),
    )
    mine = mine.select("id", "k", "x", "p", "d")
    assert mine.exceptAll(want).count() == 0 and want.exceptAll(mine).count() == 0


def test_quantiles_equal_percentile_disc(rows):
    at = {"a": 0.0001, "b": 0.25, "c": 0.5, "d": 0.75, "e": 1.0}
    got = dist.distribution(rows, GLOBAL, M).quantiles(GLOBAL, **at).first()
    want = rows.selectExpr(
        *[f"percentile_disc({p}) WITHIN GROUP (ORDER BY x) AS {n}" for n, p in at.items()]
    ).first()
    assert got == want


@pytest.mark.parametrize("accuracy", [20, 1000])
@pytest.mark.parametrize("value", ["x", "id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id END", "0 * id", "if(id < 3, id, NULL)"])
def test_bracketed_quantiles_are_exact(rows, value, accuracy):
    """Skewed, distinct, constant and few values; the ends as well as the middle."""
    at = {"lowest": 0.0001, "a": 0.25, "b": 0.5, "c": 0.75, "highest": 1.0}
    table = rows.selectExpr(f"cast({value} AS double) AS v")
    got = dist.exact_quantiles(table, "v", accuracy, **at).first()
    want = table.selectExpr(*[f"percentile_disc({p}) WITHIN GROUP (ORDER BY v) AS {n}" for n, p in at.items()])
    assert got == want.first()
    assert list(dist.exact_quantiles(table.where("false"), "v", **at).first()) == [None] * 5


def test_medians_equal_percentile(rows):
    measure = dist.Measure("m", "x", by=("k",), keep_nulls=False)
    got = dist.distribution(rows, measure).medians(measure, "median")
    want = rows.where("x IS NOT NULL").groupBy("k").agg(F.percentile("x", F.lit(0.5)).alias("median"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_slices_split_a_hot_group(rows):
    counts = dist.distribution(rows, M).counts
    per_slice = counts.groupBy("slice").count()
    top = per_slice.agg(F.max("count"), F.sum("count")).first()
    assert per_slice.count() > 2 and top[0] < top[1] / 2


def test_empty_input(spark, rows):
    nothing = dist.distribution(rows.where("false"), GLOBAL)
    assert nothing.quantiles(GLOBAL, q=0.5).first().q is None


def test_top_k_equals_sorted_group(rows):
    order = [F.col("x").desc_nulls_last(), F.col("id").asc()]
    got = {
        r.k: r.top for r in top_k_arrays(rows, ("k",), order, 4, F.col("id"), "top").collect()
    }
    groups = {}
    for r in rows.collect():
        groups.setdefault(r.k, []).append((r.x is None, -(r.x or 0), r.id))
    assert got == {k: [i for *_, i in sorted(v)[:4]] for k, v in groups.items()}


def test_top_k_limits_before_the_shuffle(rows):
    order = [F.col("x").desc(), F.col("id").asc()]
    plan = top_k_arrays(rows, ("k",), order, 4, F.col("id"), "top")
    text = plan._jdf.queryExecution().executedPlan().toString()
    limit, exchange = text.rindex("WindowGroupLimit"), text.rindex("Exchange hashpartitioning")
    assert "Partial" in text[limit:limit + 200] and limit > exchange
