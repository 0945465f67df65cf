"""Similar drugs against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import raw_rows
from rxstrata.operators import enrichment, similar
from rxstrata.operators.validation import validate

SCHEMA = "group string, item string, v array<long>"


def nearest(items, k):
    """{(group, item): names} of (group, item, v) rows, all pairs compared."""
    out = {}
    for g, i, v in items:
        apart = sorted((sum((a - b) ** 2 for a, b in zip(v, w)), j) for h, j, w in items if h == g and j != i)
        out[g, i] = [j for _, j in apart[:k]]
    return out


def found(df):
    return {(r.group, r.item): r.similar for r in df.collect()}


def random_items(n, groups=("a", "b"), spread=1000, seed=1):
    rng = random.Random(seed)
    return [(rng.choice(groups), f"i{x:05d}", [rng.randrange(spread) for _ in range(5)]) for x in range(n)]


@pytest.mark.parametrize("window", [2, 32])
def test_exact_search_equals_all_pairs(spark, window):
    """Also where the windows found little, and where many items share one vector."""
    items = random_items(300) + [("a", f"same{i}", [500] * 5) for i in range(60)]
    items += random_items(80, groups=("flat",), spread=2, seed=2) + [("alone", "x", [1] * 5)]
    got = similar.similar_items(spark.createDataFrame(items, SCHEMA).repartition(4), k=5, exact=True, window=window)
    assert found(got) == nearest(items, 5)


def test_exact_search_keeps_few_pairs(spark):
    """Of one class, only pairs within the reach of a point are numbered, and no nearest is lost."""
    items = random_items(600, groups=("hot",), seed=3)
    points = similar.stage(similar._points(spark.createDataFrame(items, SCHEMA), 5), "points")
    places = similar.stage(similar._places(points, similar.shifts(5, 3), 1000), "places")
    pairs = {(r.point, r.other) for r in similar._pairs_in_reach(points, places, 5, 32, 5).collect()}
    assert 6 * 600 <= len(pairs) < 600 * 600 / 5
    name = {r.point: r["items"][0] for r in points.collect()}
    met = {(name[p], name[o]) for p, o in pairs}
    assert all((i, o) in met for (_, i), others in nearest(items, 5).items() for o in others)


def test_windows_find_most_of_the_nearest(spark):
    """One class of 3,000 items: recall of 0.95 and more."""
    items = random_items(3000, groups=("hot",))
    got = found(similar.similar_items(spark.createDataFrame(items, SCHEMA), k=5))
    hits = 0
    for _, i, v in items[:300]:
        apart = sorted((sum((a - b) ** 2 for a, b in zip(v, w)), j) for _, j, w in items if j != i)
        hits += len({j for _, j in apart[:5]} & set(got["hot", i]))
    assert hits >= 0.95 * 5 * 300


def test_places_are_row_numbers_along_the_curve(spark):
    """Whatever the ranges that cut the class, so no run has more than its length."""
    points = similar._points(spark.createDataFrame(random_items(1500, groups=("hot",)), SCHEMA), 5)
    moves = similar.shifts(5, 2)
    places = similar._places(points, moves, 1000).collect()
    vectors = {r.point: r.v for r in points.collect()}
    for way in (0, 1):
        order = sorted((r.place, r.point) for r in places if r.way == way)
        assert [p for p, _ in order] == list(range(1500))
        bits = [["".join(b) for b in zip(*(f"{x + s:011b}" for x, s in zip(vectors[p], moves[way])))] for _, p in order]
        assert bits == sorted(bits)


def test_few_items_null_groups_and_an_empty_table(spark):
    rows = [("a", "x", [1, 2]), ("a", "y", [1, 2]), (None, "z", [0, 0]), ("b", "x", [9, 9])]
    got = similar.similar_items(spark.createDataFrame(rows, SCHEMA), exact=True)
    assert found(got) == {("a", "x"): ["y"], ("a", "y"): ["x"], ("b", "x"): []}
    assert similar.similar_items(spark.createDataFrame([], SCHEMA)).count() == 0


def test_drugs_of_a_batch(spark):
    """Profiles from records; the list reaches the enriched rows."""
    raw = raw_rows(
        spark,
        *[{"drug_code": f"D{i % 4}", "price": 10.0 + 20 * (i % 4) ** 2, "safety_score": None if i % 4 == 3 else 0.5} for i in range(8)],
        {"drug_code": None}, {"therapeutic_class": "Other", "drug_code": "D9"},
    )
    batch = validate(raw, "2001-06-01")
    vectors = {r.item: r.v for r in similar.profiles(enrichment.enrichable(batch)).collect()}
    assert vectors["D0"] == [0, 0, 0, 0, 0] and vectors["D2"][0] == 1000 * 80 // 180 and vectors["D3"][2] == 500
    known = enrichment.similar_drugs(batch, k=2, exact=True)
    assert found(known)["Cardiovascular-Alpha", "D0"] == ["D1", "D2"]
    rows = enrichment.enrich(batch, "2001-06-01", known=known)
    assert rows.schema["similar_drugs"].dataType.simpleString() == "array<string>"
    assert {tuple(r.similar_drugs) for r in rows.where(F.col("drug_code") == "D3").collect()} == {("D2", "D1")}
    assert {len(r.similar_drugs) for r in rows.where("drug_code is null or drug_code = 'D9'").collect()} == {0}
    assert {len(r.similar_drugs) for r in enrichment.enrich(batch, "2001-06-01").collect()} == {0}


def test_reach_comes_from_runs_without_sorting_their_pairs(spark):
    points = similar.stage(similar._points(spark.createDataFrame(random_items(100, groups=("a", "b"), seed=4), SCHEMA), 5), "points")
    places = similar.stage(similar._places(points, similar.shifts(5, 2), 1000), "places")
    reached = similar._reached(points, places, 5, 16, 5)
    assert "Window" not in reached._jdf.queryExecution().executedPlan().toString()
    vectors, runs = {r.point: r.v for r in points.collect()}, {}
    for r in places.collect():
        runs.setdefault((r.way, r.group, r.place // 16), []).append(r.point)
    want = {}
    for members in runs.values():
        for p in members:
            apart = sorted(sum((x - y) ** 2 for x, y in zip(vectors[p], vectors[o])) for o in members)
            want.setdefault(p, []).extend(apart[5:6])
    assert {r.point: r.reach for r in reached.collect()} == {p: min(found, default=None) for p, found in want.items()}
    assert {r.reach for r in similar._reached(points, places, 5, 4, 5).collect()} == {None}


@pytest.mark.parametrize("width, steps", [(5, 1000), (2, 7), (3, 100_000), (9, 1000), (20, 1), (60, 1)])
def test_a_curve_takes_the_bits_in_turn(spark, width, steps):
    rng = random.Random(width)
    vectors, shift = [[rng.randrange(steps + 1) for _ in range(width)] for _ in range(20)], similar.shifts(width, 1, steps)[0]
    size = (2 * steps).bit_length()
    kept = max(1, min(size, similar.CURVE_BITS // width))
    df = spark.createDataFrame([(v,) for v in vectors], "v array<long>").select(similar.curve("v", shift, steps).alias("at"))
    bits = [[f"{x + s:0{size}b}"[:kept] for x, s in zip(v, shift)] for v in vectors]
    places = [int("".join("".join(b) for b in zip(*of)), 2) for of in bits]
    assert [r["at"] % 2**64 for r in df.collect()] == [p % 2**64 for p in places]
