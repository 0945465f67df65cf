"""The most similar items of a class: bounded nearest neighbours.

Items (a drug within its therapeutic class) become vectors of whole numbers: each
attribute's mean, as thousandths of the attribute's range over all items. Items of equal
vectors are one point. Points of a class are sorted along a few curves that interleave
the bits of the components, each after a random shift; close points stand close on most
of them, so a point meets those within ``WINDOW`` places of it on any curve. That is
linear in the points, and a class of any size is cut into runs of bounded length. The
exact search takes the distance reached within such runs as a bound and looks at every
run whose box, the least and largest of each component, can hold anything as near.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxstrata.functions.columns import exact_mean
from rxstrata.operators.topk import join_groups, top_k_arrays
from rxstrata.session import stage

GROUP, ITEM = "therapeutic_class", "drug_code"
ATTRIBUTES = ("price_usd", "efficacy_score", "safety_score", "adverse_event_rate", "market_share")
STEPS = 1000
K = 5
WINDOW = 32
CURVES = 6
REACH_CURVES = 3  # of the exact search
CURVE_BITS = 62
TABLE_BITS = 4
SEED = 15


def profiles(
    records: DataFrame,
    group: str = GROUP,
    item: str = ITEM,
    attributes: Sequence[str] = ATTRIBUTES,
    steps: int = STEPS,
) -> DataFrame:
    """group, item, v: one vector per item of a group.

    A component is floor(steps * (mean - least) / (largest - least)), with the least and
    largest mean of the attribute over all items; the middle where an item has no value,
    0 where all means are equal. Records without item are left out.
    """
    means = stage(
        records.where(F.col(item).isNotNull())
        .groupBy(F.col(group).alias("group"), F.col(item).alias("item"))
        .agg(*[exact_mean(a, 6).alias(a) for a in attributes]),
        "profiles",
    )
    ends = means.select(
        F.struct(*[F.min(a).alias(f"{a}_least") for a in attributes], *[F.max(a).alias(f"{a}_most") for a in attributes])
    ).scalar()

    def component(a: str) -> Column:
        least, most = ends[f"{a}_least"], ends[f"{a}_most"]
        along = F.floor(F.lit(float(steps)) * (F.col(a) - least) / (most - least))
        return F.when(F.col(a).isNull(), steps // 2).when(most == least, 0).otherwise(along).cast("long")

    return means.select("group", "item", F.array(*map(component, attributes)).alias("v"))


def shifts(width: int, n: int, steps: int = STEPS, seed: int = SEED) -> list[list[int]]:
    """``n`` random shifts of a vector's components, the same for a seed."""
    rng = random.Random(seed)
    return [[rng.randrange(steps + 1) for _ in range(width)] for _ in range(n)]


def curve(v: str, shift: Sequence[int], steps: int = STEPS) -> Column:
    """Where on the curve of a shift a vector with components from 0 to ``steps`` is.

    A component's bits are spread by a table, four at a time.
    """
    size, width = (2 * steps).bit_length(), len(shift)
    kept = max(1, min(size, CURVE_BITS // width))
    most = min(TABLE_BITS, kept)
    spread = F.lit([sum((n >> bit & 1) << bit * width for bit in range(most)) for n in range(2**most)])
    place = F.lit(0).cast("long")
    for i, s in enumerate(shift):
        moved = F.shiftright(F.get(v, F.lit(i)) + s, size - kept)
        for bit in range(0, kept, most):
            part = F.shiftright(moved, bit).bitwiseAND(F.lit(2**most - 1)).cast("int")
            place = place + F.shiftleft(F.get(spread, part).cast("long"), bit * width + width - 1 - i)
    return place


def _distance(a: str, b: str, width: int) -> Column:
    """Squared distance of two vectors, component by component, which Spark compiles."""
    gaps = [F.get(a, F.lit(i)) - F.get(b, F.lit(i)) for i in range(width)]
    return sum((gap * gap for gap in gaps), F.lit(0).cast("long"))


def _flat(name: str, width: int) -> list[str]:
    """The columns of a vector that is compared often: cheaper to read than an array."""
    return [f"{name}{i}" for i in range(width)]


def _points(items: DataFrame, k: int) -> DataFrame:
    """point, group, v, items: distinct vectors of a group with their ``k + 1`` first items.

    More items of one vector are never among the ``k`` first neighbours of any.
    """
    kept = top_k_arrays(items, ["group", "v"], [F.col("item")], k + 1, F.col("item"), "items")
    return stage(kept.withColumn("point", F.monotonically_increasing_id()), "points")


def _places(points: DataFrame, moves: list[list[int]], steps: int) -> DataFrame:
    """way, group, point, place: the places of points along the curve of each shift.

    Ranges of the order are even and may cut a group anywhere; a place is the row number
    within the range and the group, plus the group's rows in the ranges before.
    """
    along = F.array(*[F.struct(F.lit(n).alias("way"), curve("v", m, steps).alias("at")) for n, m in enumerate(moves)])
    order = ("way", "group", "at", "point")
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage(
        points.select("point", "group", F.explode(along).alias("on"))
        .select("point", "group", "on.*")
        .repartitionByRange(parts, *order)
        .withColumn("range", F.spark_partition_id()),
        "ranges",
    )
    scope = ("way", "group", "range")
    earlier = Window.partitionBy("way", "group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy(*scope).agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    )
    within = Window.partitionBy(*scope).orderBy("at", "point")
    numbered = dealt.withColumn("nth", F.row_number().over(within) - 1)
    return join_groups(numbered, stage(before.drop("rows"), "range-sizes"), scope).select(
        "way", "group", "point", (F.col("nth") + F.col("before")).alias("place")
    )


def _nearest(pairs: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """The ``k + 1`` nearest points of each point, per ``by``; ties by their first item."""
    order = Window.partitionBy("point", *by).orderBy("distance", F.get("items", F.lit(0)))
    return pairs.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= k + 1).drop("_nth")


def _met(left: DataFrame, right: DataFrame, points: DataFrame, on: Sequence[str], width: int) -> DataFrame:
    """point, other, items, distance (and ``on``) of the pairs that share the keys ``on``."""
    of = points.select("point", "v")
    other = points.select(F.col("point").alias("other"), F.col("v").alias("_v"), "items")
    mine, theirs = left.join(of, "point"), right.withColumnRenamed("point", "other").join(other, "other")
    for column in theirs.columns:
        if column in mine.columns and column not in on:
            theirs = theirs.withColumnRenamed(column, f"_{column}")
    return mine.join(theirs, list(on)).withColumn("distance", _distance("v", "_v", width))


def _windowed(points: DataFrame, places: DataFrame, width: int, window: int, k: int) -> DataFrame:
    """point, other, items, distance of near points, by windows along each curve.

    Runs of ``window`` places are joined with themselves and the runs beside them, so no
    more than 3 * window rows share a key, however large the group.
    """
    run = F.floor(F.col("place") / window).cast("long")
    asking = places.select("way", "group", "point", "place", F.explode(F.array(run - 1, run, run + 1)).alias("run"))
    held = places.withColumn("run", run)
    pairs = _met(asking, held, points, ["way", "group", "run"], width)
    pairs = pairs.where(F.abs(F.col("place") - F.col("_place")) <= window)
    best = _nearest(pairs.select("way", "point", "other", "items", "distance"), ["way"], k)
    return _nearest(best.drop("way").distinct(), [], k)


def _reached(points: DataFrame, places: DataFrame, width: int, run: int, k: int) -> DataFrame:
    """point, reach: a squared distance within which ``k + 1`` points stand, itself
    included; NULL where fewer were met. Points meet those of their run on each curve;
    a run is one array, so its pairs are neither stored nor sorted together."""
    v = _flat("v", width)
    norm = sum((F.col(c) * F.col(c) for c in v), F.lit(0).cast("long"))
    flat = points.select("point", *[F.get("v", F.lit(i)).alias(name) for i, name in enumerate(v)]).withColumn("norm", norm)
    members = places.join(flat, "point").select(
        "way", "group", F.floor(F.col("place") / run).alias("run"),
        F.struct("point", "norm", *v, *[(F.col(c) * -2).alias(f"_{c}") for c in v]).alias("member"),
    )
    runs = members.groupBy("way", "group", "run").agg(F.collect_list("member").alias("members"))

    def nth(a: Column) -> Column:
        # the squared distance is |a|^2 + |b|^2 - 2ab, of which |a|^2 is added last
        met = F.transform("members", lambda b: sum((a[f"_{c}"] * b[c] for c in v), b["norm"]))
        return F.struct(a["point"].alias("point"), (a["norm"] + F.get(F.sort_array(met), F.lit(k))).alias("reach"))

    return (
        runs.select(F.explode(F.transform("members", nth)).alias("of")).select("of.*")
        .groupBy("point").agg(F.min("reach").alias("reach"))
    )


def _span(reach: str) -> Column:
    """A whole number that no component of two points within ``reach`` differs by."""
    return (F.floor(F.sqrt(reach)) + 1).cast("long").alias("span")


def _close(low: str, high: str, other_low: str, other_high: str, width: int) -> Column:
    """Whether two boxes are within ``reach``; a point is a box of no extent.

    Most pairs are out of ``span`` in one of the first components, which is compared first.
    """
    sides = list(zip(*(_flat(name, width) for name in (low, high, other_low, other_high)), strict=True))
    near = F.lit(True)
    for mine, end, theirs, their_end in sides:
        near = near & (F.col(theirs) < F.col(end) + F.col("span")) & (F.col(mine) - F.col("span") < F.col(their_end))
    gaps = [
        F.greatest(F.lit(0).cast("long"), F.col(theirs) - F.col(end), F.col(mine) - F.col(their_end))
        for mine, end, theirs, their_end in sides
    ]
    return near & (sum((gap * gap for gap in gaps), F.lit(0).cast("long")) <= F.col("reach"))


def _pairs_in_reach(points: DataFrame, places: DataFrame, width: int, run: int, k: int) -> DataFrame:
    """point, other, distance and the other's first item of all pairs within reach.

    Runs of the first curve are boxes, as many runs together a coarse box. A point within
    reach is in a box within reach: coarse boxes are compared with coarse boxes, boxes of
    near ones with each other, points with near boxes, and then with what is in them.
    """
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    everything = F.lit((1 << 62) - 1)
    reach = _reached(points, places, width, run, k).select("point", F.coalesce("reach", everything).alias("reach"))
    box = F.floor(F.col("place") / run).cast("long")
    at = places.where(F.col("way") == 0).select("point", box.alias("box"))
    v, low, high = (_flat(name, width) for name in ("v", "low", "high"))
    flat = points.select("point", "group", *[F.get("v", F.lit(i)).alias(name) for i, name in enumerate(v)])
    sized = stage(flat.join(at, "point").join(reach, "point").select("*", _span("reach")), "reach")

    def ends(lows: list[str], highs: list[str]) -> list[Column]:
        least = [F.min(c).alias(name) for c, name in zip(lows, low, strict=True)]
        most = [F.max(c).alias(name) for c, name in zip(highs, high, strict=True)]
        return [*least, *most, F.max("reach").alias("reach"), F.max("span").alias("span")]

    boxes = stage(
        sized.groupBy("group", "box").agg(*ends(v, v)).withColumn("coarse", F.floor(F.col("box") / run).cast("long")),
        "boxes",
    )
    coarse = stage(boxes.groupBy("group", "coarse").agg(*ends(low, high)), "coarse")

    def beside(df: DataFrame) -> DataFrame:
        return df.drop("reach", "span").withColumnsRenamed({c: f"_{c}" for c in df.columns if c != "group"})

    close = _close("low", "high", "_low", "_high", width)
    # a fixed number of tasks: what comes in is small, what is compared is not
    regions = coarse.repartition(parts, "group", "coarse").join(beside(coarse), "group").where(close).select("group", "coarse", "_coarse")
    near_boxes = (
        boxes.join(regions.repartition(parts, "group", "coarse", "_coarse"), ["group", "coarse"])
        .join(beside(boxes), ["group", "_coarse"]).where(close)
        .select("group", "box", "_box", *[f"_{c}" for c in (*low, *high)])
    )
    within = _close("v", "v", "_low", "_high", width)
    asking = near_boxes.repartition(parts, "group", "box").join(sized, ["group", "box"]).where(within)
    held = sized.join(points.select("point", F.get("items", F.lit(0)).alias("_first")), "point").select(
        "group", F.col("box").alias("_box"), F.col("point").alias("other"), *[F.col(c).alias(f"_{c}") for c in v], "_first"
    )
    asking = asking.select("group", "_box", "point", *v, "reach").repartition(parts, "group", "_box")
    gaps = [F.col(c) - F.col(f"_{c}") for c in v]
    distance = sum((gap * gap for gap in gaps), F.lit(0).cast("long"))
    pairs = asking.join(held, ["group", "_box"]).withColumn("distance", distance)
    return pairs.where(F.col("distance") <= F.col("reach")).select("point", "other", "distance", "_first")


def _all_within(points: DataFrame, places: DataFrame, width: int, run: int, k: int) -> DataFrame:
    """point, other, items, distance: the ``k + 1`` nearest of all points."""
    order = Window.partitionBy("point").orderBy("distance", "_first")
    kept = _pairs_in_reach(points, places, width, run, k).withColumn("_nth", F.row_number().over(order))
    items = points.select(F.col("point").alias("other"), "items")
    return kept.where(F.col("_nth") <= k + 1).drop("_nth", "_first").join(items, "other")


def similar_items(
    items: DataFrame,
    k: int = K,
    exact: bool = False,
    window: int = WINDOW,
    n_curves: int = CURVES,
    steps: int = STEPS,
    seed: int = SEED,
) -> DataFrame:
    """group, item, similar: the ``k`` nearest other items of the group, nearest first.

    ``items`` has group, item and v, vectors of one length of whole numbers from 0 to
    ``steps``, one row per item of a group. Equal distances go by item. A group with
    fewer others gives them all; NULL groups match nothing and are left out. With
    ``exact`` the nearest of all are returned; else those found by windows: 0.95 of the
    true ones and more for five random components, for 3,000 items as for 100,000.
    """
    items = stage(items.where(F.col("group").isNotNull()), "items")
    first = items.select(F.size("v")).first()
    if first is None:
        return items.select("group", "item", F.array().cast("array<string>").alias("similar"))
    points, width = _points(items, k), first[0]
    moves = shifts(width, min(n_curves, REACH_CURVES) if exact else n_curves, steps, seed)
    places = stage(_places(points, moves, steps), "places")
    search = _all_within if exact else _windowed
    near = stage(search(points, places, width, window, k), "near")
    listed = near.select("point", "distance", F.explode("items").alias("name"))
    tops = top_k_arrays(listed, ["point"], [F.col("distance"), F.col("name")], k + 1, F.col("name"), "names")
    of_point = points.join(tops, "point").select("group", "v", "names")
    return items.join(stage(of_point, "similar"), ["group", "v"]).select(
        "group", "item", F.slice(F.array_remove("names", F.col("item")), 1, k).alias("similar")
    )


def attach_similar(
    records: DataFrame, similar: DataFrame, group: str = GROUP, item: str = ITEM
) -> DataFrame:
    """``records`` with ``similar_drugs``; an empty list where nothing is known."""
    found = stage(similar.select(F.col("group").alias(group), F.col("item").alias(item), "similar"), "found")
    none = F.array().cast("array<string>")
    return records.join(found, [group, item], "left").withColumn(
        "similar_drugs", F.coalesce("similar", none)
    ).select(*records.columns, *([] if "similar_drugs" in records.columns else ["similar_drugs"]))
