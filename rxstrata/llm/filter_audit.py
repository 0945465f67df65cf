"""How filters interact: every order of them, and their Shapley shares, from one lattice.

What a document fails is a bit mask, so the corpus shrinks to one count per part and
mask before anything is combined. Applying filters one after the other walks up the
lattice of their subsets: in state S the documents are left whose mask meets no filter of
S, and the edge from S to S + f removes those left that fail f. The number of orders
through an edge is the number of paths that reach S times the number that leave S + f;
with these weights the edges give the Shapley sums, and each order's steps are read from
the same edges.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxstrata.llm.text import SPACE_RUN, UPPER, bind, whole, words_between
from rxstrata.session import stage

FILTERS = "ABCDE"
REPEATED = "E"
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 3
SYMBOLS = "[#$%&*|]"


def text_failures(text: Column) -> Column:
    """Bits 0 to 3: too few words (A), too few distinct words (B), too many capitals (C),
    a symbol (D). A null text counts as empty and fails A alone."""
    text = whole(text)

    def bits(found: Column) -> Column:
        n = F.size(found)
        few = F.size(F.array_distinct(found)) * 100 < n * LEAST_DISTINCT
        return (n < LEAST_WORDS).cast("int") + few.cast("int") * 2

    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return (
        bind(words_between(text, SPACE_RUN), bits)
        + (capitals * 100 > F.length(text) * MOST_CAPITALS).cast("int") * 4
        + text.rlike(SYMBOLS).cast("int") * 8
    )


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents by language and by what they fail.

    Rows of equal text share the first four bits, so they are counted per text, part and
    label before texts meet: a text that a third of all rows hold is a few rows by then.
    A row fails E when a smaller doc_id has its text. A null doc_id is smaller than none
    and has none below it: such rows never fail E. Rows that repeat an id with its text
    pass or fail together. Several labels of one id count as one that has the largest
    value of each. A null part is the empty string; an empty table gives no rows.
    """
    of_id = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    rows = stage(
        docs.select(
            F.col("doc_id").alias("_id"),
            F.coalesce(F.col("lang"), F.lit("")).alias("part"),
            F.unhex(F.sha2(whole(F.col("text")).cast("binary"), 256)).alias("digest"),
            text_failures(F.col("text")).alias("mask"),
        ),
        "failures",
    )
    kinds = ("digest", "part", "mask", "good", "toxic")
    marked = rows.join(of_id, "_id", "left").select(
        "_id", "part", "digest", "mask",
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )
    by_kind = (
        marked.groupBy("_id", *kinds)
        .agg(F.count("*").alias("n"))
        .groupBy(*kinds)
        .agg(
            F.sum("n").alias("n"),
            F.min("_id").alias("first"),
            F.min_by("n", "_id").alias("n_first"),
            F.coalesce(F.sum(F.when(F.col("_id").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        )
    )
    smallest = F.min("first").over(Window.partitionBy("digest"))
    passing = F.col("n_null") + F.when(F.col("first") == F.col("smallest"), F.col("n_first")).otherwise(0)
    repeated = 1 << FILTERS.index(REPEATED)
    split = by_kind.withColumn("smallest", smallest).select(
        "part", "good", "toxic",
        F.explode(
            F.array(
                F.struct(F.col("mask").alias("mask"), passing.alias("n")),
                F.struct((F.col("mask") + repeated).alias("mask"), (F.col("n") - passing).alias("n")),
            )
        ).alias("of"),
    )
    return split.groupBy("part", F.col("of.mask").alias("mask")).agg(
        F.sum("of.n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("of.n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("of.n")).otherwise(0)).alias("toxic"),
    )


def path_counts(n_filters: int) -> tuple[list[int], list[int]]:
    """Per subset of the filters, as a bit mask: in how many orders it can be reached
    from the empty set, and in how many left for the full one."""
    full = (1 << n_filters) - 1
    reach, leave = [0] * (full + 1), [0] * (full + 1)
    reach[0] = leave[full] = 1
    for state in range(full + 1):
        for f in range(n_filters):
            if not state >> f & 1:
                reach[state | 1 << f] += reach[state]
    for state in range(full, -1, -1):
        for f in range(n_filters):
            if not state >> f & 1:
                leave[state] += leave[state | 1 << f]
    return reach, leave


def audit(
    counts: DataFrame,
    filters: Sequence[str] = FILTERS,
    measures: Sequence[str] = ("n", "good", "toxic"),
) -> DataFrame:
    """One row per part, order of ``filters`` (single letters) and step.

    ``counts`` has the rows per ``part`` and ``mask`` (bit i: fails ``filters[i]``) in
    the columns ``measures``, the first of which counts documents. Returned per step:
    kept, removed, redundant, unique_fails, shapley, and ``<measure>_lost`` for each
    other measure. Masks without a row count as 0; without any row there is no part.
    """
    n = len(filters)
    every = (1 << n) - 1
    if any(len(f) != 1 for f in filters) or len(set(filters)) != n:
        raise ValueError("filters are single, different letters")
    reach, leave = path_counts(n)
    spark = counts.sparkSession
    first, *others = measures

    # documents left in each state: those whose mask shares no bit with it
    states = F.sequence(F.lit(0), F.lit(every))
    left = (
        counts.select(
            "part", *measures, F.explode(F.filter(states, lambda s: s.bitwiseAND(F.col("mask")) == 0)).alias("state")
        )
        .groupBy("part", "state")
        .agg(*[F.sum(m).alias(m) for m in measures])
        .groupBy("part")
        .agg(F.map_from_entries(F.collect_list(F.struct("state", F.struct(*measures)))).alias("left"))
    )
    climbs = [
        F.struct(
            F.lit(f).alias("filter"),
            F.lit(state).alias("state"),
            F.lit(state | 1 << i).alias("next"),
            F.lit(reach[state] * leave[state | 1 << i]).cast("long").alias("paths"),
        )
        for i, f in enumerate(filters)
        for state in range(every + 1)
        if not state >> i & 1
    ]

    def count(state: str, measure: str) -> Column:
        return F.coalesce(F.col("left")[F.col(state)][measure], F.lit(0).cast("long"))

    edges = left.select("part", "left", F.explode(F.array(*climbs)).alias("edge")).select("part", "left", "edge.*")
    edges = edges.select(
        "part", "filter", "state", "paths",
        count("next", first).alias("kept"),
        (count("state", first) - count("next", first)).alias("removed"),
        *[(count("state", m) - count("next", m)).alias(f"{m}_lost") for m in others],
    )
    of_filter = Window.partitionBy("part", "filter")  # 2 ** (n - 1) edges

    def removed_from(state: Column) -> Column:
        return F.sum(F.when(F.col("state") == state, F.col("removed"))).over(of_filter)

    bit = F.element_at(F.create_map(*[F.lit(x) for i, f in enumerate(filters) for x in (f, 1 << i)]), F.col("filter"))
    edges = edges.select(
        "*",
        (removed_from(F.lit(0)) - F.col("removed")).alias("redundant"),
        removed_from(F.lit(every) - bit).alias("unique_fails"),
        F.sum(F.col("paths") * F.col("removed")).over(of_filter).alias("shapley"),
    )
    steps = [
        ("".join(order), i + 1, f, sum(1 << filters.index(g) for g in order[:i]))
        for order in permutations(filters)
        for i, f in enumerate(order)
    ]
    steps = spark.createDataFrame(steps, "filter_order string, step int, filter string, state int")
    return edges.join(steps, ["filter", "state"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        *[f"{m}_lost" for m in others], "shapley",
    )
