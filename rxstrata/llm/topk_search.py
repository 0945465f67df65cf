"""Exact top-k search by inner product with a table of distances to pivots.

For vectors q and x, 2 <q, x> = |q|² + |x|² - |q - x|², and by the triangle inequality
|q - x| is at least the largest | |q - p| - |x - p| | over the pivots p. So the distances
that are computed once per row bound every score from above. Rows are dealt to shards by
their nearest pivot and their distance to it; a shard's ranges of distances bound all its
rows at once. Each query is first answered in its own shard, which gives a score to beat;
the shards whose bound can reach it are then searched, rows in the order of their bounds,
until no bound that is left can.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxstrata.session import stage

SCALE = 1024
PIVOTS = 32
SAMPLE_ROWS = 2000  # pivots are chosen among so many rows; bounds hold for any choice
SHARD_ROWS = 4096
PACK_QUERIES = 4096
GROUP_SHARDS = 4096  # shards whose ranges one task holds
CHUNK = 128  # rows evaluated before the first look at the bounds; doubled each time
RESULT = "query_id long, rank int, vec_id long, score long"
FOUND = "query long, query_id long, vec_id long, row long, score long"
LONGS = np.iinfo(np.int64)


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as double; values beyond long stop at its ends."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column) -> Column:
    """Neither null nor with a null, NaN or infinite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def matrix(column: pa.ChunkedArray, width: int, kind: type) -> np.ndarray:
    """Rows of ``width`` numbers from a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, width)


def padded(lists: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of ``width`` numbers, filled up with zeros."""
    lengths = lists.value_lengths().to_numpy()
    out = np.zeros((len(lists), width), dtype=np.int64)
    rows = np.repeat(np.arange(len(lists)), lengths)
    places = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, places] = lists.flatten().to_numpy()
    return out


def far_apart(rows: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` different rows, each as far as can be from those before it."""
    rows = np.unique(rows, axis=0).astype(np.float64)
    chosen = [int(((rows - rows.mean(axis=0)) ** 2).sum(axis=1).argmax())]
    gap = ((rows - rows[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < n and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    return rows[chosen]


def _measure(pivots: np.ndarray) -> Callable:
    """Adds each row's squared length and distances to the pivots."""
    width = pivots.shape[1]

    def run(batches):
        for batch in batches:
            v = padded(batch.column("v"), width)
            real = v.astype(np.float64)
            far = np.sqrt(np.stack([((real - p) ** 2).sum(axis=1) for p in pivots], axis=1))
            nearest = far.argmin(axis=1) if len(far) else np.zeros(0, dtype=np.int64)
            yield pa.record_batch(
                {
                    "row": batch.column("row"),
                    "vec_id": batch.column("vec_id"),
                    "is_query": batch.column("is_query"),
                    "v": pa.array([x.tobytes() for x in v], pa.binary()),
                    "length": pa.array((real**2).sum(axis=1)),
                    "far": pa.array([x.tobytes() for x in far.astype(np.float32)], pa.binary()),
                    "pivot": pa.array(nearest.astype(np.int32)),
                    "near": pa.array(far[np.arange(len(far)), nearest]),
                }
            )

    return run


def slack(a: np.ndarray, b: np.ndarray) -> float:
    """More than rounding to 32 bits takes from a difference of two distances."""
    return 2.0**-21 * float(max(a.max(initial=0), b.max(initial=0)))


def upper(lengths, gaps) -> np.ndarray:
    """The largest score that squared lengths and a least distance allow, and a little."""
    lengths = np.asarray(lengths, dtype=np.float64)
    return np.floor((lengths - np.maximum(gaps, 0) ** 2) / 2 + lengths * 1e-12 + 0.5)


class Rows:
    """Vectors of a table as arrays."""

    def __init__(self, table: pa.Table, width: int, pivots: int):
        self.row = table["row"].to_numpy()
        self.no_id = np.asarray(table["vec_id"].is_null())
        self.id = table["vec_id"].fill_null(0).to_numpy()
        self.v = matrix(table["v"], width, np.int64)
        self.length = table["length"].to_numpy()
        self.far = matrix(table["far"], pivots, np.float32)
        largest = np.abs(self.v.astype(np.float64)).max(initial=0)
        # products and sums of doubles are exact below 2 ** 53
        self.exact = width * largest * largest < 2.0**52
        self.real = self.v.astype(np.float64) if self.exact else None

    def scores(self, at: np.ndarray, of: Rows, query: int) -> np.ndarray:
        """Inner products of rows with a query; those beyond long stop at its ends."""
        if self.exact and of.exact:
            return (self.real[at] @ of.real[query]).astype(np.int64)
        whole = self.v[at].astype(object) @ of.v[query].astype(object)
        return np.array([min(max(int(s), LONGS.min), LONGS.max) for s in whole], dtype=np.int64)


def best(rows: Rows, queries: Rows, query: int, k: int, least: int | None):
    """Places and scores of the ``k`` best rows for a query, its own row left out.

    Rows below ``least`` may be missing. Rows are evaluated by falling bound; as soon as
    the next bound is below the k-th score (or ``least``), all others are, too. Equal
    scores go by id, null last, then by row.
    """
    gaps = np.abs(rows.far - queries.far[query]).max(axis=1, initial=0).astype(np.float64)
    bounds = upper(rows.length + queries.length[query], gaps - slack(rows.far, queries.far[query]))
    order = np.argsort(-bounds, kind="stable")
    order = order[rows.row[order] != queries.row[query]]
    places, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    start, size = 0, CHUNK
    while start < len(order):
        if least is not None and bounds[order[start]] < least:
            break
        at = order[start : start + size]
        found = rows.scores(at, queries, query)
        if least is not None:
            at, found = at[found >= least], found[found >= least]
        places, scores = np.concatenate([places, at]), np.concatenate([scores, found])
        ranked = np.lexsort((rows.row[places], rows.id[places], rows.no_id[places], ~scores))[:k]
        places, scores = places[ranked], scores[ranked]
        if len(scores) == k:
            least = int(scores[-1])
        start, size = start + size, 2 * size
    return places, scores


def found_table(rows: Rows, queries: Rows, hits: list) -> pa.Table:
    """The answers [(query, places, scores)] as rows."""
    of = np.repeat([q for q, _, _ in hits], [len(p) for _, p, _ in hits]).astype(np.int64)
    at = np.concatenate([p for _, p, _ in hits] or [np.zeros(0)]).astype(np.int64)
    scores = np.concatenate([s for _, _, s in hits] or [np.zeros(0)]).astype(np.int64)
    return pa.table(
        {
            "query": pa.array(queries.row[of], pa.int64()),
            "query_id": pa.array(queries.id[of], pa.int64(), mask=queries.no_id[of]),
            "vec_id": pa.array(rows.id[at], pa.int64(), mask=rows.no_id[at]),
            "row": pa.array(rows.row[at], pa.int64()),
            "score": pa.array(scores, pa.int64()),
        }
    )


def _at_home(width: int, pivots: int, k: int) -> Callable:
    """Answers the queries of a shard from the shard itself."""

    def run(table: pa.Table) -> pa.Table:
        rows = Rows(table, width, pivots)
        hits = [(q, *best(rows, rows, q, k, None)) for q in np.flatnonzero(table["is_query"].to_numpy())]
        return found_table(rows, rows, hits)

    return run


def _ranges(width: int, pivots: int) -> Callable:
    """The ranges of a shard: least and largest distance to each pivot, largest length."""

    def run(table: pa.Table) -> pa.Table:
        far = matrix(table["far"], pivots, np.float32)
        return pa.table(
            {
                "shard": table["shard"].slice(0, 1),
                "low": pa.array([far.min(axis=0).tobytes()], pa.binary()),
                "high": pa.array([far.max(axis=0).tobytes()], pa.binary()),
                "length": pa.array([float(table["length"].to_numpy().max())]),
            }
        )

    return run


def _routes(pivots: int) -> Callable:
    """Which of some shards can hold a row that reaches a query's score to beat."""

    def run(shards: pa.Table, queries: pa.Table) -> pa.Table:
        pairs_q, pairs_s = [], []
        if shards.num_rows and queries.num_rows:
            number, low = shards["shard"].to_numpy(), matrix(shards["low"], pivots, np.float32)
            high, longest = matrix(shards["high"], pivots, np.float32), shards["length"].to_numpy()
            far, length = matrix(queries["far"], pivots, np.float32), queries["length"].to_numpy()
            home = queries["shard"].to_numpy()
            for q, least in enumerate(queries["least"].to_pylist()):
                gaps = np.maximum(low - far[q], far[q] - high).max(axis=1).astype(np.float64)
                bounds = upper(longest + length[q], gaps - slack(high, far[q]))
                to = number[(number != home[q]) & (bounds >= (LONGS.min if least is None else least))]
                pairs_q.append(np.full(len(to), queries["row"][q].as_py(), dtype=np.int64))
                pairs_s.append(to)
        join = lambda parts, kind: pa.array(np.concatenate([*parts, np.zeros(0, dtype=kind)]).astype(kind))
        return pa.table({"query": join(pairs_q, np.int64), "to": join(pairs_s, np.int32)})

    return run


def _abroad(width: int, pivots: int, k: int) -> Callable:
    """Answers the queries that were sent to a shard."""

    def run(table: pa.Table, asking: pa.Table) -> pa.Table:
        rows, queries = Rows(table, width, pivots), Rows(asking, width, pivots)
        hits = [(q, *best(rows, queries, q, k, least)) for q, least in enumerate(asking["least"].to_pylist())]
        return found_table(rows, queries, hits)

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    n_pivots: int = PIVOTS,
    shard_rows: int = SHARD_ROWS,
    pack_queries: int = PACK_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of highest integer inner product.

    Queries are the rows where ``is_query`` holds, candidates all rows but the query's
    own; ties go to the smaller id, null ids last. Vectors that are null or hold a null,
    NaN or infinite component take no part. Vectors of different lengths are filled up
    with zeros; an empty one scores 0. Components and scores beyond the range of long
    stop at its ends. Rows that repeat an id are rows of their own: each is a candidate
    of the other, and, as queries, each has its own ranks. A query without other rows has
    no answer; an empty table gives none. Columns but the two named ones are ignored.

    A task holds a shard and the queries of a pack that are sent to it. The queries meet
    the shards in blocks; which blocks meet is decided by the bounds.
    """
    ok = vectors.filter(usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
        integers(F.col(vector_col), scale).alias("v"),
    )
    spark = vectors.sparkSession
    n_rows, n_queries, width = ok.agg(F.count("*"), F.count_if("is_query"), F.max(F.size("v"))).first()
    if not n_queries:
        return spark.createDataFrame([], RESULT)
    width = max(width, 1)
    sample = ok.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE_ROWS).toArrow()["v"].combine_chunks()
    pivots = far_apart(padded(sample, width), n_pivots)
    p = len(pivots)

    measured = (
        ok.withColumn("row", F.monotonically_increasing_id())
        .mapInArrow(
            _measure(pivots),
            "row long, vec_id long, is_query boolean, v binary, length double, far binary, pivot int, near double",
        )
        .repartitionByRange(math.ceil(n_rows / shard_rows), "pivot", "near", "row")
        .withColumn("shard", F.spark_partition_id())
    )
    index = stage(measured.drop("pivot", "near"), "pivot-table")
    shards = stage(
        index.select("shard", "length", "far").groupBy("shard").applyInArrow(
            _ranges(width, p), "shard int, low binary, high binary, length double"
        ),
        "shards",
    )
    at_home = stage(index.groupBy("shard").applyInArrow(_at_home(width, p, k), FOUND), "at-home")

    beaten = at_home.groupBy(F.col("query").alias("row")).agg(
        F.when(F.count("*") == k, F.min("score")).alias("least")
    )
    packs = math.ceil(n_queries / pack_queries)
    queries = stage(
        index.filter("is_query").join(beaten, "row", "left").withColumn(
            "pack", F.pmod(F.xxhash64("row"), F.lit(packs)).cast("int")
        ),
        "queries",
    )
    groups = math.ceil(shards.count() / GROUP_SHARDS)
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    routes = stage(
        shards.withColumn("of", F.pmod("shard", F.lit(groups)))
        .withColumn("pack", spread(packs))
        .groupBy("of", "pack")
        .cogroup(
            queries.select("row", "length", "far", "shard", "least", "pack")
            .withColumn("of", spread(groups))
            .groupBy("of", "pack")
        )
        .applyInArrow(_routes(p), "query long, to int"),
        "routes",
    )
    sent = routes.join(queries.drop("shard"), routes["query"] == queries["row"]).drop("query")
    wanted = sent.select(F.col("to").alias("shard"), F.col("pack").alias("for")).distinct()
    abroad = (
        index.join(wanted, "shard")
        .groupBy("shard", "for")
        .cogroup(sent.groupBy("to", "pack"))
        .applyInArrow(_abroad(width, p, k), FOUND)
    )
    by_score = Window.partitionBy("query").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("row")
    )
    return (
        at_home.unionByName(abroad)
        .withColumn("rank", F.row_number().over(by_score))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
