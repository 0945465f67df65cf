"""How far each source's use of words is from the other sources of its language.

A document's UTF-8 bytes go through one translation table that lowers A-Z and turns every
other ASCII character but the letters into a space; what stands between spaces is a
term. A ``Counter`` per document gives its counts and, by its keys, in how many documents
a term stands. Tasks add these up per language, source and term before anything is
shuffled, so the hottest term is one row per task and source.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxstrata.session import stage

LEAST_DOCS = 10
UNIT = 1_000_000_000
TOP = 10
TASK_TERMS = 400_000  # distinct (language, source, term) a task holds before it hands them on
SLICE_TERMS = 20_000  # kept terms whose shares are compared in one task
CELLS = 1 << 20  # shares of a comparison that are held at once

# fixed values: ASCII letters are parts of terms, other ASCII characters separate them
TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order; null has none."""
    return (text or "").encode().translate(TABLE).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, count, docs of what a task has read; an empty term per group."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

    def handed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (count, docs) in held.items():
            yield pa.record_batch(
                {
                    "lang": pa.array([lang] * (len(count) + 1), pa.string()),
                    "source": pa.array([source] * (len(count) + 1), pa.string()),
                    "term": pa.array([b"", *count], pa.binary()).cast(pa.string()),
                    "count": pa.array([0, *count.values()], pa.int64()),
                    "docs": pa.array([0, *map(docs.__getitem__, count)], pa.int64()),
                }
            )
        held.clear()

    for batch in batches:
        for text, lang, source in zip(*(batch.column(i) for i in range(3)), strict=True):
            count, docs = held[lang.as_py(), source.as_py()]
            found = Counter(terms(text.as_py()))
            count.update(found)
            docs.update(found.keys())
        if sum(len(count) for count, _ in held.values()) > TASK_TERMS:
            yield from handed_on()
    yield from handed_on()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, count, docs, and one row with an empty term for each group
    that occurs, also where it has no terms. Null text, lang and source are ''."""
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    return (
        plain.mapInArrow(_counted, "lang string, source string, term string, count long, docs long")
        .groupBy("lang", "source", "term")
        .agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    )


def share(count: Column, total: Column) -> Column:
    """1 + floor(UNIT * count / total) for 0 <= count <= total, by long division in three
    steps, so that nothing leaves the range of long up to totals of 9e15."""
    first = count * 1000
    second = (first % total) * 1000
    third = (second % total) * 1000
    div = lambda a: F.call_function("div", a, total)
    return div(first) * 1_000_000 + div(second) * 1000 + div(third) + 1


def _shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """``share`` of whole arrays."""
    first = counts * 1000
    second = first % totals * 1000
    third = second % totals * 1000
    return first // totals * 1_000_000 + second // totals * 1000 + third // totals + 1


def _compared(kept: pa.Table, groups: pa.Table) -> pa.Table:
    """lang, a, b, value: summed over the kept terms of one slice, for each two sources."""
    groups = groups.sort_by("source")
    lang, sources = groups["lang"][0].as_py(), groups["source"].to_pylist()
    totals = groups["total"].to_numpy()
    place = {s: i for i, s in enumerate(sources)}
    n = len(sources)
    sums = np.zeros((n, n), dtype=np.int64)
    step = max(1, CELLS // n)
    for start in range(0, kept.num_rows, step):
        entries = kept["entries"].slice(start, step).combine_chunks()
        rows = np.repeat(np.arange(len(entries)), entries.value_lengths().to_numpy())
        flat = entries.flatten()
        columns = np.array([place[s] for s in flat.field("source").to_pylist()], dtype=np.int64)
        counts = np.full((n, len(entries)), 2, dtype=np.int64)
        counts[columns, rows] += flat.field("count").to_numpy()
        p = _shares(counts, totals[:, None])
        for i in range(n - 1):
            apart = p[i] - p[i + 1 :]
            sums[i, i + 1 :] += (apart * apart // (p[i] + p[i + 1 :])).sum(axis=1)
    a, b = np.triu_indices(n, 1)
    names = pa.array(sources, pa.string())
    return pa.table(
        {
            "lang": pa.array([lang] * len(a), pa.string()),
            "a": names.take(pa.array(a)),
            "b": names.take(pa.array(b)),
            "value": pa.array(sums[a, b], pa.int64()),
        }
    )


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: sources and terms that set a source apart.

    Each language keeps the terms that stand in ``least_docs`` of its documents or more;
    every row is a document, also a repeated one. A group (a language's source) has the
    share p of a term (see ``share``, of its count + 2 in its total + 2 per kept term),
    a language q by its own counts, and two shares differ by floor((p - q)² / (p + q)).
    Part ``pair`` has, per group, each other source of its language with the sum over
    all kept terms (0 where none is kept); part ``term`` its ``top`` terms that occur in
    it more than in the language. Ranks go by falling value, then by item in UTF-8 order.
    Null text, lang and source count as ''; groups without terms take part; a language
    of one source has no pairs; an empty table gives no rows; other columns are ignored.

    Per kept term a row holds the counts of the sources that have it, and a task compares
    ``SLICE_TERMS`` of them between all sources of a language, as the result does.
    """
    cells = stage(term_counts(docs), "terms")
    groups = cells.filter("term = ''").select("lang", "source")
    kept = stage(
        cells.filter("term <> ''")
        .groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum("count").alias("count"),
            F.collect_list(F.struct("source", "count")).alias("entries"),
        )
        .filter(F.col("docs") >= least_docs)
        .drop("docs"),
        "kept-terms",
    )
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("count").alias("n"))
    langs = stage(
        groups.select("lang").distinct().join(langs, "lang", "left").select(
            "lang",
            F.coalesce("terms", F.lit(0)).alias("terms"),
            (F.coalesce("n", F.lit(0)) + 2 * F.coalesce("terms", F.lit(0))).alias("lang_total"),
        ),
        "languages",
    )
    long = kept.select("lang", "term", F.col("count").alias("in_lang"), F.explode("entries").alias("e")).select(
        "lang", "term", "in_lang", "e.*"
    )
    sizes = long.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = stage(
        groups.join(sizes, ["lang", "source"], "left")
        .join(langs, "lang")
        .select("lang", "source", "terms", "lang_total", (F.coalesce("n", F.lit(0)) + 2 * F.col("terms")).alias("total")),
        "groups",
    )

    slices = F.greatest(F.ceil(F.col("terms") / SLICE_TERMS), F.lit(1)).cast("int")
    dealt = kept.join(langs, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), slices).cast("int").alias("slice"), "entries"
    )
    everywhere = groups.select(
        "lang", "source", F.greatest("total", F.lit(1)).alias("total"),
        F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"),
    )
    pairs = (
        dealt.groupBy("lang", "slice")
        .cogroup(everywhere.groupBy("lang", "slice"))
        .applyInArrow(_compared, "lang string, a string, b string, value long")
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"))
        .select(
            "lang", "value",
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                    F.struct(F.col("b").alias("source"), F.col("a").alias("item")),
                )
            ).alias("of"),
        )
        .select("lang", "of.source", F.lit("pair").alias("part"), "of.item", "value")
    )

    p = share(F.col("count") + 2, F.col("total"))
    q = share(F.col("in_lang") + 2, F.col("lang_total"))
    telling = (
        long.join(groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
        .filter("p > q")
        .select("lang", "source", F.lit("term").alias("part"), "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    rank = F.row_number().over(by_value)
    ranked = telling.withColumn("rank", rank).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", rank).unionByName(ranked)
