"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal updates."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxstrata.llm.bpe import slices, text_sizes
from rxstrata.llm.hashing import LOWER, buffers, mix, ngram_hashes, span_hashes, word_spans

BITS = 18
SAMPLE_ROWS = 4000  # labelled rows a model is fitted on, at most
UPDATES = 16_000  # single-row updates of a fit: small samples are passed over more often
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1e-4, 1e-4
FOLDS = 5

# characters by kind: letters and bytes beyond ASCII alike, digits alike, others apart
KIND = np.arange(256, dtype=np.uint8)
KIND[ord("a") : ord("z") + 1] = KIND[ord("A") : ord("Z") + 1] = ord("a")
KIND[0x80:] = ord("a")
KIND[ord("0") : ord("9") + 1] = ord("0")


def held_out(id_col: Column) -> Column:
    """Rows no label is learnt from: crc32 of the id as text leaves no remainder by 5."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash per word of its character kinds, runs of one kind counted once."""
    kinds = KIND[data]
    fresh = np.ones(len(data), dtype=bool)
    fresh[1:] = kinds[1:] != kinds[:-1]
    fresh[starts] = True
    place = np.concatenate([[0], np.cumsum(fresh)])
    return span_hashes(kinds[fresh], place[starts], place[ends])


def features(column: pa.Array, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Groups of hashed n-grams of each text, as (feature, bounds by text).

    Groups: words, word pairs, word shapes, shape pairs, and three-word windows marked
    as new or seen before in the text. A group's values are shares, so that long and
    short texts compare; a text without n-grams has an all-zero group.
    """
    data, bounds = buffers(column)
    starts, ends, edges = word_spans(data, bounds)
    words = span_hashes(LOWER[data], starts, ends)
    shapes = _shapes(data, starts, ends)
    groups = []
    for salt, (hashes, n) in enumerate(((words, 1), (words, 2), (shapes, 1), (shapes, 2))):
        grams, at = ngram_hashes(hashes, edges, n)
        groups.append((mix(grams + np.uint64(salt)) >> np.uint64(64 - bits), at))
    grams, at = ngram_hashes(words, edges, 3)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((grams, text))
    seen = np.zeros(len(grams), dtype=bool)
    same = (grams[order][1:] == grams[order][:-1]) & (text[order][1:] == text[order][:-1])
    seen[order[1:][same]] = True
    groups.append((mix(seen.astype(np.uint64) + np.uint64(99)) >> np.uint64(64 - bits), at))
    return [(g.astype(np.int64), at) for g, at in groups]


@dataclass(frozen=True)
class Model:
    """Weights of the hashed features, the last one the intercept."""

    weights: np.ndarray
    bits: int = BITS

    def scores(self, column: pa.Array) -> np.ndarray:
        """Probability of label 1 per text: sparse dot products over the shares."""
        total = np.full(len(column), float(self.weights[-1]))
        for grams, at in features(column, self.bits):
            counts = np.diff(at)
            sums = np.concatenate([[0.0], np.cumsum(self.weights[grams])])
            total += (sums[at[1:]] - sums[at[:-1]]) / np.maximum(counts, 1)
        return 1.0 / (1.0 + np.exp(-np.clip(total, -60, 60)))


def sparse_rows(column: pa.Array, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(feature, share) of each text, features distinct."""
    groups = features(column, bits)
    rows = []
    for i in range(len(column)):
        parts = [g[at[i] : at[i + 1]] for g, at in groups]
        shares = [np.full(len(p), 1.0 / max(len(p), 1)) for p in parts]
        index, inverse = np.unique(np.concatenate(parts), return_inverse=True)
        rows.append((index.astype(np.int32), np.bincount(inverse, np.concatenate(shares), len(index))))
    return rows


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int = BITS, updates: int = UPDATES) -> Model:
    """Follow-the-regularised-leader with a learning rate and a sparse weight per feature."""
    z, n = np.zeros(2**bits + 1), np.zeros(2**bits + 1)

    def weights(i):
        pull = np.sign(z[i]) * L1 - z[i]
        return np.where(np.abs(z[i]) <= L1, 0.0, pull / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    bias = np.array([2**bits])
    for _ in range(-(-updates // max(len(rows), 1)) if rows else 0):
        for (index, share), y in zip(rows, labels, strict=True):
            i, x = np.concatenate([index, bias]), np.concatenate([share, [1.0]])
            w = weights(i)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -60, 60)))
            g = (p - y) * x
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - step * w
            n[i] += g * g
    return Model(weights(np.arange(2**bits + 1)).astype(np.float64), bits)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, bits: int = BITS) -> Model:
    """A model from labelled documents outside the held-out fold.

    At most ``sample_rows`` labelled ids, the smallest by hash, are joined with their
    whole texts; their hashed features, one row an id (of a repeated id the smallest),
    are what reaches the driver. Null labels are left out, of contradicting labels the larger counts. Without labelled rows every
    score is one half. Labels, lang, source and doc_id are no inputs of a score.
    """
    chosen = (
        labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max(label_col).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample_rows)
    )

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(2))):
                found = sparse_rows(part.column(2), bits)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([i.tobytes() for i, _ in found], pa.binary()),
                        pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary()),
                    ],
                    names=["id", "label", "features", "shares"],
                )

    # sample_rows bounds this side, so it is safe to broadcast
    texts = docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text")).join(
        F.broadcast(chosen), F.col("_doc") == F.col("_id")
    )
    sample = (
        texts.select(F.col("_id").cast("long"), "_label", "_text")
        .mapInArrow(run, "id long, label int, features binary, shares binary")
        # an id may be repeated: one row of each, so that sample_rows bounds what is collected
        .groupBy("id", "label")
        .agg(F.min(F.struct("features", "shares")).alias("row"))
        .select("id", "label", "row.features", "row.shares")
        .collect()
    )
    # an order of its own, so that the model does not depend on how rows arrive
    seen = sorted({(r.id, r.label, bytes(r.features), bytes(r.shares)) for r in sample})
    order = np.random.default_rng(7).permutation(len(seen))
    seen = [seen[k] for k in order]
    rows = [(np.frombuffer(f, np.int32), np.frombuffer(s, "<f4").astype(float)) for _, _, f, s in seen]
    return fit_ftrl(rows, np.array([label for _, label, _, _ in seen], dtype=float), bits)


def with_scores(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with one more column, the probability of label 1; null scores as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** bits weights
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(at))):
                scores = pa.array(shared.value.scores(part.column(at)), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, scores], names=[*part.schema.names, score_col]
                )

    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    return docs.mapInArrow(run, schema)




def keep_good(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows that score ``least`` or more, with their own columns."""
    score = "_score"
    while score in docs.columns:
        score += "_"
    return with_scores(docs, model, text_col, score).filter(F.col(score) >= least).drop(score)
