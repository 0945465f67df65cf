"""Byte-level BPE: merges by recursive queries per partition, decoding by ordered aggregation."""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxstrata.llm import pieces
from rxstrata.llm.pieces import laid_out, learnt, listed_values, sliced

CHUNK_BYTES = 400_000  # bytes of pre-tokens one recursive query starts from
LONG = 64  # pre-tokens above this many bytes merge equal pairs together
STEPS = 64  # contractions per query for long pre-tokens, so that states stay bounded
CACHE_WORDS = 600_000  # pre-tokens, and segments, that a process remembers; some 200 bytes each

# Rows are (word, place, token); p packs word and place, key packs rank and place.
# One step gives every pair its rank, finds each word's smallest key, which is the
# leftmost pair of minimum rank, and contracts it. A word without pairs stops.
ONE_PAIR = """
WITH RECURSIVE s(step, p, tok) AS (
  SELECT 0, p, tok FROM state
  UNION ALL
  (WITH pairs AS MATERIALIZED (
     SELECT y.step, y.p, y.tok, y.np, (m.rank << 40) | (y.p & 1099511627775) AS key
     FROM (SELECT step, p, tok, (tok::BIGINT << 20) | lead(tok) OVER (ORDER BY p) AS ab,
                  lead(p) OVER (ORDER BY p) AS np FROM s) y
     LEFT JOIN merges m ON m.ab = y.ab AND (y.np >> 40) = (y.p >> 40)
   ), best AS (
     SELECT p >> 40 AS word, min(key) AS key, arg_min(np, key) AS gone
     FROM pairs WHERE key IS NOT NULL GROUP BY 1
   )
   SELECT step + 1, p, CASE WHEN pairs.key = best.key THEN (pairs.key >> 40)::INT ELSE tok END
   FROM pairs JOIN best ON best.word = (p >> 40) WHERE p <> gone)
), last AS (SELECT p >> 40 AS word, max(step) AS step FROM s GROUP BY 1)
SELECT s.p, s.tok, false AS open FROM s JOIN last ON last.word = (s.p >> 40) AND last.step = s.step
ORDER BY s.p
"""

# The same for long words: all places of the word's minimum-rank pair are contracted in
# one step (from the left, without overlap) where the merged token is in no pair of a
# lower rank, so that no contraction could have come in between; else the leftmost.
EQUAL_PAIRS = """
WITH RECURSIVE s(step, p, tok) AS (
  SELECT 0, p, tok FROM state
  UNION ALL
  (WITH pairs AS MATERIALIZED (
     SELECT y.step, y.p, y.tok, (m.rank << 40) | (y.p & 1099511627775) AS key, m.safe
     FROM (SELECT step, p, tok, (tok::BIGINT << 20) | lead(tok) OVER (ORDER BY p) AS ab,
                  lead(p) OVER (ORDER BY p) AS np FROM s) y
     LEFT JOIN merges m ON m.ab = y.ab AND (y.np >> 40) = (y.p >> 40)
     WHERE y.step < @steps@
   ), best AS (
     SELECT p >> 40 AS word, min(key) AS key, arg_min(safe, key) AS safe
     FROM pairs WHERE key IS NOT NULL GROUP BY 1
   ), marked AS (
     SELECT step, p, tok, pairs.key, coalesce(
              (pairs.key >> 40) = (best.key >> 40) AND (best.safe OR pairs.key = best.key), false) AS hit
     FROM pairs JOIN best ON best.word = (p >> 40)
   ), runs AS (
     SELECT *, sum((NOT hit)::INT) OVER (ORDER BY p) AS run FROM marked
   ), chosen AS (
     SELECT *, hit AND (row_number() OVER (PARTITION BY run ORDER BY p) + (run = 0)::INT) % 2 = 0 AS merge
     FROM runs
   ), spared AS (
     SELECT *, lag(merge, 1, false) OVER (ORDER BY p) AS gone FROM chosen
   )
   SELECT step + 1, p, CASE WHEN merge THEN (key >> 40)::INT ELSE tok END
   FROM spared WHERE NOT gone)
), last AS (SELECT p >> 40 AS word, max(step) AS step FROM s GROUP BY 1)
SELECT s.p, s.tok, last.step = @steps@ AS open
FROM s JOIN last ON last.word = (s.p >> 40) AND last.step = s.step
ORDER BY s.p
"""

DECODE = """
SELECT segment, from_hex(string_agg(hex, '' ORDER BY place)) AS bytes
FROM tokens JOIN vocabulary USING (tok) GROUP BY segment ORDER BY segment
"""


@functools.cache
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file (base64 and rank per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@functools.cache
def merge_table(path: str) -> pa.Table:
    """Every pair of tokens whose bytes together are a token.

    ``ab`` packs the pair, ``rank`` is the token that it becomes, ``safe`` tells that
    this token forms no pair of a lower rank.
    """
    ranks = read_ranks(path)
    left, right, whole = [], [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                whole.append(rank)
    a, b, r = (np.array(x, dtype=np.int64) for x in (left, right, whole))
    lowest = np.full(max(ranks.values()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(lowest, a, r)
    np.minimum.at(lowest, b, r)
    return pa.table({"ab": (a << 20) | b, "rank": r, "safe": lowest[r] > r})


class Coder:
    """Encodes and decodes; remembers words up to a bound.

    ``coder`` keeps one per worker process, so that a merge table is loaded once there
    and a word that one task has learnt is known to the next.
    """

    def __init__(self, path: str, pattern: str, remembered: int = CACHE_WORDS):
        import duckdb
        import regex

        self.remembered = remembered
        ranks = read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.cuts = pattern == pieces.PATTERN
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        spill = os.path.join(tempfile.gettempdir(), f"bpe-{os.getpid()}")
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": spill})
        self.db.register("merge_rows", merge_table(path))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merge_rows")
        tokens = sorted((rank, token) for token, rank in ranks.items())
        self.db.register(
            "vocabulary_rows",
            pa.table({"tok": pa.array([r for r, _ in tokens], pa.int32()), "hex": [t.hex() for _, t in tokens]}),
        )
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary_rows")
        starts = np.zeros(tokens[-1][0] + 1, dtype=bool)
        starts[[r for r, t in tokens if t[:1] in (b" ", b"\n")]] = True
        self.starts = starts
        self.words: dict[str, bytes] = {}
        self.segments: dict[bytes, bytes] = {}
        self.decimal = pa.array([b"%d " % i for i in range(len(starts))], pa.large_binary())

    # encoding

    def _contract(self, query: str, words: list[bytes]) -> list[bytes]:
        """Token ids of each word, as 4-byte integers."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        tok = self.of_byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        firsts = np.cumsum(lengths) - lengths
        place = np.arange(len(tok), dtype=np.int64) - np.repeat(firsts, lengths)
        p = (np.repeat(np.arange(len(words), dtype=np.int64), lengths) << 40) | place
        done = []
        while len(p):
            self.db.register("state", pa.table({"p": p, "tok": tok}))
            out = self.db.sql(query).to_arrow_table()
            p, tok, open_ = (out[c].to_numpy() for c in ("p", "tok", "open"))
            done.append((p[~open_], tok[~open_]))
            p, tok = p[open_], tok[open_]
        p, tok = (np.concatenate([d[i] for d in done]) for i in (0, 1))
        order = np.argsort(p, kind="stable")
        bounds = (np.searchsorted(p[order] >> 40, np.arange(len(words) + 1)) * 4).tolist()
        raw = tok[order].astype("<i4").tobytes()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def _learn(self, words: Iterable[str]) -> None:
        short: list[str] = []
        long: list[str] = []
        for word in words:
            (long if len(word.encode()) > LONG else short).append(word)
        for query, group in (
            (ONE_PAIR, short),
            (EQUAL_PAIRS.replace("@steps@", str(STEPS)), long),
        ):
            part: list[str] = []
            size = 0
            for word in [*group, None]:
                if part and (word is None or size + len(word.encode()) > CHUNK_BYTES):
                    ids = self._contract(query, [w.encode() for w in part])
                    self.words.update(zip(part, ids, strict=True))
                    part, size = [], 0
                if word is not None:
                    part.append(word)
                    size += len(word.encode())

    def _word_ids(self, words: list[str]) -> tuple[memoryview, np.ndarray]:
        """The ids of the words in their order, and each word's edges among the bytes."""
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        found = learnt(self.words, listed_values(coded.dictionary), self.remembered, self._learn)
        return laid_out(found, coded.indices.to_numpy())

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids of each text; each match of the pattern is a word of its own."""
        cuts = [bool(t) and self.cuts and not pieces.irregular(t) for t in texts]
        spaced, firsts, codes, edges = pieces.cut([t for t, c in zip(texts, cuts, strict=True) if c])
        uncut = [t or "" for t, c in zip(texts, cuts, strict=True) if not c]
        words = self.split("".join(spaced)) if spaced else []
        # the words of spaced pieces that begin with a space are the first ones of theirs
        at = [np.flatnonzero([w[0] == " " for w in words])]
        for text in (*firsts, *uncut):
            at.append([len(words)])
            words += self.split(text)
        at = np.concatenate([*at, [len(words)]]).astype(np.int64)
        data, places = self._word_ids(words)
        places = places[at]
        whole = len(spaced) + len(firsts)
        data_cut, places_cut = laid_out(sliced(data, places[: whole + 1]), codes)
        ids_cut, ids = (np.frombuffer(d, dtype="<i4") for d in (data_cut, data))
        rows_cut = zip(places_cut[edges[:-1]] // 4, places_cut[edges[1:]] // 4)
        rows = zip(places[whole:-1] // 4, places[whole + 1 :] // 4)
        return [ids_cut[slice(*next(rows_cut))] if c else ids[slice(*next(rows))] for c in cuts]

    def listed(self, ids: list[np.ndarray]) -> list[bytes]:
        """The ids of each sequence as decimals joined by one space."""
        ends = np.cumsum([0, *map(len, ids)])
        data, at = laid_out(self.decimal, np.concatenate([*ids, []]).astype(np.int64))
        return [bytes(data[a : max(a, b - 1)]) for a, b in zip(at[ends[:-1]], at[ends[1:]])]

    # decoding

    def _spell(self, new: list[bytes]) -> None:
        for i in range(0, len(new), 50_000):
            segments = new[i : i + 50_000]
            lengths = np.array([*map(len, segments)]) // 4
            self.db.register(
                "tokens",
                pa.table(
                    {
                        "segment": np.repeat(np.arange(len(segments)), lengths),
                        "place": np.arange(lengths.sum()),
                        "tok": np.frombuffer(b"".join(segments), dtype="<i4"),
                    }
                ),
            )
            found = self.db.sql(DECODE).to_arrow_table()["bytes"].to_pylist()
            self.segments.update(zip(segments, found, strict=True))

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each id sequence.

        Sequences are cut before tokens that begin with a space or a line end; equal
        segments are spelled once, their tokens aggregated in order.
        """
        ends = np.cumsum([0, *map(len, ids)])
        flat = np.concatenate([*ids, []]).astype("<i4")
        begins = self.starts[flat]
        begins[ends[:-1][ends[:-1] < len(flat)]] = True
        at = np.append(np.flatnonzero(begins), len(flat))
        coded = sliced(flat.tobytes(), at * 4).dictionary_encode()
        found = learnt(self.segments, listed_values(coded.dictionary), self.remembered, self._spell)
        data, places = laid_out(found, coded.indices.to_numpy())
        places = places[np.searchsorted(at, ends)]
        return [bytes(data[a:b]) for a, b in zip(places, places[1:])]


@functools.cache
def coder(path: str, pattern: str, remembered: int = CACHE_WORDS) -> Coder:
    """The coder of this process."""
    return Coder(path, pattern, remembered)


def slices(batch: pa.RecordBatch, sizes: np.ndarray, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes; a longer row stands alone."""
    ends = np.cumsum(sizes)
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(first, last - first)
        first = last


def text_sizes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``ids``, the token ids of the whole text (null: none).

    ``path`` is a vocabulary file that every executor can open, ``pattern`` splits a
    text into pre-tokens. Ids are not looked at and may be null or repeated.
    """

    def run(batches):
        of = coder(path, pattern)
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(1))):
                ids = of.encode(part.column(1).to_pylist())
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.concatenate(ids) if ids else np.array([], dtype=np.int32)
                listed = pa.ListArray.from_arrays(offsets, flat.astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), listed], names=["doc_id", "ids"])

    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType(
        [kept.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))]
    )
    return kept.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ``bytes`` of each row of ids; null ids decode to no bytes."""

    def run(batches):
        of = coder(path, pattern)
        for batch in batches:
            rows = batch.column(1)
            ids = [np.array(r.as_py() or [], dtype="<i4") for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(of.decode(ids), pa.binary())], names=["doc_id", "bytes"]
            )

    kept = tokens.select("doc_id", "ids")
    schema = T.StructType([kept.schema["doc_id"], T.StructField("bytes", T.BinaryType())])
    return kept.mapInArrow(run, schema)


def round_trip(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    remembered: int = CACHE_WORDS,
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text encoded, its ids decoded.

    Both directions run in one pass, so the ids of the corpus never leave the task.
    One row per input row, in any order; null and empty texts have no tokens. Ids are not
    looked at and may be null or repeated; an empty table gives no rows. A process
    remembers up to ``remembered`` words, which changes time and memory and no result.
    """

    def run(batches):
        of = coder(path, pattern, remembered)
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(1))):
                ids = of.encode(part.column(1).to_pylist())
                spelled = of.decode(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(i) for i in ids], pa.int64()),
                        pa.array([hashlib.sha256(s).hexdigest() for s in of.listed(ids)], pa.string()),
                        pa.array([hashlib.sha256(b).hexdigest() for b in spelled], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType(
        [
            kept.schema["doc_id"],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return kept.mapInArrow(run, schema)
