"""Word and shingle hashes of whole Arrow text columns, without a Python loop over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

MULTIPLIER = 0x9E3779B97F4A7C15
ODD = tuple((MULTIPLIER * k * k + 2 * k + 1 | 1) % 2**64 for k in (1, 3, 7, 13, 21))

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the multiplier, modulo 2 ** 64."""
    global _powers
    if len(_powers) < n:
        factors = np.full(max(n, 64), MULTIPLIER, dtype=np.uint64)
        factors[0] = 1
        _powers = np.cumprod(factors, dtype=np.uint64)
    return _powers[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, text bounds) of a string column; nulls are empty texts."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def word_spans(data: np.ndarray, bounds: np.ndarray):
    """(first byte, byte after) of each word, and the texts' bounds in words."""
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        heads = bounds[:-1][bounds[:-1] < len(data)]
        first[heads] = inside[heads]
        tails = bounds[1:][bounds[1:] > 0] - 1
        last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span."""
    lengths = ends - starts
    if not len(lengths):
        return np.zeros(0, dtype=np.uint64)
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(firsts, lengths)
    chars = data[place + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)
    sums = np.add.reduceat(chars * powers(int(lengths.max()))[place], firsts)
    return mix(sums + lengths.astype(np.uint64) * np.uint64(ODD[4]))


def ngram_hashes(words: np.ndarray, bounds: np.ndarray, n: int):
    """Hashes of each text's ``n``-word windows and the texts' bounds in them."""
    counts = np.maximum(np.diff(bounds) - n + 1, 0)
    edges = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(edges[-1]) - np.repeat(edges[:-1], counts) + np.repeat(bounds[:-1], counts)
    total = np.zeros(len(at), dtype=np.uint64)
    for k in range(n):
        total += words[at + k] * np.uint64(ODD[k])
    return mix(total + np.uint64(n)), edges
