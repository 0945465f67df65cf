"""Edit-aware token counts: a segment tree of pre-tokens per document.

Leaves hold runs of pre-tokens, inner nodes the sums of characters and tokens below. An
edit is found by its character offset, the pre-tokens that it can touch are split anew
with their context until a boundary of the old split is met again, and only the sums on
the way up change.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxstrata.llm.bpe import read_ranks, slices, text_sizes

LEAF = 32  # pre-tokens of a leaf when the tree is built
LOOKAHEAD = 2  # characters behind its end that a pre-token's extent can depend on
CACHE_WORDS = 400_000

EDITS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("replacement", T.StringType()),
        ]
    )
)


class WordCounter:
    """Splits texts by the tokenizer's pattern and counts the tokens of a pre-token."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        self.split: Callable[[str], list[str]] = regex.compile(pattern).findall
        self.coder = tiktoken.Encoding(
            "counting", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={}
        )
        self.known: dict[str, int] = {}

    def count(self, words: Sequence[str]) -> list[int]:
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = len(self.coder.encode_ordinary(word))
        return [known[w] for w in words]


class SegmentTree:
    """The pre-tokens of one text with sums of their characters and tokens."""

    def __init__(self, text: str, counter: WordCounter):
        self.counter = counter
        self.recounted = 0
        self._plant(counter.split(text))

    def _plant(self, words: list[str]) -> None:
        counts = self.counter.count(words)
        self.leaves = [words[i : i + LEAF] for i in range(0, len(words), LEAF)] or [[]]
        self.capacity = 1 << (len(self.leaves) - 1).bit_length()
        self.chars = np.zeros(2 * self.capacity, dtype=np.int64)
        self.tokens = np.zeros(2 * self.capacity, dtype=np.int64)
        if words:
            at = np.arange(0, len(words), LEAF)
            here = slice(self.capacity, self.capacity + len(at))
            self.chars[here] = np.add.reduceat([len(w) for w in words], at)
            self.tokens[here] = np.add.reduceat(counts, at)
        level = self.capacity
        while level > 1:
            for sums in (self.chars, self.tokens):
                sums[level // 2 : level] = sums[level : 2 * level : 2] + sums[level + 1 : 2 * level : 2]
            level //= 2

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    @property
    def n_chars(self) -> int:
        return int(self.chars[1])

    def text(self) -> str:
        return "".join(w for leaf in self.leaves for w in leaf)

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """(leaf, characters before it) of the leaf that holds a character."""
        node, before = 1, 0
        while node < self.capacity:
            node *= 2
            if place - before >= self.chars[node]:
                before += int(self.chars[node])
                node += 1
        return node - self.capacity, before

    def _set_leaf(self, number: int, words: list[str], tokens: int) -> None:
        self.leaves[number] = words
        node = self.capacity + number
        self.chars[node], self.tokens[node] = sum(map(len, words)), tokens
        node //= 2
        while node:
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
            node //= 2

    def replace(self, start: int, end: int, replacement: str) -> None:
        """Replaces the characters from ``start`` up to ``end``."""
        if not 0 <= start <= end <= self.n_chars:
            raise ValueError(f"no such range: {start} to {end} of {self.n_chars}")
        safe = max(start - LOOKAHEAD, 0)
        if not self.n_chars:
            self.recounted += 1
            self._plant(self.counter.split(replacement))
            return
        first, before = self._leaf_at(min(safe, self.n_chars - 1))
        # pre-tokens that end where nothing looks into the edit stay in front
        kept = 0
        while kept < len(self.leaves[first]) and before + len(self.leaves[first][kept]) <= safe:
            before += len(self.leaves[first][kept])
            kept += 1
        head, leaf, words = self.leaves[first][:kept], first, self.leaves[first][kept:]
        place, need = before + sum(map(len, words)), end + 64
        while True:
            while place < need and leaf + 1 < len(self.leaves):
                leaf += 1
                words = words + self.leaves[leaf]
                place = before + sum(map(len, words))
            old = "".join(words)
            whole = leaf + 1 == len(self.leaves)
            new = old[: start - before] + replacement + old[end - before :]
            found = self._resynced(words, new, end - before, len(new) - len(old), whole)
            if found is not None:
                break
            need = place + 2 * (place - before) + 64
        fresh, tail = found
        self.recounted += len(fresh)
        words = head + fresh + tail
        for empty in range(first + 1, leaf + 1):
            self._set_leaf(empty, [], 0)
        if len(words) > 8 * LEAF and len(words) > 2 * LEAF * (leaf - first + 1):
            self.leaves[first] = words
            self._plant([w for part in self.leaves for w in part])
        else:
            self._set_leaf(first, words, sum(self.counter.count(words)))

    def _resynced(self, words, new: str, end: int, shift: int, whole: bool):
        """(new pre-tokens, old ones behind them): split until an old boundary behind the
        edit is a new one too; None if the context at hand is too short for that."""
        split = self.counter.split(new)
        edges = {}
        place = 0
        for i, word in enumerate(words):
            if place >= end:
                edges[place + shift] = i
            place += len(word)
        place = 0
        for i, word in enumerate(split):
            if place in edges and (whole or place + LOOKAHEAD <= len(new)):
                return split[:i], words[edges[place] :]
            place += len(word)
        return (split, []) if whole else None


def cleaning_edits(text: str) -> list[tuple[int, int, str]]:
    """Edits that delete lines equal to an earlier one and end the text with one \\n."""
    seen: set[str] = set()
    edits, place = [], 0
    for line in text.split("\n"):
        stop = place + len(line)
        if line.strip() and line in seen:
            edits.append((max(place - 1, 0), stop, ""))
        seen.add(line)
        place = stop + 1
    if text and not text.endswith("\n"):
        edits.append((len(text), len(text), "\n"))
    return edits


def count_edited(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", edits: Callable[[str], Iterable[tuple[int, int, str]]] | str = "edits") -> DataFrame:
    """Token counts before and after a document's edits.

    ``edits`` is a column of (start, end, replacement), in characters of the text as it
    is, in ascending order without overlap, or a rule that gives them for a text. Returns
    one row per input row: doc_id, n_tokens, n_tokens_after, n_edits, n_pretokens,
    n_recounted (pre-tokens that were split and counted again). Null texts are empty,
    null edits are none; a range outside its text is an error.
    """
    by_rule = callable(edits)
    given = F.lit(None).cast(EDITS) if by_rule else F.col(edits)
    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), given.alias("edits"))
    names = ["n_tokens", "n_tokens_after", "n_edits", "n_pretokens", "n_recounted"]

    def run(batches):
        counter = WordCounter(path, pattern)
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(1))):
                rows = []
                for text, listed in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    tree = SegmentTree(text or "", counter)
                    if by_rule:
                        changes = list(edits(text or ""))
                    else:
                        changes = [(e["start"], e["end"], e["replacement"] or "") for e in listed or []]
                    before, words = tree.n_tokens, sum(map(len, tree.leaves))
                    # from the back, so that offsets in front stay valid
                    for start, end, replacement in reversed(changes):
                        tree.replace(start, end, replacement)
                    rows.append((before, tree.n_tokens, len(changes), words, tree.recounted))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 5
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc_id", *names])

    schema = T.StructType([kept.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in names)])
    return kept.mapInArrow(run, schema)
