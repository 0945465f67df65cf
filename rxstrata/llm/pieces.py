"""Texts cut before spaces, so that each distinct piece of a batch is looked up once."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Byte-level pre-tokens as the public tokenizers split them: none holds a space after
# something else than white space, none looks ahead but from white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: White space before a space or at the end: such texts stay uncut.
irregular = re.compile(r"\s |\s\Z").search


def cut(texts: Sequence[str]) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
    """(pieces that begin with a space, first pieces, codes, edges) of texts that may be cut.

    Each text is cut before its spaces; pieces are distinct. Codes number the pieces in the
    order of the texts, first pieces after the others; text i has those from edges[i].
    """
    listed = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    edges = listed.offsets.to_numpy().astype(np.int64)
    values = listed.flatten()
    coded, firsts = values.dictionary_encode(), values.take(pa.array(edges[:-1])).dictionary_encode()
    n = len(coded.dictionary)
    codes = coded.indices.to_numpy().astype(np.int64)
    codes[edges[:-1]] = n + firsts.indices.to_numpy()
    used = np.zeros(n + len(firsts.dictionary), dtype=bool)
    used[codes] = True
    # a word may be there as a first piece alone
    inner = coded.dictionary.filter(pa.array(used[:n]))
    spaced = pc.binary_join_element_wise(pa.scalar("", inner.type), inner, pa.scalar(" ", inner.type))
    return listed_values(spaced), listed_values(firsts.dictionary), (np.cumsum(used) - 1)[codes], edges


def listed_values(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


def learnt(known: dict, keys: list, bound: int, learn: Callable[[list], None]) -> list[bytes]:
    """What is known of each key; ``learn`` adds the keys that are not known.

    Beyond the bound only what these keys use again stays, so common ones are not learnt anew.
    """
    found = [*map(known.get, keys)]
    new = [i for i, entry in enumerate(found) if entry is None]
    if len(known) + len(new) > bound:
        known.clear()
        known.update((key, entry) for key, entry in zip(keys, found) if entry is not None)
    learn([keys[i] for i in new])
    for i in new:
        found[i] = known[keys[i]]
    return found


def laid_out(table: pa.Array | Sequence[bytes], codes: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The table's entries in the order of the codes, without gaps, and their edges."""
    if not isinstance(table, pa.Array):
        table = pa.array(table, pa.large_binary())
    taken = table.take(pa.array(codes, pa.int64()))
    if not len(taken):
        return memoryview(b""), np.zeros(1, np.int64)
    _, edges, data = taken.buffers()
    return memoryview(data or b""), np.frombuffer(edges, np.int64)[taken.offset :][: len(taken) + 1]


def sliced(data: memoryview | bytes, edges: np.ndarray) -> pa.Array:
    """The entries between the edges of the data."""
    edges = np.ascontiguousarray(edges, dtype=np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)])
