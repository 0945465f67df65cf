"""Size-aware heavy-light Jaccard join of word n-gram sets.

The work runs over distinct sets (nodes), named by 64 bits of a digest of the set, so
copies cost nothing after the first pass:

1. ``summaries``: per document its node and set size.
2. ``shared_keys``: n-grams that two or more nodes have, and in how many, from an
   inverted index that is shuffled in compressed blocks dealt evenly by key. N-grams of
   one node can be in no intersection and end there; a node with too few others has no
   partner and ends too.
3. ``lists``: light (small) sets enter one list per two-element subset of their rarest
   n-grams, heavy ones the inverted list of each of their rarest n-grams. The size at
   which scanning lists becomes cheaper than enumerating subsets is the boundary.
   Every linked pair shares a list.
4. ``links``: each node is compared with the most central node of its lists; what is
   not connected by that is compared per centre, in a grid of bounded slices and blocks,
   by scanning lists of all shared n-grams, which counts exact intersections.
5. Components of the links.

N-grams are compared by 48 bits of their hash, which matters only within a pair.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxstrata.llm.bpe import slices, text_sizes
from rxstrata.llm.components import components
from rxstrata.llm.hashing import LOWER, buffers, mix, ngram_hashes, span_hashes, word_spans
from rxstrata.session import stage

WORDS = 5
PERCENT = 75
KEY_BITS = 48
CHUNK = 4_000_000  # n-grams that a task indexes at a time
BLOCK_BYTES = 32_000_000  # n-grams of one centre that a task holds, and that ask there, in bytes


def text_sets(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): each text's distinct ``words``-grams, sorted; with fewer words
    the whole sequence is one; a text without words has none."""
    data, bounds = buffers(column)
    starts, ends, edges = word_spans(data, bounds)
    hashes = span_hashes(LOWER[data], starts, ends)
    counts = np.diff(edges)
    grams, at = ngram_hashes(hashes, edges, words)
    all_grams, owners = [grams], [np.repeat(np.arange(len(counts)), np.diff(at))]
    for n in range(1, words):
        few = np.flatnonzero(counts == n)
        if len(few):
            grams, at = ngram_hashes(hashes, edges, n)
            all_grams.append(grams[at[few]])
            owners.append(few)
    grams, owner = np.concatenate(all_grams), np.concatenate(owners)
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    fresh = np.ones(len(grams), dtype=bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[fresh], owner[fresh]
    return grams, np.searchsorted(owner, np.arange(len(counts) + 1))


def node_of(grams: np.ndarray) -> int:
    """The name of a set: 63 bits of a digest of its sorted hashes."""
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little") >> 1


def summaries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, node (null for the empty set) of every document."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(1))):
                grams, at = text_sets(part.column(1), words)
                sizes = np.diff(at)
                nodes = [node_of(grams[a:b]) if b > a else None for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())],
                    names=["doc_id", "n_shingles", "node"],
                )

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(run, "doc_id long, n_shingles long, node long")


# blocks of an inverted index


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each value, byte by byte, which compresses well."""
    raw = np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(raw[:, :width].T).tobytes()


def _values(data: bytes, n: int, width: int) -> np.ndarray:
    raw = np.zeros((n, 8), dtype=np.uint8)
    raw[:, :width] = np.frombuffer(data, dtype=np.uint8, count=n * width).reshape(width, n).T
    return raw.reshape(-1).view("<u8")


def pack(keys: np.ndarray, weights: np.ndarray, owners: np.ndarray, nodes: np.ndarray, sizes: np.ndarray) -> bytes:
    """A compressed block: entries (key, weight, place of the node) and the nodes with
    their set sizes. Keys need not be sorted, but sorted ones compress better."""
    import zstandard

    steps = np.diff(keys.astype(np.int64), prepend=0).astype(np.uint64) & np.uint64(2**KEY_BITS - 1)
    body = b"".join(
        (
            _planes(steps, 6),
            _planes(weights, 1),
            _planes(owners, 4),
            _planes(nodes, 8),
            _planes(sizes, 5),
        )
    )
    return struct.pack("<II", len(keys), len(nodes)) + zstandard.ZstdCompressor(level=1).compress(body)


def unpack(block: bytes):
    """(keys, weights, owners, nodes, sizes) of a block."""
    import zstandard

    n, m = struct.unpack_from("<II", block)
    body = zstandard.ZstdDecompressor().decompress(block[8:])
    out, at = [], 0
    for count, width in ((n, 6), (n, 1), (n, 4), (m, 8), (m, 5)):
        out.append(_values(body[at : at + count * width], count, width))
        at += count * width
    out[0] = np.cumsum(out[0], dtype=np.uint64) & np.uint64(2**KEY_BITS - 1)
    return out


def even_keys(spark: SparkSession, parts: int) -> list[int]:
    """One number per partition that ``repartition(parts, number)`` puts there."""
    tried = 32 * parts
    while True:
        found = (
            spark.range(tried).groupBy(F.pmod(F.hash("id"), F.lit(parts)).alias("part")).agg(F.min("id")).collect()
        )
        if len(found) == parts:
            return [key for _, key in sorted(tuple(r) for r in found)]
        tried *= 2


def _blocks(batches) -> Iterator[bytes]:
    for batch in batches:
        yield from batch.column(1).to_pylist()


def _gathered(blocks: Iterator[bytes]):
    """All entries of some blocks with nodes numbered once: keys, weights, owners,
    nodes, sizes."""
    keys, weights, owners, nodes, sizes = [], [], [], [], []
    base = 0
    for block in blocks:
        k, w, o, n, s = unpack(block)
        keys.append(k)
        weights.append(w.astype(np.uint8))
        owners.append((o + np.uint64(base)).astype(np.uint32))
        nodes.append(n)
        sizes.append(s)
        base += len(n)
    if not keys:
        return None
    nodes, sizes = np.concatenate(nodes), np.concatenate(sizes)
    nodes, first, number = np.unique(nodes, return_index=True, return_inverse=True)
    owner = number.astype(np.uint32)[np.concatenate(owners)]
    return np.concatenate(keys), np.concatenate(weights), owner, nodes, sizes[first]


def shared_keys(docs: DataFrame, text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Nodes that may have a partner: node, n (set size), keys, c, rank, light, heavy.

    ``keys`` holds, rarest first, the hashes of the n-grams that other nodes share, as
    8-byte integers, ``c`` their number; nodes where 100 c < percent n are left out.
    ``rank`` orders nodes by how common their n-grams are, ``light`` and ``heavy`` are
    the costs of entering subsets and of scanning inverted lists.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    deal = even_keys(spark, parts)

    def index(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        names: list[int] = []
        seen: set[int] = set()
        size = 0

        def flush():
            keys = np.concatenate([k for k, _ in held])
            owner = np.repeat(np.arange(len(held)), [len(k) for k, _ in held])
            nodes = np.array(names, dtype=np.uint64)
            sizes = np.array([n for _, n in held], dtype=np.uint64)
            order = np.argsort(keys, kind="stable")
            keys, owner = keys[order], owner[order]
            part = ((keys >> np.uint64(16)) * np.uint64(parts)) >> np.uint64(KEY_BITS - 16)
            edges = np.searchsorted(part, np.arange(parts + 1))
            out = []
            for b in range(parts):
                at = slice(edges[b], edges[b + 1])
                if at.start < at.stop:
                    used, place = np.unique(owner[at], return_inverse=True)
                    block = pack(keys[at], np.zeros(at.stop - at.start), place, nodes[used], sizes[used])
                    out.append((deal[b], block))
            return out

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())],
                names=["bucket", "block"],
            )

        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(0))):
                grams, at = text_sets(part.column(0), words)
                for a, b in zip(at[:-1], at[1:]):
                    # sets of one element have no partner but their copies
                    if b - a < 2 or (node := node_of(grams[a:b])) in seen:
                        continue
                    seen.add(node)
                    names.append(node)
                    held.append((np.unique(grams[a:b] >> np.uint64(64 - KEY_BITS)), b - a))
                    size += b - a
                    if size >= CHUNK:
                        yield batch_of(flush())
                        held, names, size = [], [], 0
                        seen.clear()
        if held:
            yield batch_of(flush())

    def count(batches):
        found = _gathered(_blocks(batches))
        if found is None:
            return
        keys, _, owner, nodes, sizes = found
        order = np.lexsort((owner, keys))
        keys, owner = keys[order], owner[order]
        fresh = np.ones(len(keys), dtype=bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        keys, owner = keys[fresh], owner[fresh]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        df = np.diff(np.concatenate([starts, [len(keys)]]))
        weight = np.repeat(np.floor(4 * np.log2(df)).astype(np.uint8), df)
        kept = np.repeat(df > 1, df)
        keys, owner, weight = keys[kept], owner[kept], weight[kept]
        target = (nodes % np.uint64(parts)).astype(np.int64)[owner]
        order = np.lexsort((keys, owner, target))
        keys, owner, weight, target = keys[order], owner[order], weight[order], target[order]
        edges = np.searchsorted(target, np.arange(parts + 1))
        for b in range(parts):
            at = slice(edges[b], edges[b + 1])
            if at.start < at.stop:
                used, place = np.unique(owner[at], return_inverse=True)
                block = pack(keys[at], weight[at], place, nodes[used], sizes[used])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([deal[b]], pa.int64()), pa.array([block], pa.binary())], names=["bucket", "block"]
                )

    def survive(batches):
        found = _gathered(_blocks(batches))
        if found is None:
            return
        keys, weight, owner, nodes, sizes = found
        order = np.lexsort((keys, weight, owner))
        keys, weight, owner = keys[order], weight[order], owner[order]
        edges = np.searchsorted(owner, np.arange(len(nodes) + 1))
        rows = []
        for i in range(len(nodes)):
            a, b, n = int(edges[i]), int(edges[i + 1]), int(sizes[i])
            if 100 * (b - a) < percent * n:
                continue
            single = prefix(n, b - a, 1, percent)
            pairs = prefix(n, b - a, 2, percent)
            own = weight[a:b].astype(np.float64)
            central = min(int(own.mean() * 64), 2**14 - 1)
            rows.append(
                (
                    int(nodes[i]),
                    n,
                    b - a,
                    (central << 48) | (int(nodes[i]) & (2**48 - 1)),
                    pairs * (pairs - 1) / 2,
                    single + float(own[:single].sum() / 4),
                    keys[a:b].astype("<u8").tobytes(),
                )
            )
            if len(rows) == 2000:
                yield survivors(rows)
                rows = []
        if rows:
            yield survivors(rows)

    def survivors(rows):
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
        names = ["node", "n", "c", "rank", "light", "heavy", "keys"]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    blocks = "bucket long, block binary"
    return (
        docs.select(F.col(text_col).alias("text"))
        .mapInArrow(index, blocks)
        .repartition(parts, "bucket")
        .mapInArrow(count, blocks)
        .repartition(parts, "bucket")
        .mapInArrow(
            survive, "node long, n long, c long, rank long, light double, heavy double, keys binary"
        )
    )


def prefix(n: int, c: int, share: int, percent: int = PERCENT) -> int:
    """How many of a set's shared n-grams, rarest first, hold ``share`` of any partner's.

    A partner has at least ceil(percent n / 100) of the set's n-grams, so all but
    ``n`` minus that; the n - c unshared ones come first in the order and are skipped.
    """
    missing = n - -(-percent * n // 100)
    return min(c, missing + share - (n - c))


def boundary(sets: DataFrame) -> int:
    """The largest size of a light set, at which the two costs together are least.

    A light set costs a row per subset. A heavy one costs, per inverted list, its own row
    and the logarithm of the list's length: lists are combined towards their centre, and
    nobody is paired with everyone in them. Costs are summed per eighth of a power of two of the size: a few hundred rows.
    """
    sums = sorted(
        tuple(r)
        for r in sets.groupBy(F.floor(8 * F.log2("n")).alias("step"))
        .agg(F.max("n"), F.sum("light"), F.sum("heavy"))
        .collect()
    )
    heavy = sum(r[3] for r in sums)
    best, limit, light = heavy, 0, 0.0
    for _, largest, light_cost, heavy_cost in sums:
        light, heavy = light + light_cost, heavy - heavy_cost
        if light + heavy < best:
            best, limit = light + heavy, largest
    return limit


def lists(sets: DataFrame, limit: int, percent: int = PERCENT) -> DataFrame:
    """key, node, rank: the lists that each set enters.

    Sets up to ``limit`` are light. Those that a heavy set could link with enter the
    inverted lists too: a partner of a set of n elements has at most 100 n / percent.
    """

    def run(batches):
        for batch in batches:
            keys, nodes, ranks = [], [], []
            for node, n, c, rank, raw in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                own = np.frombuffer(raw, dtype="<u8")
                found = []
                if n <= limit:
                    first = mix(own[: prefix(n, c, 2, percent)])
                    i, j = np.triu_indices(len(first), 1)
                    found.append(mix(first[i] + np.uint64(3) * first[j]) >> np.uint64(1))
                if 100 * n > percent * limit:
                    found.append(mix(own[: prefix(n, c, 1, percent)] + np.uint64(1)) >> np.uint64(1))
                entries = np.concatenate(found)
                keys.append(entries)
                nodes.append(np.full(len(entries), node))
                ranks.append(np.full(len(entries), rank))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys).astype(np.int64)),
                        pa.array(np.concatenate(nodes), pa.int64()),
                        pa.array(np.concatenate(ranks), pa.int64()),
                    ],
                    names=["key", "node", "rank"],
                )

    return sets.select("node", "n", "c", "rank", "keys").mapInArrow(run, "key long, node long, rank long")


def similar(inter, a, b, percent: int = PERCENT):
    """Whether sets of ``a`` and ``b`` elements with ``inter`` in common are linked."""
    return 100 * inter >= percent * (a + b - inter)


def star_links(assigned: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """a, b: the (node, centre) pairs that are linked."""

    def run(batches):
        for batch in batches:
            good = [
                similar(
                    len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True)), n, m, percent
                )
                for n, x, m, y in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True)
            ]
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"]
            )

    own = sets.select("node", "n", "keys")
    centre = sets.select(F.col("node").alias("centre"), F.col("n").alias("m"), F.col("keys").alias("centre_keys"))
    pairs = assigned.join(own, "node").join(centre, "centre")
    return pairs.select("node", "centre", "n", "keys", "m", "centre_keys").mapInArrow(run, "a long, b long")


def dealt_cells(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """centre, block, slice, node, part, asks, member: the comparisons of ``block_links``.

    A pair of different parts has a node outside the centre's part; those ask, and are
    compared with every member. Members are dealt over blocks and asking nodes over
    slices of about ``BLOCK_BYTES`` of n-grams (by a hash, and a set stays whole), so
    each task of the grid of slices and blocks holds one block and reads one slice.
    """
    sized = cells.join(sets.select("node", "c"), "node")
    per_part = sized.groupBy("centre", "part").agg(
        F.sum("c").alias("c"), F.bool_or(F.col("node") == F.col("centre")).alias("has_centre")
    )

    def groups(size):
        return F.greatest(F.ceil(F.coalesce(size, F.lit(0)) * 8 / BLOCK_BYTES), F.lit(1)).cast("int")

    open_cells = (
        per_part.groupBy("centre")
        .agg(
            F.count("*").alias("parts"),
            F.max(F.when(F.col("has_centre"), F.col("part"))).alias("home"),
            groups(F.sum("c")).alias("blocks"),
            groups(F.sum(F.when(~F.col("has_centre"), F.col("c")))).alias("slices"),
        )
        .filter("parts > 1")
        .drop("parts")
    )
    # one row per centre: written, so that it is broadcast while it is small
    members = cells.join(stage(open_cells, "open-cells"), "centre").select(
        "centre", "node", "part", "blocks", "slices",
        (~F.col("part").eqNullSafe(F.col("home"))).alias("asks"),
        F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int").alias("own_block"),
        F.pmod(F.xxhash64("node", F.lit(1)), F.col("slices").cast("long")).cast("int").alias("own_slice"),
    )

    def cell(block, slice_, asks, member):
        return F.struct(block.alias("block"), slice_.alias("slice"), asks.alias("asks"), member.alias("member"))

    block, own = F.col("own_block"), F.col("own_slice")
    as_member = F.transform(
        F.sequence(F.lit(0), F.col("slices") - 1), lambda s: cell(block, s, F.col("asks") & (s == own), F.lit(True))
    )
    elsewhere = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != block)
    asking = F.transform(elsewhere, lambda b: cell(b, own, F.lit(True), F.lit(False)))
    return members.select(
        "centre", "node", "part", F.explode(F.when(F.col("asks"), F.concat(as_member, asking)).otherwise(as_member)).alias("cell")
    ).select("centre", "cell.block", "cell.slice", "node", "part", "cell.asks", "cell.member")


class Index:
    """An inverted index of some of a block's members."""

    def __init__(self, grams: list[np.ndarray], sizes: np.ndarray, places: np.ndarray):
        keys = np.concatenate([grams[i] for i in places])
        owner = np.repeat(np.arange(len(places)), [len(grams[i]) for i in places])
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner = keys[order], owner[order]
        self.places, self.sizes = places, sizes[places]

    def hits(self, n: int, grams: np.ndarray, percent: int) -> np.ndarray:
        """Places of the members that are linked with a set."""
        first, last = np.searchsorted(self.keys, grams), np.searchsorted(self.keys, grams, side="right")
        length = last - first
        skip = np.cumsum(length) - length
        at = np.arange(int(length.sum())) - np.repeat(skip, length) + np.repeat(first, length)
        inter = np.bincount(self.owner[at], minlength=len(self.places))
        return self.places[similar(inter, n, self.sizes, percent)]


class Block:
    """The members of a block, and which parts are known to be connected.

    ``member`` has rows (node, part, asks, member, n, keys). A set that is connected with
    the largest group of members is compared with those outside it alone: the index of
    these is made anew whenever half of them have joined, so a group of near copies costs
    little more than its size.
    """

    def __init__(self, member: list, percent: int):
        self.percent = percent
        self.grams = [np.frombuffer(r[-1], "<u8") for r in member]
        self.sizes = np.array([r[4] for r in member])
        self.nodes = [r[0] for r in member]
        self.parts = [r[1] for r in member]
        self.whole = Index(self.grams, self.sizes, np.arange(len(member)))
        self.parent: dict[int, int] = {}
        self.weight: dict[int, int] = {}  # members in a root's group
        for part in self.parts:
            self.parent[part] = part
            self.weight[part] = self.weight.get(part, 0) + 1
        self.largest = max(self.weight, key=self.weight.get)
        self._look_outside()

    def _look_outside(self) -> None:
        home = self.root(self.largest)
        places = np.array([i for i, p in enumerate(self.parts) if self.root(p) != home], dtype=np.int64)
        self.outside = Index(self.grams, self.sizes, places) if len(places) else None
        self.outside_of, self.left = home, len(places)

    def root(self, part: int) -> int:
        parent = self.parent
        parent.setdefault(part, part)
        while parent[part] != part:
            parent[part] = part = parent[parent[part]]
        return part

    def _join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.parent[b] = a
        self.weight[a] = self.weight.get(a, 0) + self.weight.pop(b, 0)
        if self.weight[a] > self.weight.get(self.root(self.largest), 0) or self.root(self.largest) == a:
            self.largest = a

    def _index(self, part: int) -> Index | None:
        home = self.root(self.largest)
        if self.root(part) != home:
            return self.whole
        outside = len(self.parts) - self.weight[home]
        if self.root(self.outside_of) != home or 2 * outside < self.left:
            self._look_outside()
        return self.outside

    def links(self, node: int, part: int, n: int, raw: bytes) -> list[tuple[int, int]]:
        """The links of a set that connect parts which were not connected before."""
        index = self._index(part)
        if index is None:
            return []
        new = []
        for k in index.hits(n, np.frombuffer(raw, "<u8"), self.percent).tolist():
            if self.root(self.parts[k]) != self.root(part):
                self._join(part, self.parts[k])
                new.append((node, self.nodes[k]))
        return new


def block_links(cells: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """a, b: links between the parts of each centre's neighbourhood that stars left apart.

    ``cells`` has centre, node, part. A task keeps the members of its block, which come
    first, and compares the asking nodes of its slice as they come. Of the links it finds
    it returns a spanning forest over the parts, so fewer rows than it reads.
    """
    rows = dealt_cells(cells, sets).join(sets.select("node", "n", "keys"), "node").select(
        "centre", "block", "slice", "node", "part", "asks", "member", "n", "keys"
    )

    def asked(rows):
        """The links of each asking row; the rows of a cell are together, members first."""
        current, member, block = None, [], None

        def of_members():
            block = Block(member, percent)
            return block, [x for node, part, asks, _, n, raw in member if asks for x in block.links(node, part, n, raw)]

        for centre, number, share, *row in rows:
            if (centre, number, share) != current:
                if member and block is None:
                    yield of_members()[1]
                current, member, block = (centre, number, share), [], None
            if row[3]:
                member.append(row)
            elif member:
                if block is None:
                    block, found = of_members()
                    yield found
                yield block.links(row[0], row[1], row[4], row[5])
        if member and block is None:
            yield of_members()[1]

    def singly(batches):
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(8))):
                yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

    def run(batches):
        found = []
        for some in asked(singly(batches)):
            found += some
            if len(found) >= 10_000:
                yield emitted(found)
                found = []
        if found:
            yield emitted(found)

    def emitted(found):
        return pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())],
            names=["a", "b"],
        )

    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.repartition(parts, "centre", "block", "slice")
        .sortWithinPartitions("centre", "block", "slice", F.desc("member"))
        .mapInArrow(run, "a long, b long")
    )


def links(docs: DataFrame, text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """a, b: links between nodes that connect the same nodes as all links do."""
    sets = stage(shared_keys(docs, text_col, words, percent), "sets")
    entries = stage(lists(sets, boundary(sets), percent), "lists")
    centres = (
        entries.groupBy("key")
        .agg(F.max_by("node", "rank").alias("centre"), F.max("rank").alias("centre_rank"), F.count("*").alias("m"))
        .filter("m > 1")
        .drop("m")
    )
    near = stage(
        entries.join(centres, "key").groupBy("node", "centre").agg(F.max("centre_rank").alias("centre_rank")),
        "near",
    )
    assigned = (
        near.filter("node <> centre").groupBy("node").agg(F.max_by("centre", "centre_rank").alias("centre"))
    )
    stars = stage(star_links(assigned, sets, percent), "star-links")
    parts = components(stars)
    cells = near.unionByName(
        near.select(F.col("centre").alias("node"), "centre", "centre_rank")
    ).select("node", "centre").distinct()
    cells = cells.join(parts, "node", "left").select(
        "centre", "node", F.coalesce("root", "node").alias("part")
    )
    rest = block_links(stage(cells, "cells"), sets, percent)
    return stars.unionByName(stage(rest, "block-links"))


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, node of every document.

    Two documents are linked when 100 times their common n-grams reach ``percent`` times
    all of theirs; ``component_id`` is the smallest doc_id reachable, itself included.
    Null and empty texts have no n-grams and are linked with nothing. Ids may be null
    (they never become a component's id unless all of it is null) or repeated; equal
    sets are one node however often they occur. An empty table gives no rows, and other
    columns are not read.
    """
    rows, nodes = _with_roots(docs, id_col, text_col, words, percent)
    ids = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    named = nodes.join(ids, "root").select("node", "component_id")
    return rows.join(named, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "node",
    )


def _with_roots(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The summaries of the documents; and node, first (its smallest id), root of every
    node. A component is known by its root: ids may be null or in several components."""
    rows = stage(summaries(docs, id_col, text_col, words), "summaries")
    roots = components(links(docs, text_col, words, percent))
    nodes = (
        rows.filter("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min("doc_id").alias("first"))
        .join(roots, "node", "left")
        .select("node", "first", F.coalesce("root", "node").alias("root"))
    )
    return rows, stage(nodes, "nodes")


def with_nodes(docs: DataFrame, text_col: str = "text", words: int = WORDS) -> DataFrame:
    """All columns of ``docs`` in ``_doc`` and the set's node in ``_node``."""
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(text_col).alias("_text")
    )

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(1))):
                grams, at = text_sets(part.column(1), words)
                nodes = [node_of(grams[a:b]) if b > a else None for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(nodes, pa.int64())], names=["_doc", "_node"]
                )

    schema = T.StructType([packed.schema["_doc"], T.StructField("_node", T.LongType())])
    return packed.mapInArrow(run, schema)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component stays, with all its columns: the smallest id, or a
    null one where there is no other.

    Documents without words all stay. Of repeated rows with that id and the same set the
    one with the smallest hash of all columns stays.
    """
    rows, nodes = _with_roots(docs, id_col, text_col, words, percent)
    smallest = F.min(F.struct(F.col("first").isNull(), "first", "node")).alias("kept")
    keepers = (
        nodes.groupBy("root")
        .agg(smallest)
        .select("kept.first", "kept.node")
        .unionByName(rows.filter("node IS NULL").select(F.col("doc_id").alias("first"), "node").distinct())
    )
    marked = with_nodes(docs, text_col, words).withColumn("_id", F.col("_doc").getField(id_col).cast("long"))
    kept = marked.join(
        keepers,
        F.col("_id").eqNullSafe(F.col("first")) & F.col("_node").eqNullSafe(F.col("node")),
        "left_semi",
    )
    # rows without words are in no group: each is the first of its own
    alone = F.when(F.col("_node").isNull(), F.monotonically_increasing_id())
    same = Window.partitionBy("_id", "_node", "_alone").orderBy(F.xxhash64("_doc"))
    once = kept.withColumn("_alone", alone).withColumn("_nth", F.row_number().over(same)).filter("_nth = 1")
    return once.select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])
