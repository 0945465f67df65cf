import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rxstrata.llm import components as components_module
from rxstrata.llm import ngram_join
from rxstrata.llm.components import components

from . import brute


def corpus(seed=1):
    """Originals, near copies of many grades, shared passages, tiny and empty texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for size in (1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 20, 40, 80, 200):
        for _ in range(4):
            origin = [rng.choice(vocabulary) for _ in range(size)]
            texts.append(" ".join(origin))
            for _ in range(5):
                copy = list(origin)
                for _ in range(rng.randint(0, 1 + size // 20)):
                    copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
                if rng.random() < 0.3:
                    copy += [rng.choice(vocabulary)] * rng.randint(1, 3)
                texts.append(rng.choice(["\t", "  ", "\n"]).join(copy))
    texts += [" ".join([rng.choice(vocabulary) for _ in range(90)] + passage) for _ in range(60)]
    hub = [rng.choice(vocabulary) for _ in range(150)]
    for _ in range(120):
        copy = list(hub)
        for _ in range(rng.randint(1, 6)):
            copy[rng.randrange(150)] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += [None, "", " \n", "A b", "a B", "same thing here", "same thing here", "ab " * 30_000]
    rng.shuffle(texts)
    return texts


def check(docs, rows):
    got = ngram_join.join_components(docs).collect()
    want = brute.join_components(rows)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == sorted(
        (str(d), n, str(c if n else d)) for (d, _), (n, c) in zip(rows, want, strict=True)
    )


def test_components_of_all_pairs(documents):
    texts = corpus()
    rows = [(i * 3 - 40, t) for i, t in enumerate(texts)]
    check(documents(*[(d, t, "s") for d, t in rows]).repartition(5), rows)


def test_small_blocks_and_other_boundaries(documents, monkeypatch):
    """Blocks of a few sets, and only light or only heavy sets, link the same."""
    texts = corpus(2)[:250]
    rows = list(enumerate(texts))
    docs = documents(*texts)
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", 20_000)
    for limit in (0, 30, 10**6):
        monkeypatch.setattr(ngram_join, "boundary", lambda sets, limit=limit: limit)
        check(docs, rows)


def test_a_hot_list_of_unlike_sets_is_compared_in_bounded_cells(spark, documents, monkeypatch):
    """Texts put together from common passages: all ask, and each cell stays small."""
    rng = random.Random(6)
    passages = [" ".join(f"p{k}x{i}" for i in range(20)) for k in range(12)]
    texts = [" ".join(rng.sample(passages, 8)) for _ in range(150)]
    texts += [t + " end" for t in texts[:40]]
    limit = 40_000
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", limit)
    seen = []
    deal = ngram_join.dealt_cells
    monkeypatch.setattr(ngram_join, "dealt_cells", lambda cells, sets: seen.append((deal(cells, sets), sets)) or seen[0][0])
    rows = list(enumerate(texts))
    check(documents(*texts), rows)
    dealt, sets = seen[0]
    size = F.col("c") * 8
    cells = (
        dealt.join(sets.select("node", "c"), "node")
        .groupBy("centre", "block", "slice")
        .agg(F.sum(F.when(F.col("member"), size)).alias("held"), F.sum(F.when(F.col("asks"), size)).alias("asking"))
    )
    largest = cells.agg(F.max("held"), F.max("asking"), F.max("slice"), F.max("block")).first()
    # hashing deals sets unevenly; all that ask are 150,000 bytes and more
    assert largest[0] < 2 * limit and largest[1] < 2 * limit and largest[2] >= 3 and largest[3] >= 3


@pytest.mark.parametrize("n", [75, 150, 300])
def test_links_of_near_copies_grow_with_their_number(documents, monkeypatch, n):
    """Copies with two words changed: many are not similar to the centre of their lists."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(130)]
    texts = []
    for i in range(n):
        words = list(base)
        for k in rng.sample(range(130), 2):
            words[k] = f"n{i}x{k}"
        texts.append(" ".join(words))
    made, read = [], []
    deal, compare = ngram_join.dealt_cells, ngram_join.block_links
    monkeypatch.setattr(ngram_join, "dealt_cells", lambda *a: read.append(deal(*a)) or read[-1])
    monkeypatch.setattr(ngram_join, "block_links", lambda *a: made.append(compare(*a)) or made[-1])
    check(documents(*texts), list(enumerate(texts)))
    assert made[0].count() < read[0].count()


def test_a_block_joins_parts_once():
    """Two groups and single sets: each link joins what was apart, and all are found."""
    rng = random.Random(3)
    base = [np.sort(rng.sample(range(10_000 * g, 10_000 * g + 900), 100)) for g in range(3)]
    sets = [np.sort(np.concatenate([rng.sample(list(base[i % 3]), 95), [90_000 + 5 * i + k for k in range(5)]])) for i in range(60)]
    sets += [np.arange(200_000 + 100 * i, 200_100 + 100 * i) for i in range(20)]
    rows = [(i, 1000 + i, True, True, 100, s.astype("<u8").tobytes()) for i, s in enumerate(sets)]
    block = ngram_join.Block(rows, 75)
    made = [x for node, part, _, _, n, raw in rows for x in block.links(node, part, n, raw)]
    assert len(made) == 57 and all(a % 3 == b % 3 for a, b in made)
    assert len({block.root(1000 + i) for i in range(60)}) == 3
    far = sets[0].copy()
    assert block.links(500, 5000, 100, far.astype("<u8").tobytes()) and not block.links(501, 5000, 100, far.astype("<u8").tobytes())


def test_null_and_repeated_ids(documents):
    long = " ".join(f"v{i}" for i in range(50))
    near = long.replace("v49", "other")
    rows = [(None, long), (5, near), (5, near), (5, "else"), (None, "alone"), (2, long), (None, None), (9, "")]
    docs = documents(*[(d, t, "s") for d, t in rows])
    check(docs, rows)
    kept = ngram_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), (r.text or "")[:5]) for r in kept.collect()) == [
        ("2", "v0 v1"), ("5", "else"), ("9", ""), ("None", ""), ("None", "alone"),
    ]


def test_unlinked_texts_stay_whatever_their_ids(documents):
    """Components without any id, and components that share an id, each keep one text."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(50)) for x in "abcd")
    rows = [(None, a), (None, b), (None, b.replace("b49", "other")), (7, c), (7, d), (7, d), (8, d.replace("d49", "other"))]
    kept = ngram_join.drop_near_copies(documents(*[(i, t, "s") for i, t in rows])).collect()
    assert sorted((str(r.doc_id), r.text[:2]) for r in kept) == [
        ("7", "c0"), ("7", "d0"), ("None", "a0"), ("None", "b0"),
    ]


def test_one_of_each_component_stays(documents):
    texts = corpus(3)[:200]
    docs = documents(*texts)
    want = {
        i for i, (n, c) in enumerate(brute.join_components(list(enumerate(texts)))) if c == i or not n
    }
    assert {r.doc_id for r in ngram_join.drop_near_copies(docs).collect()} == want


def test_empty_table(documents):
    assert ngram_join.join_components(documents()).count() == 0
    assert ngram_join.drop_near_copies(documents()).count() == 0


def test_blocks_round_trip():
    rng = np.random.default_rng(4)
    keys = np.sort(rng.integers(0, 2**48, 1000, dtype=np.uint64))
    weights, owners = rng.integers(0, 255, 1000), rng.integers(0, 50, 1000)
    nodes, sizes = rng.integers(0, 2**63, 50, dtype=np.uint64), rng.integers(1, 9999, 50)
    back = ngram_join.unpack(ngram_join.pack(keys, weights, owners, nodes, sizes))
    for a, b in zip(back, (keys, weights, owners, nodes, sizes), strict=True):
        assert (a == b).all()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 20, 21, 100])
def test_prefix_holds_enough_of_any_partner(n):
    for c in range(-(-75 * n // 100), n + 1):
        for share in (1, 2):
            p = ngram_join.prefix(n, c, share)
            lost = n - -(-75 * n // 100)
            assert p <= c and (p == c or p + (n - c) - lost >= share)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + k) for k in range(1, 500)] + [(7, 7)]
    links += [(rng.randrange(5000, 5200), rng.randrange(5000, 5200)) for _ in range(150)]
    rng.shuffle(links)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r.node, r.root) for r in got} == {(x, root(x)) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_equal_fingerprints_do_not_end_the_rounds(spark, monkeypatch):
    monkeypatch.setattr(components_module, "_fingerprint", lambda edges: 1)
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {(r.node, r.root) for r in components(links).collect()} == {(i, 0) for i in range(41)}
