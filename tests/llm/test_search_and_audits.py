"""Top-k search, source divergence and filter audits against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from rxstrata.llm import filter_audit, source_audit, topk_search

from . import brute

INF, NAN = float("inf"), float("nan")


# --- top-k search


def plain_top_k(rows, k):
    """[(query_id, rank, vec_id, score)] of (vec_id, vector) rows, ids divisible by 100 asking."""
    ok = [
        (i, [max(min(math.floor(1024 * x), 2**63 - 1), -(2**63)) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (q, v) in enumerate(ok):
        if q is None or q % 100:
            continue
        scored = []
        for other, (i, w) in enumerate(ok):
            if other != at:
                score = sum(a * b for a, b in zip(v, w))
                scored.append((-min(max(score, -(2**63)), 2**63 - 1), i is None, i or 0, i))
        scored.sort(key=lambda s: s[:3])
        out += [(q, n + 1, s[3], -s[0]) for n, s in enumerate(scored[:k])]
    return out


def vector_table(spark, rows):
    return spark.createDataFrame(
        [(i, v, 1, "x", 2.0, "far") for i, v in rows],
        "vec_id long, embedding array<double>, shard int, row string, length double, v string",
    )


def found(df):
    return sorted(map(str, map(tuple, df.collect())))


def asking():
    return F.col("vec_id") % 100 == 0


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 16, "pack_queries": 2}, {"n_pivots": 1, "shard_rows": 40}])
def test_top_k_equals_all_pairs(spark, documents, sizes):
    documents()
    rng = random.Random(5)
    centres = [[rng.gauss(0, 0.2) for _ in range(8)] for _ in range(4)]
    rows = [(i * 20, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)]) for i in range(150)]
    rows += [(3001 + i, rows[0][1]) for i in range(60)]  # one vector of many
    rows += [(i * 100, [0.5] * 8) for i in range(40, 45)]
    rng.shuffle(rows)
    got = topk_search.top_k(vector_table(spark, rows).repartition(3), asking(), k=7, **sizes)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert found(got) == sorted(map(str, plain_top_k(rows, 7)))


def test_top_k_odd_vectors(spark, documents):
    """Bad vectors, different lengths, empty and huge ones, null and repeated ids."""
    documents()
    rows = [
        (0, [1.0, 2.0]), (100, [1.0, 2.0]), (100, [-3.5]), (1, [1e300, 1.0]), (2, [-1e300]), (3, []),
        (4, None), (5, [1.0, None]), (6, [NAN]), (7, [INF, 1.0]), (200, [-INF]), (None, [4.0, 4.0]),
        (None, [4.0, 4.0]), (8, [2.0**30, 2.0**30, 7.0]), (300, [1e300, -1e300, 0.25]), (400, []),
    ]
    got = topk_search.top_k(vector_table(spark, rows), asking(), k=4, shard_rows=3, pack_queries=2)
    assert found(got) == sorted(map(str, plain_top_k(rows, 4)))


def test_top_k_of_few_rows(spark, documents):
    documents()
    assert found(topk_search.top_k(vector_table(spark, []), asking())) == []
    assert found(topk_search.top_k(vector_table(spark, [(1, [1.0])]), asking())) == []
    assert found(topk_search.top_k(vector_table(spark, [(100, [1.0])]), asking())) == []
    assert found(topk_search.top_k(vector_table(spark, [(100, [1.0]), (1, [2.0])]), asking())) == [
        str((100, 1, 1, 2 * 1024 * 1024))
    ]


def test_bounds_leave_rows_unread(spark):
    """In clustered rows most scores are never computed."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    v = (rng.normal(0, 300, (20, 16))[np.arange(4000) % 20] + rng.normal(0, 5, (4000, 16))).astype(np.int64)
    pivots = topk_search.far_apart(v[:500], 16)
    batch = pa.record_batch(
        {"row": np.arange(4000), "vec_id": np.arange(4000), "is_query": np.arange(4000) % 100 == 0, "v": list(v)}
    )
    table = pa.Table.from_batches(topk_search._measure(pivots)([batch]))
    rows = topk_search.Rows(table, 16, len(pivots))
    read, scores = [], rows.scores
    rows.scores = lambda at, of, q: read.append(len(at)) or scores(at, of, q)
    for q in range(0, 4000, 100):
        places, _ = topk_search.best(rows, rows, q, 10, None)
        dots = v @ v[q]
        dots[q] = -(2**62)
        assert sorted(dots[places]) == sorted(np.sort(dots)[-10:])
    assert sum(read) < 0.25 * 40 * 4000


# --- source divergence


def plain_audit(rows, least_docs=10, top=10):
    """Rows of the audit for (text, lang, source) rows."""
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(brute.LOWER)), la or "", s or "") for t, la, s in rows]
    out = []
    for lang in {la for _, la, _ in docs}:
        df = Counter(t for w, la, _ in docs if la == lang for t in set(w))
        kept = {t for t, n in df.items() if n >= least_docs}
        counts, whole = defaultdict(Counter), Counter()
        for w, la, s in docs:
            if la == lang:
                counts[s].update(t for t in w if t in kept)
                whole.update(t for t in w if t in kept)

        def share(c, t):
            return 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))

        def apart(p, q):
            return (p - q) * (p - q) // (p + q)

        for s in counts:
            pairs = [(-sum(apart(share(counts[s], t), share(counts[o], t)) for t in kept), o.encode()) for o in counts if o != s]
            terms = [
                (-apart(share(counts[s], t), share(whole, t)), t.encode())
                for t in kept
                if counts[s][t] and share(counts[s], t) > share(whole, t)
            ]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, o.decode(), -v, n + 1) for n, (v, o) in enumerate(items)]
    return out


WORDS = ["a", "B", "c", "d-e", "É", "é", "straße", "x1y", "ſ", "語", "\x00", "_f_", "gg"]


def audit_rows(n, seed=2):
    rng = random.Random(seed)
    rows = [
        (" ".join(rng.choices(WORDS, range(1, 14), k=rng.randrange(9))), rng.choice(["en", "de", None, ""]), rng.choice(["s", "t", "é", None]))
        for _ in range(n)
    ]
    rows += [(None, "en", "empty"), ("", "fr", "alone"), ("rare words", "it", "u"), ("rare", "it", "v")]
    rows += [("hot a a", "en", "s")] * 30 + [("long " * 40_000, "en", "t")]
    return rows


def audit_table(spark, rows):
    return spark.createDataFrame(
        [(*r, 1, "x", 5) for r in rows], "text string, lang string, source string, count int, term string, total int"
    )


@pytest.mark.parametrize("slices", [20_000, 3])
def test_source_audit(spark, documents, monkeypatch, slices):
    documents()
    monkeypatch.setattr(source_audit, "SLICE_TERMS", slices)
    rows = audit_rows(200)
    got = source_audit.audit(audit_table(spark, rows).repartition(5))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert found(got) == sorted(map(str, plain_audit(rows)))


def test_source_audit_hands_on_what_it_holds(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(source_audit, "TASK_TERMS", 2)
    batches = [
        pa.record_batch({"text": texts, "lang": ["en"] * len(texts), "source": ["s"] * len(texts)})
        for texts in (["a b c", "a"], ["a a", "d"])
    ]
    total = Counter()
    for batch in source_audit._counted(iter(batches)):
        for row in batch.to_pylist():
            total[row["term"], "n"] += row["count"]
            total[row["term"], "docs"] += row["docs"]
    assert (total["a", "n"], total["a", "docs"], total["d", "n"]) == (4, 3, 1)


def test_source_audit_of_nothing(spark, documents):
    documents()
    assert found(source_audit.audit(audit_table(spark, []))) == []
    assert found(source_audit.audit(audit_table(spark, [("a", "en", "s")]))) == []
    assert found(source_audit.audit(audit_table(spark, [("a", "en", "s"), (None, None, None)]))) == []


def test_shares_are_exact_for_large_counts(spark):
    import numpy as np

    rng = random.Random(1)
    pairs = [(c, c + rng.randrange(1, 10**15)) for c in (rng.randrange(10**15) for _ in range(200))] + [(7, 7), (0, 3)]
    want = [1 + 10**9 * c // t for c, t in pairs]
    assert source_audit._shares(*map(np.array, zip(*pairs))).tolist() == want
    df = spark.createDataFrame(pairs, "c long, t long").select(source_audit.share(F.col("c"), F.col("t")))
    assert [r[0] for r in df.collect()] == want


# --- filter audit


def plain_filters(docs, labels):
    """{(part, order, step): figures} of (doc_id, text, lang) rows and (id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    smallest = {}
    for i, t, _ in docs:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    fails, out = [], {}
    for i, t, lang in docs:
        t = t or ""
        w = brute.words(t)
        failed = {
            f
            for f, bad in {
                "A": len(w) < 200,
                "B": 100 * len(set(w)) < 50 * len(w),
                "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                "D": bool(re.search("[#$%&*|]", t)),
                "E": i is not None and smallest[t] < i,
            }.items()
            if bad
        }
        fails.append((lang or "", failed, i is not None and i in good, i is not None and i in toxic))
    for part in {p for p, *_ in fails}:
        mine = [x for x in fails if x[0] == part]
        removed_by = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                removed_by[f] += len(gone)
                out[part, "".join(order), step + 1] = [
                    len(left), len(gone), sum(f in x[1] for x in mine) - len(gone),
                    sum(x[1] == {f} for x in mine), sum(x[2] for x in gone), sum(x[3] for x in gone), f,
                ]
        for (p, *_), row in out.items():
            if p == part:
                row[-1] = removed_by[row[-1]]
    return out


def filter_tables(spark, docs, labels):
    docs = spark.createDataFrame(
        [(*d, 1, "x", True) for d in docs], "doc_id long, text string, lang string, n int, mask string, good boolean"
    )
    return docs.repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_filter_audit(spark):
    rng = random.Random(4)
    texts = [None, "", "one two", "A B C", "x # y", "w " * 300, " ".join(f"w{i}" for i in range(250)), "É" * 90_000]
    texts += [" ".join(f"W{i % rng.randrange(90, 260)}" for i in range(260)) + rng.choice(["", " $"]) for _ in range(12)]
    docs = [(rng.choice([*range(60), None]), rng.choice(texts), rng.choice(["en", "de", "", None])) for _ in range(150)]
    docs += [(i, "copy", "en") for i in range(100, 160)] + [(5, "copy", "fr")] * 2 + docs[:9]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(0, 160, 2), *range(9)]]
    labels += [(None, 1, 1)]
    counts = filter_audit.failure_counts(*filter_tables(spark, docs, labels))
    got = filter_audit.audit(counts).collect()
    want = plain_filters(docs, labels)
    assert len(got) == len(want) == 120 * 5 * 4
    for r in got:
        assert [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] == want[
            r.part, r.filter_order, r.step
        ]


def test_filter_audit_of_nothing(spark):
    empty = filter_audit.audit(filter_audit.failure_counts(*filter_tables(spark, [], [(1, 1, 1)])))
    assert empty.count() == 0
    one = filter_audit.audit(filter_audit.failure_counts(*filter_tables(spark, [(1, "a", None)], [])))
    assert {(r.part, r.kept) for r in one.filter("step = 5").collect()} == {("", 0)}


def test_paths_through_the_lattice():
    for n in range(1, 7):
        reach, leave = filter_audit.path_counts(n)
        assert reach[-1] == leave[0] == math.factorial(n)
        for f in range(n):
            through = sum(reach[s] * leave[s | 1 << f] for s in range(1 << n) if not s >> f & 1)
            assert through == math.factorial(n)


def test_audit_of_other_filters(spark):
    counts = spark.createDataFrame([("p", 0, 5), ("p", 1, 3), ("p", 3, 2)], "part string, mask int, docs long")
    rows = {(r.filter_order, r.step): r for r in filter_audit.audit(counts, "xy", ["docs"]).collect()}
    assert [(r.kept, r.removed, r.redundant, r.shapley) for r in (rows["xy", 1], rows["xy", 2], rows["yx", 1], rows["yx", 2])] == [
        (5, 5, 0, 8), (5, 0, 2, 2), (8, 2, 0, 2), (5, 3, 2, 8),
    ]
    with pytest.raises(ValueError):
        filter_audit.audit(counts, "xx", ["docs"])
