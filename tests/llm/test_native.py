"""Exact dedup, license scans, quality rules, mixing."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rxstrata.llm import exact_dedup, license_scan, mixing, quality_rules

from . import brute

TEXTS = [
    None, "", "   \n\t ", "a", "A", "É", "é", "a b c a b c", "a b c a b", "a a a a", "a a a",
    "x\n\nx\n  \nx", "#*$ | <&>%", "a" * 70_000, "one two three " * 5000, "İ K ſ \x00 \x0b z",
    "MIT License", "Released under the MIT  license, MIT\nLicense.", "apache licenses",
    "GNU Lesser General Public License; Mozilla Public License, version 2.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
    " software and associated documentation files",
    "license " * 300, "mit", "all rights reserved 2 cc by nc 4 0",
]


def test_no_python_in_the_plans(documents):
    docs = documents(*TEXTS[:3])
    for df in (
        exact_dedup.exact_groups(docs),
        license_scan.scan(docs),
        quality_rules.judged(quality_rules.ledger(docs)),
        exact_dedup.drop_copies(docs),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|NestedLoop|Cartesian", plan)


@pytest.mark.parametrize("fan_in", [2, 8])
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups(documents, fan_in, keep):
    texts = [*TEXTS, *["Same Text"] * 40, *["same text"] * 40]
    docs = documents(*texts).repartition(7)
    norm = [(t or "").translate(brute.LOWER) for t in texts]
    groups = {}
    for i, t in enumerate(norm):
        groups.setdefault(t, []).append(i)
    pick = max if keep == "largest" else min
    got = {r.doc_id: r for r in exact_dedup.exact_groups(docs, keep=keep, fan_in=fan_in).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(norm):
        want = pick(groups[t])
        r = got[i]
        assert (r.keep_id, r.group_size, r.kept) == (want, len(groups[t]), want == i)
        assert r.text_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_exact_groups_with_repeated_and_null_ids(documents):
    docs = documents((1, "x", "s"), (1, "x", "s"), (None, "X", "s"), (None, "y", "s"), (None, "y", "s"))
    rows = exact_dedup.exact_groups(docs).collect()
    assert sorted((r.keep_id is None, r.kept) for r in rows) == [
        (False, False), (False, False), (False, True), (True, False), (True, True),
    ]
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "None"]


def test_quality_rules(documents):
    docs = documents(*TEXTS)
    got = {r.doc_id: r for r in quality_rules.judged(quality_rules.ledger(docs)).collect()}
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality(t)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept <= (not r.base_failed)


def test_ablation_counts_rows(documents):
    rows = quality_rules.ledger(documents(*TEXTS, "word " * 60)).cache()
    failed = [r.failed for r in rows.collect()]
    for r in quality_rules.ablation(rows).collect():
        bit = 1 << next(x.bit for x in quality_rules.RULES if x.name == r.rule)
        assert r.n_failed == sum(bool(f & bit) for f in failed)
        assert r.n_failed_alone == sum(f == bit for f in failed)
        assert r.n_kept_without == sum(not f & ~bit for f in failed)


def test_license_scan(documents):
    base = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
    got = {r.doc_id: r for r in license_scan.scan(documents(*TEXTS)).collect()}
    for i, t in enumerate(TEXTS):
        n, starts, labels = brute.base_places(t, base)
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(starts), labels), t
        assert (r.first_word, r.last_word) == ((starts[0], starts[-1]) if starts else (None, None))
        assert 0 <= r.score <= 1 and set(filter(None, labels.split(","))) <= set(r.labels.split(","))
    assert got[19].labels == "gpl,lgpl,mpl"
    assert got[20].labels == "mit" and 0 < got[20].score < 1
    assert got[23].labels == "cc-by-nc,proprietary"


def targets_by_rounds(sizes, weights=(3, 1, 2), budget=1.5, ceiling=2.0):
    """Share by weight and cut at the ceiling, round after round."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ = {s: 0.0 for s in order}, set(order)
    left = budget * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > ceiling * sizes[s]]
        if not over:
            for s in open_:
                target[s] = left * weight[s] / total
            break
        for s in over:
            target[s] = ceiling * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


def test_mixing(documents):
    rows = [(i, "w " * (1 + i % 9), ["a", "b", "hot", None, "Z", "é"][min(i % 11, 5)]) for i in range(3000)]
    rows += [(9000, None, "empty"), (9001, "", "empty"), (None, "one two", "a")]
    docs = documents(*rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(brute.words(t))
    want = targets_by_rounds(sizes)
    got = mixing.mix(docs).select("_doc.*", F.col("size").alias("n"), "source_size", "target", "copies").collect()
    taken = Counter()
    for r in got:
        assert r.n == len(brute.words(r.text)) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source]) and 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.n
    for s in sizes:
        assert taken[s] == pytest.approx(want[s], rel=0.15, abs=5)
    again = mixing.repeated(docs.repartition(5))
    assert again.columns == docs.columns
    assert Counter(r.doc_id for r in again.collect()) == Counter(
        {r.doc_id: r.copies for r in got if r.copies}
    )


def test_rows_without_ids_or_of_one_id_draw_on_their_own(documents):
    """Equal sources: one has no ids, one a single id; all come near their targets."""
    rows = [(i, f"x{i} y z", "own") for i in range(2000)]
    rows += [(None, f"n{i} y z", "none") for i in range(2000)] + [(7, f"o{i} y z", "one") for i in range(2000)]
    rows += [(5, "same same", "twice")] * 2
    taken, target = Counter(), {}
    for r in mixing.mix(documents(*rows)).collect():
        taken[r._doc.source] += r.copies * r.size
        target[r._doc.source] = r.target
    for source in ("own", "none", "one"):
        assert taken[source] == pytest.approx(target[source], rel=0.05)


def test_empty_tables(documents):
    docs = documents()
    assert exact_dedup.exact_groups(docs).count() == 0
    assert exact_dedup.drop_copies(docs).count() == 0
    assert license_scan.scan(docs).count() == 0
    assert quality_rules.judged(quality_rules.ledger(docs)).count() == 0
    assert quality_rules.ablation(quality_rules.ledger(docs)).count() == 0
    assert mixing.mix(docs).count() == 0 and mixing.repeated(docs).count() == 0
