"""Plain versions of what the operators compute."""

import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALPHA = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return SPACED.findall(text or "")


def shingles(text, n=5):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def join_components(rows):
    """{row number: (n_shingles, component)} of (doc_id, text) rows, all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[root(i)] = min(doc_id, smallest.get(root(i), doc_id))
    return [(len(sets[i]), smallest.get(root(i))) for i in range(len(rows))]


def quality(text):
    text = text or ""
    w = words(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {
        i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)
    }
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(w),
        sum(map(len, w)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def base_places(text, phrases):
    w = ALPHA.findall((text or "").translate(LOWER))
    starts, labels = [], set()
    for phrase, label in phrases:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(w), sorted(starts), ",".join(sorted(labels))
