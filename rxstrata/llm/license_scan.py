"""License scans: rare words find a place, neighbours and key phrases confirm it."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxstrata.llm.text import bind, lower_ascii, whole, words_between

# before lower-casing, so A-Z belong to words here
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
ANCHORS = 2


@dataclass(frozen=True)
class Template:
    """A licence text in words. ``keys`` are the phrases that must stand in it."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False
    words: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "words", tuple(self.text.split()))

    def mandatory(self) -> list[tuple[int, tuple[str, ...]]]:
        """(offset, words) of each key phrase; without any, the whole text."""
        found = []
        for key in self.keys or (self.text,):
            part = tuple(key.split())
            found += [
                (i, part)
                for i in range(len(self.words))
                if self.words[i : i + len(part)] == part
            ][:1]
        if len(found) != len(self.keys or (1,)):
            raise ValueError(f"a key phrase of {self.label} is not in its text")
        return found


# fixed values: phrases and labels of the base scan, then public licence wordings
TEMPLATES = (
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files the software to deal in the software"
        " without restriction",
        ("permission is hereby granted free of charge", "associated documentation files"),
    ),
    Template(
        "apache",
        "licensed under the apache license version 2 0",
        ("apache license version 2",),
    ),
    Template(
        "gpl",
        "licensed under the gnu general public license version 3",
        ("gnu general public license",),
    ),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template("mpl", "mozilla public license version 2 0", ("mozilla public license",)),
    Template("epl", "eclipse public license version 2 0", ("eclipse public license",)),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted",
        ("distribute this software for any purpose with or without fee",),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("proprietary", "all rights reserved", ("all rights reserved",)),
)


def anchors(templates: tuple[Template, ...]) -> list[list[tuple[int, str]]]:
    """Per template the (offset, word) of its rarest words inside mandatory phrases.

    Rarity is the inverse document frequency over the templates; ties go to the
    longer word, then to the earlier place.
    """
    in_templates = Counter(w for t in templates for w in set(t.words))
    idf = {w: math.log(len(templates) / n) for w, n in in_templates.items()}
    chosen = []
    for t in templates:
        places: dict[int, str] = {}
        for offset, phrase in t.mandatory():
            places.update({offset + k: w for k, w in enumerate(phrase)})
        rank = sorted(places.items(), key=lambda p: (-idf[p[1]], -len(p[1]), p[0]))
        chosen.append(rank[:ANCHORS])
    return chosen


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple[Template, ...] = TEMPLATES,
) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels,
    labels, score, and ``matches`` (template number, first word, similarity).

    Words are runs of letters, digits and characters beyond ASCII, after lower-casing
    A-Z. Places of anchor words are looked up; per template their lists, shifted by the
    offset in the template, are intersected, and at what is left all mandatory phrases
    are compared. ``similarity`` is the part of the template's words that stand at
    their place, ``score`` the highest. Everything happens inside the row: no shuffle,
    and a document costs in proportion to its words. Null and empty texts have no
    words, no labels (empty strings), null places and score 0.
    """
    rare = anchors(templates)
    vocabulary = sorted({w for places in rare for _, w in places})

    def starts(hits: Column, offset: int, word: str) -> Column:
        """Where the template would begin, for each place of one of its words."""
        places = F.filter(hits, lambda h: h["word"] == word)
        return F.transform(places, lambda h: h["at"] - offset)

    def confirmed(w: Column, s: Column, template: Template) -> Column:
        """Whether every mandatory phrase stands at its offset from ``s``."""
        ok = F.lit(True)
        for offset, phrase in template.mandatory():
            at = s + offset
            there = F.transform(F.slice(w, F.greatest(at, F.lit(0)) + 1, len(phrase)), lower_ascii)
            ok = ok & (at >= 0) & (there == F.lit(list(phrase)))
        return ok

    def similarity(w: Column, s: Column, template: Template) -> Column:
        hits = F.filter(
            F.lit(list(template.words)), lambda t, k: lower_ascii(F.get(w, s + k)) == t
        )
        return F.size(hits) / F.lit(float(len(template.words)))

    def matches_of(number: int, w: Column, hits: Column) -> Column:
        template = templates[number]
        lists = [starts(hits, offset, word) for offset, word in rare[number]]
        agreed = F.array_distinct(reduce(F.array_intersect, lists))
        return F.transform(
            F.filter(agreed, lambda s: confirmed(w, s, template)),
            lambda s: F.struct(
                F.lit(number).alias("template"),
                s.alias("start"),
                similarity(w, s, template).alias("similarity"),
            ),
        )

    def matches(w: Column, hits: Column) -> Column:
        return F.concat(*[matches_of(i, w, hits) for i in range(len(templates))])

    def in_text(w: Column) -> Column:
        # lower() may change other letters too, so it only preselects
        places = F.array_compact(
            F.transform(
                w,
                lambda x, i: F.when(
                    F.lower(x).isin(vocabulary),
                    F.struct(i.alias("at"), lower_ascii(x).alias("word")),
                ),
            )
        )
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            bind(
                bind(places, lambda hits: F.when(F.size(hits) > 0, matches(w, hits)).otherwise(nothing)),
                report,
            ).alias("found"),
        )

    label_of = F.array(*[F.lit(t.label) for t in templates])
    base_of = F.array(*[F.lit(t.base) for t in templates])
    nothing = F.array().cast("array<struct<template:int,start:int,similarity:double>>")

    def labels(found: Column) -> Column:
        names = F.transform(found, lambda m: F.get(label_of, m["template"]))
        return F.concat_ws(",", F.sort_array(F.array_distinct(names)))

    def report(found: Column) -> Column:
        """The result columns of one document's matches."""
        base = F.filter(found, lambda m: F.get(base_of, m["template"]))
        begins = F.transform(base, lambda m: m["start"])
        return F.struct(
            F.size(base).cast("long").alias("n_base"),
            F.array_min(begins).cast("long").alias("first_word"),
            F.array_max(begins).cast("long").alias("last_word"),
            labels(base).alias("base_labels"),
            labels(found).alias("labels"),
            F.coalesce(
                F.array_max(F.transform(found, lambda m: m["similarity"])), F.lit(0.0)
            ).alias("score"),
            found.alias("matches"),
        )

    words = words_between(whole(F.col(text_col)), NOT_WORD)
    scanned = docs.select(F.col(id_col).alias("doc_id"), bind(words, in_text).alias("s"))
    return scanned.select("doc_id", "s.n_words", "s.found.*")
