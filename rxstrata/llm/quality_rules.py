"""Quality rules as a bitmask ledger: measure once, decide by policy, ablate by bits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxstrata.llm.text import SPACE_RUN, bind, whole, words_between

SYMBOLS = "#*$%&|<>"
LONGEST_MEAN, SHORTEST_MEAN = 15, 2


@dataclass(frozen=True)
class Rule:
    """A failure condition over the measurements; ``bit`` never changes its meaning."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "10 * n_dup_lines > 4 * n_lines"),
    Rule(4, "long_words", f"word_chars > {LONGEST_MEAN} * n_words"),
    Rule(5, "short_words", f"word_chars < {SHORTEST_MEAN} * n_words"),
)

#: Named sets of rules; a new policy gets a new name, old ledgers stay readable.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(r.name for r in RULES),
}


def mask(policy: str) -> int:
    names = POLICIES[policy]
    return sum(1 << r.bit for r in RULES if r.name in names)


def _n_repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Windows are hashed; where all hashes differ nothing repeats. Otherwise they are
    sorted by hash and place, and neighbours with equal hashes are compared word by
    word. Every repeated window then adds the words not covered by the last.
    """

    def same(a: Column, b: Column) -> Column:
        hit = a["hash"] == b["hash"]
        for k in range(3):
            hit = hit & (F.get(words, a["at"] + k) == F.get(words, b["at"] + k))
        return F.coalesce(hit, F.lit(False))

    def starts(w: Column) -> Column:
        found = F.transform(
            w,
            lambda x, j: F.when(same(x, F.get(w, j - 1)) | same(x, F.get(w, j + 1)), x["at"]),
        )
        return F.sort_array(F.array_compact(found))

    def covered(hashes: Column) -> Column:
        windows = F.transform(
            hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))
        )
        return F.aggregate(
            bind(F.sort_array(windows), starts),
            F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
            lambda acc, at: F.struct(
                at.alias("last"), (acc["n"] + F.least(F.lit(3), at - acc["last"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    found = bind(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)),
    )
    return F.when(F.size(words) < 6, _short_repeats(words)).otherwise(found).cast("long")


def _short_repeats(words: Column) -> Column:
    """Windows of up to five words: the three at most are compared outright."""

    def window(i: int) -> Column:
        return F.slice(words, i + 1, 3)

    n = F.size(words)
    first_two = (n >= 4) & (window(0) == window(1))
    ends = (n >= 5) & (window(0) == window(2))
    last_two = (n >= 5) & (window(1) == window(2))
    return (
        F.when((first_two & last_two) | ends, n)
        .when(first_two | last_two, 4)
        .otherwise(0)
    )


def measurements(text: Column) -> Column:
    """All measurements of a text in one struct; null measures as empty."""
    text = whole(text)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return F.struct(
        bind(
            words_between(text, SPACE_RUN),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                _n_repeat_words(w).alias("n_repeat_words"),
            ),
        ).alias("words"),
        (F.size(F.split(text, f"[{SYMBOLS}]")) - 1).cast("long").alias("n_symbols"),
        bind(
            lines,
            lambda x: F.struct(
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            ),
        ).alias("lines"),
    )


MEASURED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measurements and ``failed``, a long with the bit of each failed rule.

    One row per input row, no shuffle. Null and empty texts have no words and fail
    few_words only; ids may be null or repeated; other columns are not read.
    """
    measured = docs.select(F.col(id_col).alias("doc_id"), measurements(F.col(text_col)).alias("m"))
    flat = measured.select(
        "doc_id", "m.words.*", "m.n_symbols", "m.lines.*"
    ).select("doc_id", *MEASURED)
    failed = F.lit(0).cast("long")
    for rule in RULES:
        failed = failed.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(0).cast("long"))
    return flat.withColumn("failed", failed)


def passes(policy: str) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def judged(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Ledger rows with base_failed and kept; a policy never keeps what base fails."""
    return rows.withColumn("base_failed", ~passes("base")).withColumn(
        "kept", passes("base") & passes(policy)
    )


def ablation(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of the policy: rows it fails, fails alone, and would be kept without it.

    Reduced to counts per distinct mask first, which are at most 2 ** rules rows.
    """
    masks = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("long")).alias("bits")).agg(
        F.count("*").alias("n")
    )
    names = POLICIES[policy]
    rules = F.array(
        *[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in RULES if r.name in names]
    )
    exploded = masks.select("bits", "n", F.inline(rules))
    has = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return (
        exploded.groupBy("rule")
        .agg(
            F.coalesce(F.sum(F.when(has, F.col("n"))), F.lit(0)).alias("n_failed"),
            F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n"))), F.lit(0)).alias("n_failed_alone"),
            F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not("bit")) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
        )
    )
