"""Text expressions the operators share; all run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: letters, and white space between words
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def whole(text: Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    ``translate`` looks every character up; pure ASCII takes the faster ``lower``.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def words_between(text: Column, separators: str) -> Column:
    """What stands between runs of ``separators`` (a Java pattern), without empty pieces."""
    return F.array_remove(F.split(text, separators), "")


def n_words(text: Column) -> Column:
    """Number of runs of characters other than white space; null has none."""
    pieces = F.split(whole(text), SPACE_RUN)
    # only the first and the last piece can be empty
    empty = (F.element_at(pieces, 1) == "").cast("int") + F.when(
        F.size(pieces) > 1, (F.element_at(pieces, -1) == "").cast("int")
    ).otherwise(0)
    return (F.size(pieces) - empty).cast("long")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it.

    The optimizer inlines projections, so an array that a lambda refers to would be
    computed again for each element; as a lambda's own variable it is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
