"""Column builders shared by the pipelines: cascades, lookups, exact aggregates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(day: str | dt.date | Column) -> Column:
    """A date column from an ISO string, a date or a column."""
    if isinstance(day, Column):
        return day.cast("date")
    return F.lit(dt.date.fromisoformat(day) if isinstance(day, str) else day)


def start_of(day: str | dt.date | Column) -> Column:
    """Midnight of ``day`` as a timestamp."""
    return as_date(day).cast("timestamp")


def on_day(timestamp: str | Column, day: str | dt.date | Column) -> Column:
    """True where ``timestamp`` falls on ``day``; a range, so Parquet can skip row groups."""
    stamp = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return (stamp >= start_of(day)) & (stamp < F.date_add(as_date(day), 1).cast("timestamp"))


def first_match(cases: Iterable[tuple[Column, object]], otherwise: object) -> Column:
    """Value of the first true condition; a NULL condition counts as false."""
    chosen = None
    for condition, value in cases:
        chosen = F.when(condition, value) if chosen is None else chosen.when(condition, value)
    return F.lit(otherwise) if chosen is None else chosen.otherwise(otherwise)


def banded(value: Column, limits: Iterable[tuple[object, str]], beyond: str) -> Column:
    """Label of the first limit ``value`` is below, else ``beyond`` (also for NULL)."""
    return first_match(((value < limit, label) for limit, label in limits), beyond)


def lookup(key: Column, table: Mapping[str, object], otherwise: object) -> Column:
    """Constant-table lookup; a key that is missing or NULL gives ``otherwise``."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(otherwise))


def either(condition: Column, values: tuple[float, float]) -> Column:
    """First value where true, second where false or NULL."""
    return F.when(condition, values[0]).otherwise(values[1])


FIXED_POINT = "decimal(38,12)"


def fixed_point(value: str | Column) -> Column:
    """Fixed-point form of a double, whose sum does not depend on the row order.

    12 digits behind the point, 26 in front. NULL for NaN, infinities and values that
    do not fit: such a value is in no sum, and in no count of a mean either.
    """
    column = F.col(value) if isinstance(value, str) else value
    return column.try_cast(FIXED_POINT)


def exact_sum(value: str | Column, digits: int | None = None) -> Column:
    """SUM of a double column, the same for any partitioning of the rows."""
    total = F.try_sum(fixed_point(value))
    return (total if digits is None else F.round(total, digits)).cast("double")


def exact_mean(value: str | Column, digits: int | None = None) -> Column:
    """AVG of a double column, the same for any partitioning of the rows."""
    fixed = fixed_point(value)
    return ratio(F.try_sum(fixed), F.count(fixed), digits)


def ratio(part: Column, count: Column, digits: int | None = None) -> Column:
    """``part`` per ``count`` rows, rounded half up; NULL where ``count`` is 0.

    The division is in fixed point, so a tie is seen as one.
    """
    divided = F.try_divide(part.try_cast(FIXED_POINT), count.cast("decimal(18,0)"))
    return (divided if digits is None else F.round(divided, digits)).cast("double")


def count_where(condition: Column) -> Column:
    return F.count_if(condition)
