"""Projection, predicates and value cleanup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlift.functions.columns import ColumnLike, as_column
from chartlift.functions.dates import as_of_column


def posix_to_java(pattern: str) -> str:
    """POSIX classes of the source's patterns in Java notation."""
    return pattern.replace("[[:blank:]]", "[ \\t]").replace("[[:space:]]", "\\s").replace("[[:digit:]]", "[0-9]")


def matches(value: ColumnLike, pattern: str) -> Column:
    return as_column(value).rlike(posix_to_java(pattern))


def like_any(value: ColumnLike, patterns: Sequence[str]) -> Column:
    column, result = as_column(value), F.lit(False)
    for pattern in patterns:
        result = result | column.like(pattern)
    return result


def implausible_date(value: ColumnLike, as_of, oldest: str | None = None, years_back: int | None = None,
                     years_ahead: int = 0) -> Column:
    """True for a date before the oldest plausible one, or too far after ``as_of``."""
    date = F.to_date(as_column(value))
    today = as_of_column(as_of)
    too_old = F.lit(False)
    if oldest is not None:
        too_old = date < F.to_date(F.lit(oldest))
    if years_back is not None:
        too_old = too_old | (date < F.add_months(today, -12 * years_back))
    return too_old | (date > F.add_months(today, 12 * years_ahead))


def case_map(value: ColumnLike, codes: dict, default=None) -> Column:
    """Simple CASE: known values to codes, the rest to ``default``."""
    column, chain = as_column(value), None
    for key, code in codes.items():
        chain = F.when(column == key, F.lit(code)) if chain is None else chain.when(column == key, F.lit(code))
    return chain if default is None else chain.otherwise(F.lit(default))


def null_if_in(value: ColumnLike, sentinels: Sequence) -> Column:
    """Sentinel values read as null."""
    column = as_column(value)
    return F.when(~column.isin(list(sentinels)), column)


def backfill_pair(df: DataFrame, left: str, right: str) -> DataFrame:
    """Fill each of two columns from the other where it is null."""
    return df.withColumns({left: F.coalesce(left, right), right: F.coalesce(right, left)})


def default_unknown(value: ColumnLike, default: str = "UNKNOWN") -> Column:
    return F.coalesce(as_column(value), F.lit(default))


def row_limit(df: DataFrame, n: int, *order_by: str) -> DataFrame:
    """The first ``n`` rows of a trial run in a stated order (a top-k, so no full sort)."""
    return df.orderBy(*order_by).limit(n)
