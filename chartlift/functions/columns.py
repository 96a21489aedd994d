"""Shared column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: ColumnLike) -> Column:
    """The source database has no empty string: '' reads as null."""
    column = as_column(value)
    return F.when(column != "", column)
