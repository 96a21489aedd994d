"""Deterministic identifiers and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartlift.functions.columns import ColumnLike, as_column

# Name spaces of the two identifier functions.
NAME_UUID_NAMESPACE = "53a5b5f4-3239-4a27-8674-5c3bb8116692"
HASH_UUID_NAMESPACE = "c73ce727-afd7-40a4-9dd2-6b76842bbcbb"


def _dashed(digits: Column, version: str) -> Column:
    """32 or more hex digits to a UUID with the given version and the RFC 4122 variant."""
    variant = F.substring(F.lit("89ab"), 1, 4)
    nibble = F.conv(digits.substr(17, 1), 16, 10).cast("int") % 4
    return F.concat(
        digits.substr(1, 8), F.lit("-"),
        digits.substr(9, 4), F.lit(f"-{version}"),
        digits.substr(14, 3), F.lit("-"),
        variant.substr(nibble + 1, F.lit(1)), digits.substr(18, 3), F.lit("-"),
        digits.substr(21, 12),
    )


def uuid_name(table: ColumnLike | str, key: ColumnLike) -> Column:
    """Version 3 UUID of a table name and a primary key (``table`` given as text is a literal)."""
    name = F.lit(table) if isinstance(table, str) else table
    text = F.concat(F.lit(NAME_UUID_NAMESPACE + "-"), name, F.lit("-"), as_column(key).cast("string"))
    return _dashed(F.md5(text.cast("binary")), "3")


def uuid_hash(value: ColumnLike) -> Column:
    """Version 5 style UUID of a text value."""
    text = F.concat(F.lit(HASH_UUID_NAMESPACE), as_column(value).cast("string"))
    return _dashed(F.sha1(text.cast("binary")), "5")


def p_hash(value: ColumnLike, iteration: int) -> Column:
    """A repeatable number in [0, 1) with three decimals taken from the leading md5 digits."""
    digits = F.md5(as_column(value).cast("binary")).substr(1, 4 + iteration)
    return (F.conv(digits, 16, 10).cast("long") % 1000) / F.lit(1000.0)


def modulo_pick(key: ColumnLike, choices: list[str]) -> Column:
    """The choice at position ``key mod len(choices)``."""
    position = F.pmod(as_column(key).cast("long"), F.lit(len(choices))).cast("int")
    return F.element_at(F.array(*[F.lit(choice) for choice in choices]), position + 1)
