"""Text cleanup, names and key=value strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartlift.functions.columns import ColumnLike, as_column


def substring_before(value: ColumnLike, separator: str) -> Column:
    """Text before the first separator, or all of it."""
    return F.substring_index(as_column(value), separator, 1)


def username_from_email(email: ColumnLike, user_id: ColumnLike, taken: Column | None = None) -> Column:
    """Left of '@' without a leading backtick; ``-id`` is added when the name is taken."""
    address = as_column(email)
    left = F.when(F.locate("@", address) > 0, substring_before(address, "@")).otherwise(
        F.when(address.isNotNull(), F.lit(""))
    )
    clean = F.when(left.startswith("`"), F.translate(left, "`", "")).otherwise(left)
    if taken is None:
        return clean
    return F.when(taken, F.concat_ws("-", clean, as_column(user_id).cast("string"))).otherwise(clean)


def username_with_id(email: ColumnLike, user_id: ColumnLike) -> Column:
    """The prototype's variant: always ``name-id``."""
    return F.concat_ws("-", substring_before(email, "@"), as_column(user_id).cast("string"))


def first_names(full_name: ColumnLike) -> Column:
    """All but the last word, with the blank after it kept; a single word is returned whole."""
    name = F.trim(as_column(full_name))
    up_to_blank = F.length(name) - F.locate(" ", F.reverse(name)) + 1
    return F.when(F.locate(" ", name) > 0, name.substr(F.lit(1), up_to_blank)).otherwise(name)


def last_name(full_name: ColumnLike) -> Column:
    return F.substring_index(F.trim(as_column(full_name)), " ", -1)


def given_name(first: ColumnLike, second: ColumnLike) -> Column:
    """First name with an optional second one; a missing first name stays missing."""
    extra = F.coalesce(F.concat(F.lit(" "), as_column(second)), F.lit(""))
    return F.concat(as_column(first), extra)


def truncate_text(value: ColumnLike, limit: int) -> Column:
    return F.substring(as_column(value), 1, limit)


def is_truncated(value: ColumnLike, limit: int) -> Column:
    return F.length(as_column(value)) > limit


def trim_prefix(value: ColumnLike, prefix: str) -> Column:
    text = as_column(value)
    return F.when(text.startswith(prefix), text.substr(F.lit(len(prefix) + 1), F.length(text))).otherwise(text)


def concat_or_null(*parts: ColumnLike) -> Column:
    """Null as soon as one part is null."""
    return F.concat(*[as_column(part) for part in parts])


def concat_skip_null(separator: str, *parts: ColumnLike) -> Column:
    """Parts that are null leave no trace; with no part left the result is null."""
    columns = [as_column(part) for part in parts]
    joined = F.concat_ws(separator, *columns)
    return F.when(F.coalesce(*columns).isNotNull(), joined)


def kv_text(pairs: dict[str, ColumnLike], separator: str = ",") -> Column:
    """``name=value`` parts of the values that are present."""
    parts = [F.concat(F.lit(f"{name}="), as_column(value).cast("string")) for name, value in pairs.items()]
    return concat_skip_null(separator, *parts)


def parse_kv_map(value: ColumnLike, pair_separator: str = ",", key_separator: str = "=") -> Column:
    """``k=v,k=v`` to a map. Empty pairs are ignored, a value may hold the key separator, and the
    last value of a key wins."""
    pairs = F.filter(F.split(as_column(value), f"\\Q{pair_separator}\\E"), lambda pair: pair != "")
    nothing = F.create_map().cast("map<string,string>")

    def add(known: Column, pair: Column) -> Column:
        key = F.substring_index(pair, key_separator, 1)
        at = F.locate(key_separator, pair)
        value = F.when(at > 0, pair.substr(at + len(key_separator), F.length(pair)))
        return F.map_concat(F.map_filter(known, lambda k, _: k != key), F.create_map(key, value))

    return F.aggregate(pairs, nothing, add)


def dosing_text(daily: ColumnLike, weekly: ColumnLike, parts: dict[str, ColumnLike]) -> Column:
    """'2 /day x 7 days/week - 1/morning …'; a part that is not positive is left out."""
    pieces = [
        F.when(as_column(dose) > 0, F.concat(F.lit(" - "), as_column(dose).cast("string"), F.lit(f"/{name}")))
        for name, dose in parts.items()
    ]
    optional = [F.coalesce(piece, F.lit("")) for piece in pieces]
    return F.concat(
        as_column(daily).cast("string"), F.lit(" /day x "), as_column(weekly).cast("string"),
        F.lit(" days/week"), *optional,
    )
