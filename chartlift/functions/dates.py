"""Dates: repair, ages and arithmetic."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartlift.functions.columns import ColumnLike, as_column


def as_of_column(as_of: date | str | Column) -> Column:
    """The explicit 'today' of a run, as a date."""
    return as_of if isinstance(as_of, Column) else F.to_date(F.lit(str(as_of)))


def day_part(value: ColumnLike) -> Column:
    """The day of a text that is a day, or a day and a time of day, and nothing else; null otherwise."""
    time_of_day = r"[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?"
    day = F.regexp_extract(as_column(value), rf"^([0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}})({time_of_day})?$", 1)
    return F.when(day != "", day)


def try_fix_date(value: ColumnLike) -> Column:
    """Repair ``yyyy-mm-dd`` text: day too large gives the first of the next month, month above 12
    gives the first of December; anything else that is no date gives null."""
    text = as_column(value)
    as_it_is = F.try_to_date(text, "yyyy-M-d")
    month_start = F.try_to_date(F.concat(F.substring_index(text, "-", 2), F.lit("-1")), "yyyy-M-d")
    day_too_large = text.rlike("-(29|30|31)$")
    month_too_large = text.rlike("^[0-9]{4}-(1[3-9]|[2-9][0-9])-[0-9]{1,2}$")
    return F.coalesce(
        as_it_is,
        F.when(day_too_large, F.add_months(month_start, 1)),
        F.when(month_too_large, F.try_to_date(F.concat(F.substring(text, 1, 4), F.lit("-12-1")), "yyyy-M-d")),
    )


def full_years(start: ColumnLike, end: ColumnLike) -> Column:
    """Whole years between two dates."""
    first, last = F.to_date(as_column(start)), F.to_date(as_column(end))
    before_birthday = F.date_format(last, "MMdd") < F.date_format(first, "MMdd")
    return F.year(last) - F.year(first) - F.when(before_birthday, 1).otherwise(0)


def age_band(birthdate: ColumnLike, event: ColumnLike, limit: int = 16) -> Column:
    """'child' below the limit at the event, else 'adult'."""
    return F.when(full_years(birthdate, event) < limit, F.lit("child")).otherwise(F.lit("adult"))


def add_years(value: ColumnLike, years: Column | int) -> Column:
    count = years if isinstance(years, Column) else F.lit(years)
    return F.add_months(as_column(value), (count * 12).cast("int"))


def end_of_day(value: ColumnLike) -> Column:
    """23:59:59 later, as a visit that starts at midnight is closed."""
    return as_column(value).cast("timestamp") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")


def day_text(value: ColumnLike) -> Column:
    return F.date_format(as_column(value), "yyyy-MM-dd")


def relaxed_birthdate(birthdate: ColumnLike, death: ColumnLike, as_of: date | str | Column) -> Column:
    """An estimated birth date moved back by half the age, by one year at least."""
    born = as_column(birthdate)
    age = full_years(born, F.coalesce(F.to_date(as_column(death)), as_of_column(as_of)))
    return add_years(born, F.least(F.lit(-1), F.ceil(age * -0.5).cast("int")))
