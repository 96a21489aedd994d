"""Numbers hidden in text, and unit fix-ups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartlift.functions.columns import ColumnLike, as_column


def is_number(value: ColumnLike) -> Column:
    """Digits, dots and commas only, with at least one digit; null stays null."""
    text = as_column(value)
    return text.rlike("^[0-9.,]+$") & text.rlike("[0-9]")


def extract_number(value: ColumnLike) -> Column:
    """The first number in the text, as text with a decimal point.

    Leading zeros and trailing dots go ('0.5' gives '.5'); text without a number gives '0'.
    """
    text = as_column(value)
    run = F.regexp_extract(text, "[0-9.,]+", 0)
    trimmed = F.regexp_replace(F.regexp_replace(F.translate(run, ",", "."), "^0+", ""), r"\.+$", "")
    return F.when(text.isNotNull(), F.when(trimmed == "", F.lit("0")).otherwise(trimmed))


def number_value(value: ColumnLike) -> Column:
    """``extract_number`` as a double; a run with several dots keeps its leading number."""
    text = extract_number(value)
    return F.regexp_extract(text, r"^[0-9]*\.?[0-9]*", 0).try_cast("double")


def round_half_up(value: ColumnLike, digits: int) -> Column:
    return F.round(as_column(value), digits)


def height_cm(value: ColumnLike) -> Column:
    """Heights below 3 were written in metres."""
    height = as_column(value)
    return F.when(height < 3.0, F.round(height * 100, 1)).otherwise(height)


def weight_kg_staging(value: ColumnLike, unit: ColumnLike) -> Column:
    """Staging policy: only 'lbs' is converted, an unknown unit counts as kilograms."""
    weight = as_column(value)
    return F.when(as_column(unit) == "lbs", F.round(weight * 0.453592, 1)).otherwise(weight)


def weight_kg_export(value: ColumnLike, unit: ColumnLike) -> Column:
    """Export policy: everything that is not 'kgs' was recorded in pounds."""
    weight = as_column(value)
    is_kg = F.coalesce(F.lower(as_column(unit)) == "kgs", F.lit(False))
    return F.when(is_kg, weight).otherwise(weight / 2.20462)


def shorthand_times_ten(value: ColumnLike, below: float) -> Column:
    """Blood pressure written without its last digit."""
    pressure = as_column(value)
    return F.when(pressure < below, pressure * 10).otherwise(pressure)


def temperature_c(value: ColumnLike) -> Column:
    """Temperatures above 60 were recorded in Fahrenheit."""
    temperature = as_column(value)
    celsius = F.round((temperature - 32.0) * 0.555555, 1)
    return F.when(temperature > 60, celsius).otherwise(temperature)


def vital_value(sign: ColumnLike, value: ColumnLike, unit: ColumnLike) -> Column:
    """Unit fix-up of one vital sign row."""
    name, result = as_column(sign), as_column(value)
    return (
        F.when(name == "height", height_cm(result))
        .when(name == "weight", weight_kg_staging(result, unit))
        .when(name == "blood_pressure_dias", shorthand_times_ten(result, 20))
        .when(name == "blood_pressure_sys", shorthand_times_ten(result, 30))
        .when(name == "temperature", temperature_c(result))
        .otherwise(result)
    )


def hex_to_int(digits: ColumnLike) -> Column:
    return F.conv(as_column(digits), 16, 10).cast("long")


def int_to_hex(number: ColumnLike) -> Column:
    return F.lower(F.conv(as_column(number).cast("string"), 10, 16))


def is_whole(value: ColumnLike) -> Column:
    number = as_column(value)
    return number == F.ceil(number)
