"""Warnings and validation rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlift.functions.columns import ColumnLike, as_column
from chartlift.functions.numbers import is_whole
from chartlift.operators.aggregates import member_counts, repeated_text
from chartlift.operators.eav import VALUE_COLUMNS
from chartlift.operators.joins import attach

WARNING_TYPES = {
    "patient_id": "long",
    "encounter_id": "long",
    "encounter_date": "date",
    "field_name": "string",
    "field_value": "string",
    "warning_type": "string",
    "warning_details": "string",
    "flag_for_review": "boolean",
}


def warn(
    df: DataFrame,
    warning_type: ColumnLike | str,
    patient: ColumnLike | None = None,
    encounter: ColumnLike | None = None,
    date: ColumnLike | None = None,
    field: ColumnLike | str | None = None,
    value: ColumnLike | None = None,
    details: Column | str | None = None,
    flag: bool = True,
    when: Column | None = None,
) -> DataFrame:
    """One uniformly shaped warning per row (of those for which ``when`` holds)."""

    def literal(text):
        return F.lit(text) if isinstance(text, str) or text is None else text

    values = {
        "patient_id": as_column(patient) if patient is not None else F.lit(None),
        "encounter_id": as_column(encounter) if encounter is not None else F.lit(None),
        "encounter_date": as_column(date) if date is not None else F.lit(None),
        "field_name": literal(field),
        "field_value": as_column(value) if value is not None else F.lit(None),
        "warning_type": literal(warning_type),
        "warning_details": literal(details),
        "flag_for_review": F.lit(flag),
    }
    rows = df if when is None else df.filter(when)
    return rows.select(*[values[name].cast(kind).alias(name) for name, kind in WARNING_TYPES.items()])


def all_warnings(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def duplicate_values(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups that occur more than once, with their count; null keys are no duplicates."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def warn_out_of_range(obs: DataFrame, limits: DataFrame) -> DataFrame:
    """Numeric values below or above the limits of their concept, or broken where whole is needed.

    ``limits``: concept_id, low, high, allow_decimal — a dictionary with one row per concept.
    """
    joined = obs.filter(F.col("value_numeric").isNotNull()).join(limits, "concept_id")
    value = F.col("value_numeric")
    findings = [
        (~F.col("allow_decimal") & ~is_whole(value), "Decimal obs for non-decimal numeric concept", F.lit(None)),
        (value < F.col("low"), "Decimal obs lower than allowed range",
         F.concat(F.lit("Low Absolute: "), F.col("low").cast("string"))),
        (value > F.col("high"), "Decimal obs higher than allowed range",
         F.concat(F.lit("High Absolute: "), F.col("high").cast("string"))),
    ]
    structs = [
        F.when(F.coalesce(condition, F.lit(False)),
               F.struct(F.lit(kind).alias("kind"), details.cast("string").alias("details")))
        for condition, kind, details in findings
    ]
    found = joined.withColumn("_w", F.explode(F.array(*structs))).filter(F.col("_w").isNotNull())
    return warn(found, F.col("_w.kind"), patient="person_id", encounter="encounter_id",
                field=F.col("concept_id").cast("string"), value=value.cast("string"), details=F.col("_w.details"))


def warn_null_values(obs: DataFrame) -> DataFrame:
    """Observations without a value and without members."""
    empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in VALUE_COLUMNS])
    leaves = member_counts(obs.filter(empty), obs, "obs_key", "group_key").filter("members = 0")
    return warn(leaves, "Obs with null value", patient="person_id", encounter="encounter_id",
                field=F.col("concept_id").cast("string"), flag=False)


def unmapped_codes(df: DataFrame, column: str, dictionary: DataFrame, key: str) -> DataFrame:
    """Rows whose code is present but not in the dictionary."""
    return df.filter(F.col(column).isNotNull()).join(
        dictionary.select(F.col(key).alias(column)), column, "left_anti"
    )


def conflicting_duplicates(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Groups that were merged although a column had more than one distinct value: (keys, field, values,
    listed), with all values sorted. All columns share one scan; equal values travel once with their count."""
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("_v")) for c in columns])
    values = df.select(*keys, F.explode(cells).alias("_cell")).select(*keys, "_cell.*").filter("_v IS NOT NULL")
    counted = values.groupBy(*keys, "field", "_v").agg(F.count(F.lit(1)).alias("_n"))
    several = counted.groupBy(*keys, "field").agg(F.count(F.lit(1)).alias("values")).filter("values > 1")
    conflicting = attach(counted, several, [*keys, "field"])
    packed = conflicting.groupBy(*keys, "field", "values").agg(F.array_sort(F.collect_list(F.struct("_v", "_n"))).alias("_items"))
    listed = F.transform("_items", lambda x: repeated_text(x["_v"], x["_n"], ", "))
    return packed.select(*keys, "field", "values", F.array_join(listed, ", ").alias("listed"))


def orphans(df: DataFrame, parents: DataFrame, on: str) -> DataFrame:
    """Rows whose parent was not migrated."""
    return df.join(parents.select(on), on, "left_anti")


def enrich_warnings(warnings: DataFrame, lookups: Sequence[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Add identifiers: each lookup is (dictionary, warning column, dictionary key, value column)."""
    result = warnings
    for dictionary, column, key, value in lookups:
        one_each = dictionary.groupBy(F.col(key).alias(column)).agg(F.min(value).alias(value))
        result = attach(result, one_each, [column], "left")
    return result


def check_rules(df: DataFrame, no_rows: dict[str, Column], all_rows: dict[str, Column] | None = None) -> DataFrame:
    """All row rules of a table in one pass: (rule, expected, actual, passed).

    A ``no_rows`` rule counts rows that break it and expects none; an ``all_rows`` rule counts rows that
    keep it and expects the table's count.
    """
    every = all_rows or {}
    total = F.count(F.lit(1)).alias("_total")
    counted = df.agg(
        total,
        *[F.count(F.when(c, 1)).alias(f"_n{i}") for i, c in enumerate(no_rows.values())],
        *[F.count(F.when(c, 1)).alias(f"_a{i}") for i, c in enumerate(every.values())],
    )
    rows = [
        F.struct(F.lit(rule).alias("rule"), F.lit(0).cast("long").alias("expected"), F.col(f"_n{i}").alias("actual"))
        for i, rule in enumerate(no_rows)
    ] + [
        F.struct(F.lit(rule).alias("rule"), F.col("_total").alias("expected"), F.col(f"_a{i}").alias("actual"))
        for i, rule in enumerate(every)
    ]
    result = counted.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
    return result.withColumn("passed", F.col("expected") == F.col("actual"))


def assert_match(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that two results do not share, as multisets: the row's columns and the surplus on each side."""
    columns = left.columns
    sides = left.select(*columns, F.lit(1).alias("_d")).union(right.select(*columns, F.lit(-1).alias("_d")))
    delta = sides.groupBy(*columns).agg(F.sum("_d").alias("surplus")).filter("surplus <> 0")
    return delta.withColumn("side", F.when(F.col("surplus") > 0, "left").otherwise("right"))


def assert_counts_match(rule: str, left: DataFrame, right: DataFrame) -> DataFrame:
    """(rule, expected, actual, passed) for the row counts of two results."""
    sides = left.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("expected")).unionByName(
        right.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("actual"))
    )
    folded = sides.agg(
        F.max(F.when(F.col("side") == "expected", F.col("n"))).alias("expected"),
        F.max(F.when(F.col("side") == "actual", F.col("n"))).alias("actual"),
    )
    return folded.select(F.lit(rule).alias("rule"), "expected", "actual",
                         (F.col("expected") == F.col("actual")).alias("passed"))


def nonnull_coverage(df: DataFrame) -> DataFrame:
    """Rows with a value per column, nested fields and array elements included: (property, populated, covered)."""
    from pyspark.sql import types as T

    def leaves(prefix: str, column: Column, kind: T.DataType):
        if isinstance(kind, T.StructType):
            for child in kind.fields:
                yield from leaves(f"{prefix}.{child.name}", column[child.name], child.dataType)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            for child in kind.elementType.fields:
                some = F.exists(column[child.name], lambda value: value.isNotNull())
                yield f"{prefix}[].{child.name}", F.when(some, 1)
        else:
            yield prefix, column

    found = [leaf for f in df.schema.fields for leaf in leaves(f.name, F.col(f.name), f.dataType)]
    counted = df.agg(*[F.count(column).alias(f"_c{i}") for i, (_, column) in enumerate(found)])
    rows = [F.struct(F.lit(name).alias("property"), F.col(f"_c{i}").alias("populated")) for i, (name, _) in enumerate(found)]
    result = counted.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
    return result.withColumn("covered", F.col("populated") > 0)
