"""Column profiles and table use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlift.functions.clinical import parse_double
from chartlift.operators.aggregates import top_values, top_values_per_group


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value as text, rows) of all columns from one scan."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    exploded = df.select(F.explode(cells).alias("_cell")).select("_cell.*")
    return exploded.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: nulls, values, distinct values, least and greatest value as text."""
    names = list(columns or df.columns)
    distinct = (
        _value_counts(df, names)
        .groupBy("column")
        .agg(
            F.sum(F.when(F.col("value").isNull(), F.col("rows")).otherwise(0)).alias("nulls"),
            F.sum(F.when(F.col("value").isNotNull(), F.col("rows")).otherwise(0)).alias("non_nulls"),
            F.count("value").alias("distinct_values"),
        )
    )
    ends = df.agg(*[f(c).alias(f"_{tag}{i}") for i, c in enumerate(names) for tag, f in (("l", F.min), ("g", F.max))])
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"_l{i}").cast("string").alias("least"),
                 F.col(f"_g{i}").cast("string").alias("greatest"))
        for i, c in enumerate(names)
    ]
    return distinct.join(ends.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*"), "column", "left")


def frequent_values(df: DataFrame, columns: Sequence[str], n: int = 20) -> DataFrame:
    """The ``n`` most frequent values of each column, null counted as a value."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    exploded = df.select(F.explode(cells).alias("_cell")).select("_cell.*")
    return top_values_per_group(exploded, ["column"], "value", n)


def value_breakdown(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Counts of each value, null kept; the ``n`` most frequent if a number is given."""
    if n is not None:
        return top_values(df, column, n)
    return df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def columns_with_data(df: DataFrame) -> DataFrame:
    """Columns that hold a value somewhere, with how many."""
    counted = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("non_nulls")) for c in df.columns]
    return counted.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*").filter("non_nulls > 0")


def column_use_by_type(df: DataFrame, type_column: str) -> DataFrame:
    """Which columns are filled for which type of row."""
    names = [c for c in df.columns if c != type_column]
    counted = df.groupBy(type_column).agg(*[F.count(c).alias(c) for c in names])
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("non_nulls")) for c in names]
    used = counted.select(type_column, F.explode(F.array(*rows)).alias("_r")).select(type_column, "_r.*")
    return used.filter("non_nulls > 0")


def table_type_matrix(
    parents: DataFrame, key: str, type_column: str, children: dict[str, tuple[DataFrame, str]]
) -> DataFrame:
    """(table, column, type, non_nulls) of child tables by the type of the row they belong to."""
    types = parents.select(F.col(key).alias("_key"), F.col(type_column).alias("type"))
    result = None
    for name, (child, reference) in children.items():
        joined = child.join(types, child[reference] == types["_key"]).drop("_key")
        used = column_use_by_type(joined, "type").select(F.lit(name).alias("table"), "column", "type", "non_nulls")
        result = used if result is None else result.unionByName(used)
    return result


def numeric_share(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per group the distinct values and how many of them read as a number."""
    distinct = df.filter(F.col(value).isNotNull()).select(group, value).distinct()
    return distinct.groupBy(group).agg(
        F.count(F.lit(1)).alias("distinct_values"),
        F.count(parse_double(F.col(value))).alias("numeric_values"),
    )
