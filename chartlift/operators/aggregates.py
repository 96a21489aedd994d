"""Grouping, folding, and one row per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartlift.functions.columns import ColumnLike, as_column
from chartlift.operators.joins import attach
from chartlift.operators.keys import assign_ids


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def any_true(condition: Column) -> Column:
    return F.max(F.coalesce(condition, F.lit(False)))


def pivot_flags(df: DataFrame, keys: Sequence[str], name: str, flags: dict[str, Sequence[str]]) -> DataFrame:
    """Rows that carry a name folded to one boolean per flag: true if any of its names occurs."""
    return df.groupBy(*keys).agg(*[any_true(F.col(name).isin(list(names))).alias(f) for f, names in flags.items()])


def string_agg(
    df: DataFrame,
    keys: Sequence[str],
    value: ColumnLike,
    alias: str,
    separator: str = ", ",
    order: Sequence[ColumnLike] = (),
    distinct: bool = False,
) -> DataFrame:
    """Sorted GROUP_CONCAT. Nulls are skipped; the order is ``order`` and then the value.

    Equal values travel once with their count, so a repeated value is not repeated in the shuffle or in a list.
    """
    text = as_column(value).cast("string")
    ordering = [as_column(o).alias(f"_o{i}") for i, o in enumerate(order)]
    slim = df.select(*keys, *ordering, text.alias("_v"))
    names = [f"_o{i}" for i in range(len(ordering))]
    counted = slim.groupBy(*keys, *names, "_v").agg(F.count(F.lit(1)).alias("_n"))
    item = F.when(F.col("_v").isNotNull(), F.struct(*names, "_v", "_n"))
    packed = counted.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    if distinct:
        values = F.array_distinct(F.transform("_items", lambda x: x["_v"]))
    else:
        # a value and its repeats are text from the start, not list entries
        values = F.transform("_items", lambda x: repeated_text(x["_v"], x["_n"], separator))
    return packed.select(*keys, F.when(F.size("_items") > 0, F.array_join(values, separator)).alias(alias))


def repeated_text(value: Column, times: Column, separator: str) -> Column:
    """A value ``times`` times, with separators between."""
    return F.concat(value, F.repeat(F.concat(F.lit(separator), value), (times - 1).cast("int")))


def dedupe_merge(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Duplicates by key collapsed to the greatest value of each attribute."""
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])


def mode_value(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """The most frequent value per group, ties to the greater one."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.max(F.struct("_n", value))[value].alias(alias))


def member_counts(parents: DataFrame, children: DataFrame, parent_id: str, parent_ref: str) -> DataFrame:
    """Children per parent, zero included."""
    counts = children.filter(F.col(parent_ref).isNotNull()).groupBy(F.col(parent_ref).alias(parent_id)).agg(
        F.count(F.lit(1)).alias("members")
    )
    return parents.join(counts, parent_id, "left").withColumn("members", F.coalesce("members", F.lit(0)))


def child_rows(df: DataFrame, keys: Sequence[str], columns: Sequence[str], alias: str = "child") -> DataFrame:
    """Child rows as a long frame: keys, ``position`` from 1 in the order of the columns, and the child as a struct.

    The form for keys of any size: positions come from consecutive ids over all rows (no task sees a whole key), less
    the first id of the key. Null keys drop out.
    """
    present = df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])).select(*dict.fromkeys([*keys, *columns]))
    numbered = assign_ids(present, list(dict.fromkeys([*keys, *columns])), "_id")
    first = numbered.groupBy(*keys).agg(F.min("_id").alias("_first"))
    position = (F.col("_id") - F.col("_first") + 1).alias("position")
    return attach(numbered, first, keys).select(*keys, position, F.struct(*columns).alias(alias))


def collect_nested(df: DataFrame, keys: Sequence[str], columns: Sequence[str], alias: str) -> DataFrame:
    """Child rows folded to one sorted ``array<struct>`` per key. Null keys drop out.

    One cell holds all children of its key, as the document that is asked for does; ``child_rows`` is the same
    result for keys too large for a cell.
    """
    present = df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return present.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(alias))


def unique_map(df: DataFrame, key: str, value: str) -> DataFrame:
    """A one-to-one map; a key with two different rows raises when the result is read."""
    grouped = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.min(value).alias(value)
    )
    message = F.concat(F.lit("more than one value for key "), F.col(key).cast("string"))
    checked = F.when(F.col("_n") > 1, F.raise_error(message).cast(df.schema[value].dataType)).otherwise(F.col(value))
    return grouped.select(key, checked.alias(value))


def map_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys that would break ``unique_map``, with their row counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def last_wins_map(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The columns of the last row per key in the given order."""
    return pick_per_key(df, keys, columns, order, last=True)


def pick_per_key(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str], last: bool = False
) -> DataFrame:
    """First or last row per key by a struct ordering: an aggregate, so it combines before the shuffle."""
    ordering = F.struct(*[F.col(c) for c in order])
    chosen = F.struct(*[F.col(c) for c in columns])
    best = (F.max_by if last else F.min_by)(chosen, ordering)
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, *[F.col("_row")[c].alias(c) for c in columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Rows at the greatest date of their key, ties kept."""
    top = df.groupBy(*keys).agg(F.max(date).alias("_top"))
    return attach(df, top, keys).filter(F.col(date) == F.col("_top")).drop("_top")


def earliest_on_or_before(
    anchors: DataFrame, facts: DataFrame, key: str, anchor_date: str, fact_date: str, alias: str
) -> DataFrame:
    """The earliest fact date of the key, if it is not after the anchor."""
    first = facts.groupBy(key).agg(F.min(fact_date).alias("_first"))
    joined = attach(anchors, first, [key], "left")
    return joined.withColumn(alias, F.when(F.col("_first") <= F.col(anchor_date), F.col("_first"))).drop("_first")


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent values, null counted as a value, ties to the lower value."""
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(F.desc("rows"), F.asc_nulls_first("value")).limit(n)


def top_values_per_group(df: DataFrame, keys: Sequence[str], column: str, n: int) -> DataFrame:
    """The ``n`` most frequent values of every group, by counts first and a rank over counts only."""
    counts = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("rows"))
    ranked = Window.partitionBy(*keys).orderBy(F.desc("rows"), F.asc_nulls_first(column))
    return counts.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= n)


def set_difference_both(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct values found on one side only, with the side's name."""
    sides = left.select(F.col(column), F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(F.col(column), F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    seen = sides.filter(F.col(column).isNotNull()).groupBy(column).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    side = F.when(F.col("_r") == 0, "left_only").otherwise("right_only")
    return seen.filter(F.col("_l") != F.col("_r")).select(column, side.alias("side"))
