"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartlift.runtime import settle

_ROW_BITS = 33


def next_id(target: DataFrame, column: str) -> int:
    """One more than the greatest id in use (one number comes to the driver)."""
    top = target.agg(F.max(column)).first()[0]
    return 1 if top is None else int(top) + 1


def assign_ids(df: DataFrame, order: Sequence[str], alias: str, start: int = 1) -> DataFrame:
    """Consecutive ids in the given order, from ``start``.

    Rows are range-partitioned by the order and sorted inside each partition, then written down once, so
    that a lost executor cannot renumber them. A partition's ids follow from the sizes of those before it:
    one row per partition is all that a single task sees. ``order`` should be a total order.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settle(ranged.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.withColumn(alias, F.lit(start) + F.col("_offset") + row).drop("_part", "_place", "_offset")


def reserve_id_ranges(frames: dict[str, DataFrame], start: int) -> dict[str, int]:
    """First id for each frame when they share one id space, in the given order."""
    counts = None
    for name, frame in frames.items():
        one = frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    sizes = {row["name"]: row["n"] for row in counts.collect()}
    starts, position = {}, start
    for name in frames:
        starts[name] = position
        position += sizes[name]
    return starts


def allocate_from_pool(df: DataFrame, pool: DataFrame, order: Sequence[str], pool_order: Sequence[str], shortage: str = "keep") -> DataFrame:
    """The n-th row with the n-th member of a pool of ready-made values, and what is left of either side.

    ``allocation`` tells assigned rows, unassigned rows (without a member) and unused members (without a row) apart, so nothing
    drops out unseen. ``shortage="raise"`` makes a pool with too few members an error when the result is read.
    Both sides are numbered apart without gathering them and meet in one join on the number.
    """
    if shortage not in ("keep", "raise"):
        raise ValueError(shortage)
    rows = assign_ids(df, order, "_n").withColumn("_row", F.lit(True))
    members = assign_ids(pool, pool_order, "_n").withColumn("_member", F.lit(True))
    state = F.when(F.col("_member").isNull(), "unassigned").when(F.col("_row").isNull(), "unused").otherwise("assigned")
    both = rows.join(members, "_n", "full").withColumn("allocation", state)
    if shortage == "raise":
        missing = F.concat(F.lit("the pool has no member for row "), F.col("_n").cast("string"))
        both = both.withColumn("allocation", F.when(F.col("allocation") == "unassigned", F.raise_error(missing)).otherwise(F.col("allocation")))
    return both.drop("_n", "_row", "_member")


def pair_with_pool(df: DataFrame, pool: DataFrame, order: Sequence[str], pool_order: Sequence[str], shortage: str = "keep") -> DataFrame:
    """Only the assigned pairs of ``allocate_from_pool``."""
    return allocate_from_pool(df, pool, order, pool_order, shortage).filter("allocation = 'assigned'").drop("allocation")


def natural_to_surrogate(df: DataFrame, id_map: DataFrame, source: str, target: str, how: str = "inner") -> DataFrame:
    """Add the target id of a source key; the map's size decides between broadcast and shuffle."""
    return df.join(id_map.select(source, target), source, how)
