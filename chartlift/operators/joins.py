"""Joins the source writes as SQL, and the ones it writes as temporary tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartlift.runtime import settle


def attach(facts: DataFrame, summary: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join facts to a summary that was grouped from them by ``on``, with hot keys split.

    A grouped side is already placed by its keys, so a plain join would send all facts of one key to one
    task, and adaptive execution, which splits only shuffled sides, could not help. The extra join key
    ``_part`` is 0 for every row but not known to be constant: both sides are shuffled for the join, and
    adaptive execution splits the hot partitions of the facts and repeats the summary's few rows for them.
    A summary below the broadcast threshold is broadcast instead, as in any join.
    """
    part = F.pmod(F.xxhash64(*[F.col(k) for k in on]), F.lit(1))
    left, right = facts.withColumn("_part", part), summary.withColumn("_part", part)
    return left.join(right, [*on, "_part"], how).drop("_part")


def duplicate_groups(df: DataFrame, keys: Sequence[str], id_column: str) -> DataFrame:
    """Every row that has partners with the same keys: the number of partners, the group's ends.

    This is the ordered self-join on ``id <> id`` in linear space: a group of n rows stands for
    n(n-1) pairs, and each row keeps how many of them it starts.
    """
    groups = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(id_column).alias("lowest_id"), F.max(id_column).alias("highest_id"))
        .filter(F.col("_rows") > 1)
    )
    rows = attach(df.select(*keys, id_column), groups, keys)
    return rows.withColumn("partners", F.col("_rows") - 1).drop("_rows")


def anti_not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """``NOT IN`` with its null rules: a null in the list passes nothing, a null probe passes an empty list only."""
    probes = other.select(F.col(other_column).alias("_member"))
    poisoned = probes.filter(F.col("_member").isNull()).limit(1).select(F.lit(True).alias("_poison"))
    kept = df.filter(F.col(column).isNotNull()).join(probes, df[column] == probes["_member"], "left_anti")
    some = probes.limit(1).select(F.lit(True).alias("_some"))
    unknown = df.filter(F.col(column).isNull()).join(F.broadcast(some), F.lit(True), "left_anti")
    return kept.join(F.broadcast(poisoned), F.lit(True), "left_anti").unionByName(unknown)


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equality in which null matches null; the key columns are those of the left side."""
    renamed = right.withColumnsRenamed({name: f"_right_{name}" for name in on})
    condition = F.lit(True)
    for name in on:
        condition = condition & left[name].eqNullSafe(renamed[f"_right_{name}"])
    return left.join(renamed, condition, how).drop(*[f"_right_{name}" for name in on])


def join_update(target: DataFrame, source: DataFrame, on: Sequence[str], columns: Sequence[str],
                only_null: bool = False) -> DataFrame:
    """UPDATE … JOIN: rows with a match take the source's values, or only fill their nulls.

    ``source`` must hold one row per key; reduce it by an explicit order first.
    """
    new = source.select(*on, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_matched"))
    joined = attach(target, new, on, "left")
    for name in columns:
        old = F.col(name) if name in target.columns else F.lit(None)
        fresh = F.col(f"_new_{name}")
        value = F.coalesce(old, fresh) if only_null else F.when(F.col("_matched"), fresh).otherwise(old)
        joined = joined.withColumn(name, value)
    return joined.drop("_matched", *[f"_new_{c}" for c in columns])


def _epoch(column: Column) -> Column:
    return F.unix_micros(column.cast("timestamp"))


def _bucket(column: Column, days: int) -> Column:
    return F.floor(_epoch(column) / F.lit(days * 86_400_000_000)).cast("long")


def segmented(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows in range partitions by key and order, with the partition's number in ``_part``.

    The ranges are taken from the rows themselves, so parts are about equally large whatever the keys and times are: a key
    with a third of all rows, or all of them on one day, is many parts. Numbers rise with key and order. The rows
    are checkpointed, since a part number must not change when an executor is lost.
    """
    placed = rows.repartitionByRange(key, *order)
    return settle(placed.withColumn("_part", F.spark_partition_id()))


def last_before(sequence: DataFrame, key: str, order: Sequence[str], found: str, alias: str) -> DataFrame:
    """A segmented scan: to each row of ``segmented`` rows the last non-null ``found`` of its key up to it.

    Inside a part a window finds it; from part to part a key hands on one summary row, so the only window over a whole
    key sees one row for each part that the key is in.
    """
    inside = Window.partitionBy("_part", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = sequence.withColumn("_near", F.last(found, ignorenulls=True).over(inside))
    ends = sequence.groupBy("_part", key).agg(F.max_by(found, F.when(F.col(found).isNotNull(), F.struct(*order))).alias("_last"))
    across = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carry", F.last("_last", ignorenulls=True).over(across)).drop("_last")
    return within.join(carried, ["_part", key], "left").withColumn(alias, F.coalesce("_near", "_carry")).drop("_near", "_carry")


def asof_join(
    events: DataFrame,
    states: DataFrame,
    key: str,
    event_time: str,
    state_time: str,
    columns: Sequence[str],
    direction: str = "backward",
) -> DataFrame:
    """For each event the state of the same key nearest strictly before (or after) it.

    States at one instant are reduced to the one with the lowest ``columns``. The lookup is a segmented scan over
    the distinct (key, instant) pairs of both sides: linear where the source's range join is quadratic in the rows of a key.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(direction)
    sign = 1 if direction == "backward" else -1
    payload = F.struct(*[F.col(c) for c in columns])
    points = (
        states.filter(F.col(key).isNotNull() & F.col(state_time).isNotNull())
        .groupBy(key, (_epoch(F.col(state_time)) * sign).alias("_t"))
        .agg(F.min(payload).alias("_state"))
        .select(key, "_t", F.lit(1).alias("_turn"), F.struct("_t", "_state").alias("_found"))
    )
    probes = (
        events.filter(F.col(key).isNotNull() & F.col(event_time).isNotNull())
        .select(key, (_epoch(F.col(event_time)) * sign).alias("_t")).distinct()
    )
    nothing = F.lit(None).cast(points.schema["_found"].dataType).alias("_found")
    # a probe sorts before a state of the same instant, which makes the match strict
    sequence = segmented(points.unionByName(probes.select(key, "_t", F.lit(0).alias("_turn"), nothing)), key, "_t", "_turn")
    found = last_before(sequence, key, ["_t", "_turn"], "_found", "_match").filter("_turn = 0").select(key, "_t", "_match")
    keyed = events.withColumn("_t", _epoch(F.col(event_time)) * sign)
    result = attach(keyed, found, [key, "_t"], "left")
    for name in columns:
        result = result.withColumn(name, F.col("_match")["_state"][name])
    matched_at = F.timestamp_micros((F.col("_match")["_t"] * sign).cast("long"))
    return result.withColumn("matched_at", matched_at).drop("_t", "_match")


def interval_join(
    events: DataFrame,
    intervals: DataFrame,
    key: str,
    event_time: str,
    start: str,
    end: str,
    bucket_days: int = 30,
) -> DataFrame:
    """Events with the intervals of the same key that hold their time; bounds inclusive, end open if null.

    Each interval is laid out over the time buckets it touches, so the join is an equality on (key,
    bucket) with the bounds checked inside: a key with many rows spreads over its buckets. Both ends are
    clipped to the span of the events, which is looked up first (two values come to the driver), so an
    interval from year 1 to year 9999 takes no more buckets than the events do.
    """
    first, last = (F.lit(t).cast("timestamp") for t in events.agg(F.min(event_time), F.max(event_time)).first())
    begin = F.greatest(F.col(start).cast("timestamp"), first)
    stop = F.least(F.coalesce(F.col(end).cast("timestamp"), last), last)
    laid_out = (
        intervals.filter(F.col(start).isNotNull() & (stop >= begin))
        .withColumn("_bucket", F.explode(F.sequence(_bucket(begin, bucket_days), _bucket(stop, bucket_days))))
    )
    placed = events.withColumn("_bucket", _bucket(F.col(event_time), bucket_days))
    joined = placed.join(laid_out, [key, "_bucket"])
    inside = (F.col(event_time) >= F.col(start)) & (F.col(end).isNull() | (F.col(event_time) <= F.col(end)))
    return joined.filter(inside).drop("_bucket")


def active_state(
    events: DataFrame, intervals: DataFrame, key: str, event_id: str, event_time: str, start: str, end: str,
    column: str, **options,
) -> DataFrame:
    """One row per event inside an interval: the lowest value of ``column`` among those that hold it."""
    slim = interval_join(
        events.select(event_id, key, event_time), intervals.select(key, start, end, column), key, event_time,
        start, end, **options,
    )
    return slim.groupBy(event_id).agg(F.min(column).alias(column))


def pattern_map(value: str, patterns: Sequence[tuple[str, str]], default=None) -> Column:
    """The code of the first LIKE pattern that fits."""
    chain = None
    for pattern, code in patterns:
        condition = F.col(value).like(pattern)
        chain = F.when(condition, F.lit(code)) if chain is None else chain.when(condition, F.lit(code))
    return chain if default is None else chain.otherwise(F.lit(default))


def lookup(df: DataFrame, dictionary: DataFrame, on: str, key: str, value: str, alias: str) -> DataFrame:
    """A scalar subquery on a dictionary: null where the key is unknown, the lowest value if repeated."""
    unique = dictionary.groupBy(F.col(key).alias(on)).agg(F.min(value).alias(alias))
    return attach(df, unique, [on], "left")
