"""Removal of repeated passages by a depth-limited radix sort of suffixes (operator 3).

Two places of the corpus start the same passage of ``length`` bytes exactly if their suffixes fall into one group once
they are ordered by their first ``length`` bytes. The order is made by most-significant-digit passes, and a suffix
that is alone in its group leaves:

1. The first digit of a window is the least hash of the 64-byte strings in it, which equal windows share. It is the
   same for a run of neighbouring windows, so a run travels as one row. Runs whose digit occurs once are unique.
2. The second digit is the hash of all windows of a run in their order, so of its whole text. Runs equal in both are repeated with all their windows; one
   run of each such group goes on, to be compared with the runs that share the first digit only.
3. What is left is ordered by the last digit, the hash of each window's bytes, together with the first. Groups of at
   most ``group_runs`` different runs are handled inside tasks, many at a time, from the runs' own bytes; larger
   groups are split by the last digit with a shuffle of their windows.

A run in which the least string occurs twice may repeat itself and always takes part in the last pass. Digits are
64 bits each and two are equal together, so groups are told apart by 128 bits.

Null and empty texts, and texts shorter than ``length``, lose nothing. Repeated rows repeat all their bytes, rows with
the same id included. Rows with a null id keep their text but are compared like others. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlift.llm.common import pieces, texts_of
from chartlift.llm.shingles import mix
from chartlift.operators.joins import attach
from chartlift.runtime import scratch_path, settle

LENGTH = 200
ANCHOR = 64
GROUP_WINDOWS = 2_000_000
MAX_RUN = 1024  # windows of one row; longer runs, which periodic text makes, come as several
GROUP_BYTES = 400_000

_BASE = 0x9E3779B97F4A7C15
_CODES = mix(np.arange(1, 257, dtype=np.uint64))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def string_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """The polynomial hash of ``size`` bytes at every start, by doubling."""
    levels, width, current = [], 1, _CODES[raw]
    levels.append((width, current))
    while 2 * width <= size:
        current = current[: len(current) - width] * _power(width) + current[width:]
        width *= 2
        levels.append((width, current))
    done, out = levels[-1]
    for width, level in reversed(levels[:-1]):
        if done + width <= size:
            places = len(raw) - done - width + 1
            out = out[:places] * _power(width) + level[done : done + places]
            done += width
    return out


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    step, out = 1, values
    while 2 * step <= width:
        out = np.minimum(out[: len(out) - step], out[step:])
        step *= 2
    return np.minimum(out[: len(out) - width + step], out[width - step :]) if step < width else out


def runs_of(texts: list[bytes], length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(text number, start, windows, first digit, second digit, 2 if it may repeat itself else 1) of all runs."""
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    if len(raw) < length:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(6))
    strings = mix(string_hashes(raw, anchor))
    least = _sliding_least(strings, length - anchor + 1)
    windows = string_hashes(raw, length)
    inside = np.zeros(len(least) + 1, dtype=np.int64)  # windows must not cross texts
    full = sizes >= length
    np.add.at(inside, starts[full], 1)
    np.add.at(inside, ends[full] - length + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    head = inside.copy()
    head[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    head[starts[full]] = True
    same_next = np.zeros(len(least), dtype=bool)
    same_next[:-1] = inside[:-1] & inside[1:] & ~head[1:]
    again = (strings[: len(least)] == least) & same_next
    first = np.flatnonzero(head)
    if not len(first):
        return runs_of([], length, anchor)
    # A long run is cut at fixed distances from its start.
    counts = np.add.reduceat(inside.astype(np.int64), first)
    twice = np.logical_or.reduceat(again, first)
    parts = (counts - 1) // MAX_RUN + 1
    if parts.max() > 1:
        number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, counts, twice = (np.repeat(x, parts) for x in (first, counts, twice))
        first = first + number * MAX_RUN
        counts = np.minimum(counts - number * MAX_RUN, MAX_RUN)
    # Every window counts, with its place in the run; windows between runs add nothing.
    place = np.arange(len(least)) - np.repeat(np.append(0, first), np.diff(np.concatenate([[0], first, [len(least)]])))
    placed = np.where(inside, mix(windows + mix(place.astype(np.uint64) + np.uint64(1))), np.uint64(0))
    second = mix(np.add.reduceat(placed, first) + counts.astype(np.uint64) * np.uint64(_BASE))
    owner = np.searchsorted(ends, first, side="right")
    return owner, first - starts[owner], counts, least[first].view(np.int64), second.view(np.int64), 1 + twice.astype(np.int64)


def _groups(texts: list[str]):
    """(first number, texts as bytes) in groups of bounded size."""
    group, size, start = [], 0, 0
    for number, text in enumerate(texts):
        raw = text.encode()
        if group and size + len(raw) > GROUP_BYTES:
            yield start, group
            group, size, start = [], 0, number
        group.append(raw)
        size += len(raw)
    if group:
        yield start, group


def _runs(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    names = ["row", "start", "windows", "a", "b", "times"]

    def scan(batches):
        for batch in pieces(batches):
            ids = np.array(batch.column("row").to_pylist(), dtype=np.int64)
            for start, group in _groups(batch.column("text").to_pylist()):
                found = runs_of(group, length, anchor)
                columns = [ids[start + found[0]], found[1].astype(np.int32), found[2].astype(np.int32), found[3], found[4], found[5].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return docs.mapInArrow(scan, "row long, start int, windows int, a long, b long, times int")


def _repeated_windows(digits: np.ndarray, texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each run, which of its windows occur in another place of the given runs with the same first digit."""
    hashes = [mix(string_hashes(np.frombuffer(t, dtype=np.uint8), length)) for t in texts]
    sizes = [len(h) for h in hashes]
    flat = np.concatenate(hashes)
    keys = np.empty(len(flat), dtype=[("a", np.int64), ("h", np.uint64)])
    keys["a"], keys["h"] = np.repeat(digits, sizes), flat
    order = np.lexsort((keys["h"], keys["a"]))
    ordered = keys[order]
    same = np.zeros(len(flat) + 1, dtype=bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    flags = np.zeros(len(flat), dtype=bool)
    flags[order] = same[1:] | same[:-1]
    return np.split(flags, np.cumsum(sizes)[:-1])


def _ranges(flags: np.ndarray, start: int, length: int) -> list[int]:
    """Byte ranges covered by the flagged windows of a run, flat."""
    if not flags.any():
        return []
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [int(x) for a, b in zip(edges[::2], edges[1::2], strict=True) for x in (start + a, start + b - 1 + length)]


def _small_groups(runs: DataFrame, length: int) -> DataFrame:
    """(row, ranges) from groups that fit into a task; groups of neighbouring batches are kept together."""

    def compare(batches):
        held: list[tuple] = []

        def out():
            flags = _repeated_windows(np.array([r[0] for r in held], dtype=np.int64), [r[3] for r in held], length)
            found = [(r[1], _ranges(f, r[2], length)) for r, f in zip(held, flags, strict=True)]
            found = [x for x in found if x[1]]
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.list_(pa.int32()))], names=["row", "ranges"])

        size = 0
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("a", "row", "start", "text")), strict=True):
                if size > GROUP_BYTES and row[0] != held[-1][0]:
                    yield out()
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield out()

    ordered = runs.repartition("a").sortWithinPartitions("a")
    return ordered.select("a", "row", "start", "text").mapInArrow(compare, "row long, ranges array<int>")


def _large_groups(runs: DataFrame, length: int) -> DataFrame:
    """(row, ranges) from groups of any size, split by the last digit."""

    def spread(batches):
        for batch in batches:
            for a, row, start, text in zip(*(batch.column(n).to_pylist() for n in ("a", "row", "start", "text")), strict=True):
                hashes = mix(string_hashes(np.frombuffer(text, dtype=np.uint8), length)).view(np.int64)
                columns = [np.full(len(hashes), a), hashes, np.full(len(hashes), row), start + np.arange(len(hashes), dtype=np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "h", "row", "start"])

    windows = runs.select("a", "row", "start", "text").mapInArrow(spread, "a long, h long, row long, start int")
    repeated = windows.groupBy("a", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "h")
    return windows.join(repeated, ["a", "h"]).select("row", F.array("start", (F.col("start") + length).cast("int")).alias("ranges"))


def _merge(flat: list[int]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(flat[::2], flat[1::2], strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _cut(raw: bytes, ranges: list[list[int]]) -> bytes:
    kept, end = [], 0
    for a, b in ranges:
        kept.append(raw[end:a])
        end = b
    return b"".join([*kept, raw[end:]])


def _result(raw: bytes, flat: list[int]) -> tuple:
    ranges = _merge(flat)
    kept = _cut(raw, ranges)
    return len(raw), sum(b - a for a, b in ranges), len(ranges), hashlib.sha256(kept).hexdigest(), [x for r in ranges for x in r]


_RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<int>"


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR,
    group_windows: int = GROUP_WINDOWS,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans, the byte ranges removed (start, end, start, …)."""
    spark = docs.sparkSession
    rows = texts_of(docs, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Repeated ids are told apart by the text; equal rows stay equal and are each other's copies.
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    runs = _runs(rows.select("row", "text"), length, anchor)

    counted = runs.groupBy("a").agg(F.sum("times").alias("n")).where("n > 1").select("a")
    repeated = settle(attach(runs, counted, ["a"]))
    equal = repeated.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("windows").alias("own"), F.min(F.struct("row", "start")).alias("one"))
    kinds = equal.groupBy("a").agg(F.count(F.lit(1)).alias("kinds"), F.sum("own").alias("of_kinds"))
    settled = F.col("n") > 1
    known = attach(attach(repeated, equal, ["a", "b"]), kinds, ["a"])
    one = settled & (F.struct("row", "start") == F.col("one"))
    known = known.select(
        "row", "start", "windows", "a", settled.alias("settled"), (F.col("of_kinds") > group_windows).alias("large"),
        ((F.col("kinds") > 1) & (~settled | one) | ~settled & (F.col("times") > 1)).alias("open"),
    ).where("settled OR open")
    by_row = known.groupBy("row").agg(F.collect_list(F.struct("start", "windows", "a", "settled", "large", "open")).alias("runs"))

    def first(batches):
        for batch in pieces(batches):
            columns: dict[str, list] = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "text", "open")}
            for text, own in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                raw = text.encode()
                flat = [x for r in own or () if r["settled"] for x in (r["start"], r["start"] + r["windows"] - 1 + length)]
                open_ = [
                    {"a": r["a"], "start": r["start"], "large": r["large"], "text": raw[r["start"] : r["start"] + r["windows"] - 1 + length]}
                    for r in own or () if r["open"]
                ]
                if open_:
                    values = (None, None, None, None, [x for r in _merge(flat) for x in r], text, open_)
                else:
                    values = (*_result(raw, flat), None, [])
                for column, value in zip(columns.values(), values, strict=True):
                    column.append(value)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.string(), pa.list_(_OPEN)]
            arrays = [pa.array(c, t) for c, t in zip(columns.values(), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), *arrays], names=["doc_id", "row", *columns])

    path = scratch_path(spark, "repeats")
    schema = f"doc_id long, row long, {_RESULT}, text string, open array<struct<a:long,start:int,large:boolean,text:binary>>"
    rows.join(by_row, "row", "left").select("doc_id", "row", "text", "runs").mapInArrow(first, schema).write.parquet(path)
    seen = spark.read.schema(schema).parquet(path)

    open_runs = seen.select("row", F.explode("open").alias("o")).select("row", "o.*")
    # Rows that are equal bring the same runs; one of them is enough, and their windows are settled already.
    small = _small_groups(open_runs.where("NOT large"), length)
    large = _large_groups(open_runs.where("large"), length)
    hits = small.unionByName(large).groupBy("row").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))

    def last(batches):
        for batch in pieces(batches):
            texts, spans, ranges = (batch.column(n).to_pylist() for n in ("text", "spans", "ranges"))
            found = [_result(t.encode(), [*s, *(r or ())]) for t, s, r in zip(texts, spans, ranges, strict=True)]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32())]
            arrays = [pa.array([f[i] for f in found], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    waiting = seen.where("text IS NOT NULL").join(hits, "row", "left").select("doc_id", "text", "spans", "ranges")
    finished = seen.where("text IS NULL").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
    return finished.unionByName(waiting.mapInArrow(last, f"doc_id long, {_RESULT}"))


_OPEN = pa.struct([("a", pa.int64()), ("start", pa.int32()), ("large", pa.bool_()), ("text", pa.binary())])
