"""Line dedup with two Bloom filters (operator 7).

A line's key is the line without white space at its ends, A-Z lower-cased. Keys of at least ``min_chars`` code points
that at least ``min_docs`` documents hold are dropped everywhere but in the document with the largest id.

1. Every task notes its keys in two filters, seen once and seen twice. The filters are cut into segments and folded
   by segment: a bit is seen twice if it is so in one part or seen once in two parts.
2. The seen-twice filter (``filter_bits`` bits, whatever the input's size) is broadcast. A second scan lets only keys
   through that it holds: all keys of two documents or more, and some false alarms.
3. Only these suspects are shuffled, as 128-bit digests with document ids; they are counted exactly and the largest
   id is chosen. A filter that is too small for a corpus means more suspects, never another result.

A null or empty text is one empty line. Each row is a document, also if rows repeat; rows with a null id sort before
all others. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlift.llm.common import pieces, rewrite_texts, texts_of
from chartlift.operators.joins import attach
from chartlift.runtime import settle

MIN_CHARS = 20
MIN_DOCS = 3
FILTER_BITS = 1 << 27  # of each filter: 16 MiB
SEGMENT_BITS = 1 << 19
HASHES = 2
CHUNK_KEYS = 1_000_000  # keys a task notes before it hands its filters on
_BLANK = " \t\n\v\f\r"


def line_key(line: str, min_chars: int) -> bytes | None:
    key = line.strip(_BLANK)
    return key.encode().lower() if len(key) >= min_chars else None  # bytes.lower() changes A-Z only


def _bits(hashes: np.ndarray, filter_bits: int) -> np.ndarray:
    """The places of each 64-bit hash, one row per hash function."""
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32)
    return np.stack([(low + np.uint64(i) * (high | np.uint64(1))) % np.uint64(filter_bits) for i in range(HASHES)])


def _rows(hashes: list[int], filter_bits: int):
    """(segment, once, twice) of the filters of some keys; each document gives a key once."""
    found, times = np.unique(np.array(hashes, dtype=np.uint64), return_counts=True)
    once = np.unique(_bits(found, filter_bits))
    twice = np.unique(_bits(found[times > 1], filter_bits))
    size = np.uint64(min(SEGMENT_BITS, filter_bits))
    for segment in np.unique(once // size).tolist():
        yield segment, _pack(once, segment, size), _pack(twice, segment, size)


def _pack(places: np.ndarray, segment: int, size: np.uint64) -> bytes:
    first, last = np.searchsorted(places, [segment * int(size), (segment + 1) * int(size)])
    flags = np.zeros(int(size), dtype=bool)
    flags[(places[first:last] - np.uint64(segment * int(size))).astype(np.int64)] = True
    return zlib.compress(np.packbits(flags).tobytes(), 1)


def _fold(table: pa.Table) -> pa.Table:
    """Several parts of one segment as one part."""
    once = twice = None
    for a, b in zip(table.column("once"), table.column("twice"), strict=True):
        x, y = (np.frombuffer(zlib.decompress(v.as_py()), dtype=np.uint8) for v in (a, b))
        if once is None:
            once, twice = x.copy(), y.copy()
        else:
            twice |= y | (once & x)
            once |= x
    row = {"segment": [table.column("segment")[0].as_py()], "part": [0]}
    row |= {"once": [zlib.compress(once.tobytes(), 1)], "twice": [zlib.compress(twice.tobytes(), 1)]}
    return pa.table(row, schema=pa.schema([("segment", pa.int64()), ("part", pa.int64()), ("once", pa.binary()), ("twice", pa.binary())]))


def seen_twice(docs: DataFrame, min_chars: int, filter_bits: int) -> np.ndarray:
    """The seen-twice filter of all keys, as packed bits."""

    def note(batches):
        hashes: list[int] = []
        number = 0

        def out():
            rows = list(_rows(hashes, filter_bits))
            columns = [[r[0] for r in rows], [number % 16] * len(rows), [r[1] for r in rows], [r[2] for r in rows]]
            types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["segment", "part", "once", "twice"])

        for batch in pieces(batches):
            for text in batch.column("text").to_pylist():
                keys = {k for k in (line_key(line, min_chars) for line in text.split("\n")) if k is not None}
                hashes.extend(map(xxhash.xxh3_64_intdigest, keys))
                number += len(keys)
                if len(hashes) >= CHUNK_KEYS:
                    yield out()
                    hashes.clear()
        if hashes:
            yield out()

    schema = "segment long, part long, once binary, twice binary"
    parts = docs.select("text").mapInArrow(note, schema)
    folded = parts.groupBy("segment", "part").applyInArrow(_fold, schema).groupBy("segment").applyInArrow(_fold, schema)
    size = min(SEGMENT_BITS, filter_bits) // 8
    filter_ = np.zeros(filter_bits // 8, dtype=np.uint8)
    for segment, twice in folded.select("segment", "twice").toLocalIterator():  # filter_bits / 8 bytes at most
        filter_[segment * size : (segment + 1) * size] = np.frombuffer(zlib.decompress(bytes(twice)), dtype=np.uint8)
    return filter_


def _suspects(docs: DataFrame, filter_: np.ndarray, min_chars: int, filter_bits: int) -> DataFrame:
    """(doc_id, key digest) of each document's keys that the filter holds."""
    shared = docs.sparkSession.sparkContext.broadcast(zlib.compress(filter_.tobytes(), 1))

    def look(batches):
        bits = np.frombuffer(zlib.decompress(shared.value), dtype=np.uint8)
        for batch in pieces(batches):
            ids, keys = [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = {k for k in (line_key(line, min_chars) for line in text.split("\n")) if k is not None}
                keys.extend(own)
                ids.extend([doc] * len(own))
            places = _bits(np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=np.uint64, count=len(keys)), filter_bits)
            held = ((bits[places >> np.uint64(3)] >> (np.uint8(7) - (places & np.uint64(7)).astype(np.uint8))) & 1).all(axis=0)
            at = np.flatnonzero(held).tolist()
            digests = [hashlib.blake2b(keys[i], digest_size=16).digest() for i in at]
            yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in at], pa.int64()), pa.array(digests, pa.binary())], names=["doc_id", "line"])

    return docs.mapInArrow(look, "doc_id long, line binary")


def lines_to_drop(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """doc_id and the digests of the keys it loses; one row for each document that loses any."""
    filter_ = seen_twice(docs, min_chars, filter_bits)
    suspects = settle(_suspects(docs, filter_, min_chars, filter_bits))
    repeated = suspects.groupBy("line").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("keeper"))
    repeated = repeated.where((F.col("docs") >= min_docs) & F.col("keeper").isNotNull()).select("line", "keeper")
    lost = attach(suspects, repeated, ["line"]).where(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("keeper")))
    return lost.groupBy("doc_id").agg(F.collect_set("line").alias("lines"))  # bounded by the document's own lines


def without_lines(text: str, lost: list[bytes] | None, min_chars: int) -> tuple[str, int, int]:
    """(text without the lines whose keys are lost, lines before, lines dropped)."""
    lines = text.split("\n")
    if not lost:
        return text, len(lines), 0
    gone = set(lost)
    keys = [line_key(line, min_chars) for line in lines]
    kept = [x for x, k in zip(lines, keys, strict=True) if k is None or hashlib.blake2b(k, digest_size=16).digest() not in gone]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def _with_losses(docs: DataFrame, id_col: str, drops: DataFrame) -> DataFrame:
    drops = drops.select(F.col("doc_id").alias("_lines_id"), F.col("lines").alias("_lines"))
    return docs.join(drops, docs[id_col].cast("long").eqNullSafe(F.col("_lines_id")), "left").drop("_lines_id")


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """The rows with all their columns, their texts without repeated lines (a null text stays null)."""
    rows = texts_of(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    joined = _with_losses(docs, id_col, lines_to_drop(rows, min_chars, min_docs, filter_bits))

    def make():
        return lambda texts, lost: [t and without_lines(t, x, min_chars)[0] for t, x in zip(texts, lost, strict=True)]

    return rewrite_texts(joined, make, text_col, "_lines")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    filter_bits: int = FILTER_BITS, with_text: bool = True,
) -> DataFrame:
    """doc_id, n_lines (before), n_dropped, kept_sha256 and, if wanted, the text that is kept."""
    rows = texts_of(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    joined = _with_losses(rows, "doc_id", lines_to_drop(rows, min_chars, min_docs, filter_bits))

    def cut(batches):
        for batch in pieces(batches):
            found = [without_lines(t, x, min_chars) for t, x in zip(batch.column("text").to_pylist(), batch.column("_lines").to_pylist(), strict=True)]
            columns = [batch.column("doc_id"), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64())]
            columns.append(pa.array([hashlib.sha256(f[0].encode()).hexdigest() for f in found], pa.string()))
            names = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
            if with_text:
                columns.append(pa.array([f[0] for f in found], pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    tail = ", kept_text string" if with_text else ""
    return joined.mapInArrow(cut, "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + tail)
