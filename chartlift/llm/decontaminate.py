"""Benchmark decontamination with an Aho-Corasick automaton (operator 4).

Texts are normalised to lower-case words between single spaces. The windows of ten words of all benchmark items (an
item of fewer words is one window) are the automaton's patterns; each document is scanned once and its hits are
mapped back to words and to offsets in the original text.

The benchmark is taken in blocks of at most ``block_words`` words, one automaton each, so one broadcast is bounded;
every document passes all blocks in one stage without a shuffle. The benchmark goes through the driver and a task holds
the automata of all blocks at once, so memory grows with the benchmark; its largest size has not been measured.

Null and empty texts have no words and no hits; items without words or without an id have no windows; items of one id
count once; an empty benchmark hits nothing; repeated rows are judged each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlift.llm.common import pieces, rewrite_texts, texts_of

WINDOW = 10
BLOCK_WORDS = 500_000
WORD = regex.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")  # before lower-casing

_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))
_SCHEMA = "doc_id long, text string, n_words long, hits array<int>, items array<long>"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("hits", pa.list_(pa.int32())), ("items", pa.list_(pa.int64())),
])


def words_of(text: str) -> list[bytes]:
    """Lower-case words (only A-Z change) as UTF-8; bytes above 0x7F belong to words."""
    return text.encode().translate(_NORMAL).split()


def item_blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """(item, words) in blocks; a long item is cut into pieces that overlap by a window less one word."""
    block, size = [], 0
    for item, text in benchmark.toLocalIterator():
        words = words_of(text)
        for start in range(0, max(1, len(words) - window + 1), block_words):
            piece = words[start : start + block_words + window - 1]
            if not piece:
                continue
            if block and size + len(piece) > block_words:
                yield block
                block, size = [], 0
            block.append((item, piece))
            size += len(piece)
    if block:
        yield block


def build(block: list[tuple[int, list[bytes]]], window: int) -> ahocorasick.Automaton | None:
    patterns: dict[str, set[int]] = {}
    for item, words in block:
        for start in range(max(1, len(words) - window + 1)):
            pattern = b" " + b" ".join(words[start : start + window]) + b" "
            patterns.setdefault(pattern.decode("latin-1"), set()).add(item)
    automaton = ahocorasick.Automaton()
    for pattern, items in patterns.items():
        automaton.add_word(pattern, (len(pattern), tuple(items)))
    automaton.make_automaton()
    return automaton


def line_of(words: list[bytes]) -> str:
    """Words between single spaces, one character for each byte."""
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


def scan(automaton: ahocorasick.Automaton, words: list[bytes]) -> tuple[list[int], set[int]]:
    """Word ranges [first, last + 1) that occurrences cover, flat and merged, and the items they belong to."""
    line = line_of(words)
    ranges: list[list[int]] = []
    items: set[int] = set()
    for end, (length, owners) in automaton.iter(line):
        start = end - length + 1
        items.update(owners)
        while ranges and ranges[-1][1] > start:
            start = min(start, ranges.pop()[0])
        ranges.append([start, end])
    hits, word, place = [], 0, 0
    for start, end in ranges:
        word += line.count(" ", place, start)
        last = word + line.count(" ", start, end)
        hits += [word, last]
        word, place = last, end
    return hits, items


def union(first: list[int], second: list[int]) -> list[int]:
    """Two lists of ranges as one sorted list of disjoint ranges."""
    if not first or not second:
        return first or second
    out: list[int] = []
    both = sorted([*zip(first[::2], first[1::2], strict=True), *zip(second[::2], second[1::2], strict=True)])
    for start, end in both:
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _pass(block, window: int):
    """A pass over documents that adds the hits of one block of items."""

    def run(batches):
        automaton = build(block.value, window)
        for batch in pieces(batches):
            texts = batch.column("text").to_pylist()
            hits, items, counts = batch.column("hits").to_pylist(), batch.column("items").to_pylist(), []
            for number, text in enumerate(texts):
                words = words_of(text)
                counts.append(len(words))
                if words:
                    found, owners = scan(automaton, words)
                    if found:
                        hits[number] = union(hits[number], found)
                        items[number] = sorted({*items[number], *owners})
            columns = [batch.column("doc_id"), batch.column("text"), pa.array(counts, pa.int64())]
            columns += [pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    return run


def spans_in_text(text: str, hits: list[int]) -> list[tuple[int, int]]:
    """Character ranges of the original text for ranges of words."""
    if not hits:
        return []
    places = [m.span() for m in WORD.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in zip(hits[::2], hits[1::2], strict=True)]


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.col(item_col).cast("long"), text_col).where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull())


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows without any occurrence of a benchmark window, with all their columns."""
    context = docs.sparkSession.sparkContext

    def keeper(block):
        def make():
            automaton = build(block.value, window)

            def clean(text: str | None) -> bool:
                words = words_of(text or "")
                return not words or next(automaton.iter(line_of(words)), None) is None

            return lambda texts: [t if clean(t) else False for t in texts]

        return make

    for block in item_blocks(_items(benchmark, item_col, item_text_col), window, block_words):
        docs = rewrite_texts(docs, keeper(context.broadcast(block)), text_col)
    return docs


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS, with_spans: bool = True,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and, if wanted, the spans hit in the original text."""
    items = _items(benchmark, item_col, item_text_col)
    spark = docs.sparkSession
    rows = texts_of(docs, id_col, text_col)
    rows = rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("hits"), F.array().cast("array<long>").alias("items"),
    )
    passes = 0
    for block in item_blocks(items, window, block_words):
        rows = rows.mapInArrow(_pass(spark.sparkContext.broadcast(block), window), _SCHEMA)
        passes += 1
    if not passes:  # words are counted all the same
        rows = rows.mapInArrow(_pass(spark.sparkContext.broadcast([(0, [b" "])]), window), _SCHEMA)

    def finish(batches):
        for batch in batches:
            hits, owners = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
            names = [",".join(sorted(map(str, o))) for o in owners]
            columns = {
                "doc_id": batch.column("doc_id"), "n_words": batch.column("n_words"),
                "n_hit": pa.array([sum(h[1::2]) - sum(h[::2]) for h in hits], pa.int64()),
                "n_items": pa.array([len(o) for o in owners], pa.int64()),
                "items_sha256": pa.array([hashlib.sha256(n.encode()).hexdigest() for n in names], pa.string()),
                "contaminated": pa.array([bool(h) for h in hits], pa.bool_()),
            }
            if with_spans:
                texts = batch.column("text")
                spans = [[{"start": a, "end": b} for a, b in spans_in_text(texts[i].as_py(), h)] if h else [] for i, h in enumerate(hits)]
                columns["spans"] = pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return rows.mapInArrow(finish, schema + (", spans array<struct<start:int,end:int>>" if with_spans else ""))
