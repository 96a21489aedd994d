"""Groups of spelling variants: words one letter apart, and the frequent form that a rare one stands for (operator 13).

Words are counted in the tasks that read the texts. Two words one letter apart agree in all letters but those of a
window: cut the longer word's positions into two windows, and the pair agrees before and after one of them. So a word
goes into the buckets of its windows, once as the longer and once as the shorter of a pair. Buckets of more than BUCKET words or
BUCKET_LETTERS letters are cut into the halves of their window, again and again; a window of one position holds few words.

In a task, the words of some buckets get one index: for every (position, letter) a set of words as bits of 64-bit
numbers. For all words as queries at once, one letter after the other, sets of the words that agree so far (zero errors)
and of those with one replaced, one additional or one missing letter move on by logical operations on whole numbers; the
latter two look at shifted positions. The error is the first place where the words differ, and counts
only in the window that holds it, so every pair is found once. Bits are in order of falling count, so the first bit of
a result is the most frequent near word. No pairs leave the task: only a number and the best word for each word and bucket.

Null and empty texts have no words; a null id counts as the text ``null``; rows that share an id are counted each;
very long texts and runs are whole; of near words with equal counts the first by code point is the form; an empty
table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlift.llm.common import pieces
from chartlift.operators.joins import attach
from chartlift.runtime import settle

SHORTEST = 7
LEAST = 2  # occurrences of a word
MORE = 10  # times as frequent as a word is its form
DELETED = 31
BUCKET = 4096
BUCKET_LETTERS = 200_000
GROUP = 512  # words that share an index, at least
QUERIES = 1024  # words asked at once
KNOWN_WORDS = 300_000
_RUN = re.compile(f"[a-zÀ-ÿ]{{{SHORTEST},}}")
_STRUCT = "bucket string, word string, n long, low int, high int, size int"


def runs_of(texts: list[str | None], ids: list[str], counted: Counter) -> None:
    """Add the words of texts to ``counted``: runs of letters, some of which lose a letter that their hash names."""
    for text, name in zip(texts, ids, strict=True):
        if not text:
            continue
        start = zlib.crc32(f"{name}:".encode())
        for run, times in Counter(_RUN.findall(text.encode().lower().decode())).items():  # bytes lower A-Z only
            hashed = zlib.crc32(run.encode(), start)
            if hashed % DELETED == 0:
                place = hashed % len(run)
                run = run[:place] + run[place + 1 :]
                if len(run) < SHORTEST:
                    continue
            counted[run] += times


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(word, n) of all words with at least ``least`` occurrences."""
    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("name"), F.col(text_col).alias("text"))

    def run(batches):
        counted: Counter = Counter()

        def rows():
            while counted:
                some = [counted.popitem() for _ in range(min(20_000, len(counted)))]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], names=["word", "n"])

        for batch in pieces(batches):
            runs_of(batch.column("text").to_pylist(), batch.column("name").to_pylist(), counted)
            if len(counted) > KNOWN_WORDS:
                yield from rows()
        yield from rows()

    found = texts.mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _bucketed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, size, low, high) with the bucket of the window from low to high, of a longer word of ``size`` letters."""
    before = F.col("word").substr(F.lit(1), F.col("low"))
    after = F.col("size") - F.col("high")
    behind = F.col("word").substr(F.length("word") - after + 1, after)
    return rows.withColumn("bucket", F.concat_ws("|", "size", "low", "high", before, behind)).select("bucket", "word", "n", "low", "high", "size")


def windows(words: DataFrame) -> DataFrame:
    """Each word in the buckets of the two windows of the longer word that it is or that it lacks a letter of."""
    sized = words.withColumn("size", F.explode(F.array(F.length("word"), F.length("word") + 1)))
    middle = F.floor(F.col("size") / 2).cast("int")
    pairs = F.array(F.struct(F.lit(0).alias("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("size").alias("high")))
    return _bucketed(sized.withColumn("window", F.explode(pairs)).select("word", "n", "size", "window.low", "window.high"))


def _halves(rows: DataFrame) -> DataFrame:
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    pairs = F.array(F.struct(F.col("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high")))
    return _bucketed(rows.withColumn("window", F.explode(pairs)).select("word", "n", "size", "window.low", "window.high"))


def buckets(words: DataFrame, bucket: int = BUCKET, letters: int = BUCKET_LETTERS) -> DataFrame:
    """The rows of all buckets, none of them above the bounds unless its window is a single position."""
    done, rows = None, windows(words)
    while True:
        weights = rows.groupBy(F.xxhash64("bucket").alias("key")).agg(
            F.count(F.lit(1)).alias("members"), F.sum(F.col("high") - F.col("low")).alias("letters"), F.max(F.col("high") - F.col("low")).alias("span")
        )
        large = settle(weights.where((F.col("members") > 1) & (F.col("span") > 1) & ((F.col("members") > bucket) | (F.col("letters") > letters))).select("key", F.lit(True).alias("large")))
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        marked = settle(attach(rows.withColumn("key", F.xxhash64("bucket")), large, ["key"], "left").drop("key"))
        small = marked.where("large IS NULL").drop("large")
        done = small if done is None else done.unionByName(small)
        rows = _halves(marked.where("large"))


class Index:
    """Sets of words as bits, for every (position, letter) that occurs in their windows.

    Windows come with the letter behind them, so that a difference that lies behind a window is not taken for one at its end.
    """

    def __init__(self, windows: list[str], bucket: np.ndarray, longer: np.ndarray, limit: np.ndarray):
        self.count, self.limit, self.longer, self.bucket = len(windows), limit, longer, bucket
        self.lengths = np.fromiter(map(len, windows), np.int64, self.count)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer("".join(windows).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        owner = np.repeat(np.arange(self.count), self.lengths)
        place = np.arange(len(self.letters)) - np.repeat(self.starts, self.lengths)
        self.keys, row = np.unique(place << 21 | self.letters, return_inverse=True)
        self.has = self._sets(row, owner, len(self.keys) + 1)  # the last set stays empty
        self.mates = self._sets(bucket, np.arange(self.count), int(bucket.max()) + 1)
        self.of_length = {n: self._some(self.lengths == n) for n in {n + d for n in set(self.lengths.tolist()) for d in (0, 1, -1)}}
        self.of_longer, self.of_shorter = self._some(longer), self._some(~longer)

    def _sets(self, row: np.ndarray, word: np.ndarray, rows: int) -> np.ndarray:
        out = np.zeros((rows, (self.count + 63) // 64), dtype=np.uint64)
        np.bitwise_or.at(out, (row, word >> 6), np.uint64(1) << (word & 63).astype(np.uint64))
        return out

    def _some(self, chosen: np.ndarray) -> np.ndarray:
        word = np.flatnonzero(chosen)
        return self._sets(np.zeros(len(word), np.int64), word, 1)[0]

    def _with(self, place: int, letters: np.ndarray) -> np.ndarray:
        """For each letter, the set of the words that have it at a place."""
        if place < 0:
            return self.has[np.full(len(letters), -1)]
        keys = place << 21 | letters
        row = np.searchsorted(self.keys, keys)
        row[row == len(self.keys)] = 0
        return self.has[np.where(self.keys[row] == keys, row, -1)]

    def near(self, queries: np.ndarray) -> np.ndarray:
        """The set of words one letter from each query; queries are in order of falling length."""
        lengths, limit = self.lengths[queries], self.limit[queries]
        zero = self.mates[self.bucket[queries]]
        other, more, less = np.zeros_like(zero), np.zeros_like(zero), np.zeros_like(zero)
        for place in range(int(lengths.max(initial=0))):
            live = int(np.searchsorted(-lengths, -place, side="left"))  # those longer than place
            letters = self.letters[self.starts[queries[:live]] + place]
            here = self._with(place, letters)
            z = zero[:live]
            # What agreed so far and differs here, where the window allows an error.
            turn = z & ~here & np.where(place < limit[:live], ~np.uint64(0), np.uint64(0))[:, None]
            other[:live] = (other[:live] & here) | turn
            more[:live] = (more[:live] | turn) & self._with(place + 1, letters)
            less[:live] = (less[:live] & self._with(place - 1, letters)) | turn
            z &= here
        more |= zero & np.where(lengths < limit, ~np.uint64(0), np.uint64(0))[:, None]  # one letter at the end
        same, above, below = (np.stack([self.of_length[int(n)] for n in lengths + d]) if len(queries) else zero for d in (0, 1, -1))
        # Pairs of two shorter words belong to the windows of a smaller size.
        long = np.where(self.longer[queries], ~np.uint64(0), np.uint64(0))[:, None]
        return (other & same & self.of_longer & long) | (less & below & self.of_shorter & long) | (more & above & self.of_longer & ~long)


def _find(rows: list[tuple[str, str, int, int, int, int]]) -> tuple[list, list, list, list]:
    """For whole buckets: words that have near words, the number of these, and the first of them by count and code point."""
    rows = sorted(rows, key=lambda r: (-r[2], r[1]))
    number: dict[str, int] = {}
    bucket = np.array([number.setdefault(r[0], len(number)) for r in rows])
    cut = [word[low : len(word) - (size - high) + 1] for _, word, _, low, high, size in rows]
    longer = np.array([len(r[1]) == r[5] for r in rows])
    index = Index(cut, bucket, longer, np.array([r[4] - r[3] for r in rows]))
    order = np.argsort(-index.lengths, kind="stable")
    words, near, best_n, best = [], [], [], []
    step = max(64, QUERIES * GROUP // len(rows))
    for start in range(0, len(rows), step):
        queries = order[start : start + step]
        found = index.near(queries)
        counts = np.bitwise_count(found).sum(axis=1)
        hit = np.flatnonzero(counts)
        block = (found[hit] != 0).argmax(axis=1)
        bits = found[hit, block]
        first = block * 64 + np.bitwise_count((bits & (~bits + np.uint64(1))) - np.uint64(1))
        words += [rows[i][1] for i in queries[hit]]
        near += counts[hit].tolist()
        best_n += [rows[i][2] for i in first]
        best += [rows[i][1] for i in first]
    return words, near, best_n, best


def _search(batches):
    held: list = []  # whole buckets
    current: list = []  # the bucket that is being read

    def batch(rows):
        words, near, best_n, best = _find(rows)
        columns = [pa.array(words, pa.string()), pa.array(near, pa.int64()), pa.array(best_n, pa.int64()), pa.array(best, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "near", "best_n", "best"])

    letters = 0
    for some in batches:
        for row in zip(*(column.to_pylist() for column in some.columns), strict=True):
            if current and current[0][0] != row[0]:
                if len(current) > 1:
                    held += current
                    letters += sum(r[4] - r[3] for r in current)
                current = []
                if len(held) >= GROUP or letters > BUCKET_LETTERS:
                    yield batch(held)
                    held, letters = [], 0
            current.append(row)
    if len(current) > 1:
        held += current
    if held:
        yield batch(held)


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms are followed to the last, twice as far in each round."""
    reached = links.select("word", F.col("form").alias("root"))
    while True:
        # A frequent word is the form of many: a hot key of the left side, which adaptive execution splits.
        further = attach(reached, reached.select(F.col("word").alias("root"), F.col("root").alias("next")), ["root"], "left")
        further = settle(further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        reached = further.select("word", "root")
        if further.where("moved").isEmpty():
            return reached


def variants(words: DataFrame, more: int = MORE, bucket: int = BUCKET, letters: int = BUCKET_LETTERS) -> DataFrame:
    """word, form, root, n, n_near and form_n of a vocabulary (word, n)."""
    words = settle(words)
    rows = buckets(words, bucket, letters)
    found = rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_search, "word string, near long, best_n long, best string")
    alone = words.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    both = alone.unionByName(found.withColumn("n", F.lit(None).cast("long")))
    # The struct is null, and passed over, for rows without a near word.
    first = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("form"))))
    stats = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), first.alias("first"))
    fits = -F.col("first.minus") >= more * F.col("n")
    stats = settle(stats.select("word", F.when(fits, F.col("first.form")).alias("form"), "n", "n_near", F.when(fits, -F.col("first.minus")).alias("form_n")))
    roots = _roots(stats.where("form IS NOT NULL"))
    named = stats.join(roots, "word", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return variants(vocabulary(docs, id_col, text_col))
