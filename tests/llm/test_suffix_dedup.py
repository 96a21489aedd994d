"""Repeated passages against a dictionary of all windows."""

import hashlib
import random
from collections import Counter

import pytest

from chartlift.llm import suffix_dedup

SCHEMA = "doc_id long, text string, row string, spans int"


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(raw[s : s + length] for _, raw in texts for s in range(len(raw) - length + 1))
    out = []
    for i, raw in texts:
        gone = bytearray(len(raw) + 1)
        for s in range(len(raw) - length + 1):
            if counts[raw[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        spans = sum(1 for k in range(len(raw)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def texts(seed):
    random.seed(seed)
    words = ["ab", "abc", "é", "bca", "aa", "zq", "ß", "xyz"]
    base = " ".join(random.choices(words, k=120))
    rows = [None, "", "short", base, base, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "x" * 13, "y" * 12, "abcab" * 11, "q" * 3000]
    for _ in range(60):
        text = list(" ".join(random.choices(words, k=random.randrange(5, 80))))
        if random.random() < 0.6:
            at, end = sorted(random.sample(range(len(base)), 2))
            text[len(text) // 2 : len(text) // 2] = base[at:end]
        rows.append("".join(text))
    return [*enumerate(rows), (None, base[:60]), (3, base), (7, "x" * 13)]


@pytest.mark.parametrize("group_windows", [2_000_000, 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_windows(spark, seed, group_windows):
    rows = texts(seed)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    found = suffix_dedup.remove_repeats(docs, length=12, anchor=4, group_windows=group_windows)
    ours = sorted((tuple(r)[:5] for r in found.drop("spans").collect()), key=repr)
    assert ours == brute(rows, 12)


def test_spans_name_the_removed_bytes(spark):
    docs = spark.createDataFrame([(1, "one " + "p" * 7 + "abcdefghijkl" + " two"), (2, "abcdefghijkl")], "doc_id long, text string")
    found = {r.doc_id: r.spans for r in suffix_dedup.remove_repeats(docs, length=12, anchor=4).collect()}
    assert found == {1: [11, 23], 2: [0, 12]}


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.remove_repeats(docs).count() == 0


def test_runs_with_equal_ends_and_another_middle(spark):
    random.seed(5)
    text = "".join(random.choices("abcdefghijklmnopqrstuvwxyz ", k=99)) + "\n"
    base = (text * 12).encode()
    copies = [base[:k] + b"#" + base[k + 1 :] for k in range(500, 600)]

    def runs(raw):  # windows and first digits
        return [x.tolist() for x in suffix_dedup.runs_of([raw])[2:4]]

    alike = [c for c in copies if runs(c) == runs(base)]
    rows = [(1, base.decode()), (2, alike[0].decode())]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r)[:5] for r in found.drop("spans").collect()) == brute(rows, 200)
