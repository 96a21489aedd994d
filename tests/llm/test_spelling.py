"""Spelling variants against comparing all words with each other."""

import random
import re
import zlib
from collections import Counter

import pytest

from chartlift.llm import spelling

SCHEMA = "doc_id long, text string, word string, n long, bucket string"


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def counted(rows):
    out = Counter()
    for number, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if number is None else number}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def grouped(words):
    out, forms = {}, {}
    for w, n in words.items():
        mates = [v for v in words if near(w, v)]
        best = min(mates, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
        out[w] = [w, forms[w], w, n, len(mates), words[forms[w]] if forms[w] else None]
    for w in out:
        while forms[out[w][2]]:
            out[w][2] = forms[out[w][2]]
    return sorted(map(tuple, out.values()), key=repr)


def random_words(seed, alphabet, size, count):
    rng = random.Random(seed)
    words = {}
    while len(words) < count:
        word = "".join(rng.choice(alphabet) for _ in range(rng.randint(7, size)))
        for w in (word, word[:3] + word[4:] if len(word) > 7 else word, word[:2] + rng.choice(alphabet) + word[2:], word[:-1] + rng.choice(alphabet), rng.choice(alphabet) + word):
            words[w] = rng.choice([2, 2, 3, 25, 30, 300, 3000, 30_000])
    return words


@pytest.mark.parametrize(("alphabet", "size", "bucket", "letters"), [("ab", 11, 4096, 200_000), ("ab", 11, 8, 200_000), ("abcé÷", 9, 4096, 60), ("etaoin", 40, 3, 30), ("a", 30, 2, 10)])
def test_all_pairs(spark, alphabet, size, bucket, letters):
    words = random_words(5, alphabet, size, 20 if alphabet == "a" else 500)
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    found = spelling.variants(frame, bucket=bucket, letters=letters)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, found.collect()), key=repr) == grouped(words)


def test_tables(spark):
    rng = random.Random(3)
    stems = ["hospital", "Hospital", "Krankenhaus", "müllerin", "MÜLLERIN", "straßen", "aaaaaaaa", "aaaaaaaaa", "abcdefg" * 400]
    rows = [(n, " ".join(rng.choice(stems) for _ in range(60)) + ", foo_bar hospitals9hospitals") for n in range(60)]
    rows += [(1, None), (2, ""), (None, "hospital Krankenhaus krankenhau krankenhau"), (3, rows[3][1]), (3, rows[3][1]), (70, "x" * 100_000 + " " + "x" * 100_000)]
    docs = spark.createDataFrame([(n, t, "clash", 1, None) for n, t in rows], SCHEMA).repartition(3)
    found = sorted(map(tuple, spelling.spelling_variants(docs).collect()), key=repr)
    assert found == grouped(counted(rows)) and any(r[1] for r in found)
    assert spelling.spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0


def test_small_folder(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    words = counted([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(map(tuple, spelling.spelling_variants(docs).collect()), key=repr) == grouped(words)
