"""The pipeline against plain versions of its stages."""

import os
from collections import defaultdict

import pytest

import corpus_pipeline
from chartlift.llm import toxicity
from chartlift.llm.decontaminate import words_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")
BLANK = " \t\n\v\f\r"


def plain_lines(docs):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    holders = defaultdict(set)
    keys = {i: [line.strip(BLANK).translate(lower) for line in text.split("\n")] for i, text in docs.items()}
    for i, own in keys.items():
        for key in own:
            if len(key) >= 20:
                holders[key].add(i)
    gone = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    return {i: "\n".join(x for x, k in zip(text.split("\n"), keys[i], strict=True) if gone.get(k, i) == i) for i, text in docs.items()}


def plain_groups(docs):
    sets = {}
    for i, text in docs.items():
        words = text.encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    ids = sorted(docs)
    first = {i: i for i in ids}

    def top(i):
        while first[i] != i:
            i = first[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                first[y] = x
    return {i: t for i, t in docs.items() if top(i) == i}


def plain_clean(docs, items):
    windows = {(w[k : k + 10]) for w in map(tuple, map(words_of, items)) if w for k in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}

    def clean(text):
        words = tuple(words_of(text))
        return not any(words[k : k + n] in windows for n in sizes for k in range(len(words) - n + 1))

    return {i: t for i, t in docs.items() if clean(t)}


def test_pipeline(spark):
    tables = {n: spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels", "benchmark")}
    docs = {r.doc_id: r.text for r in tables["documents"].collect()}
    scorer = toxicity.Scorer(toxicity.fit(tables["documents"], tables["labels"]))
    docs = {i: t for (i, t), p in zip(docs.items(), scorer(list(docs.values())), strict=True) if p < 0.5}
    docs = plain_clean(plain_groups(plain_lines(docs)), [r.text for r in tables["benchmark"].collect()])
    found = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert set(found) == set(docs)
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    library = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    assert found == {i: library.encode(t, add_special_tokens=False).ids for i, t in docs.items()}


def test_stages_keep_columns_and_nulls(spark):
    rows = [(1, None, "en", "s", 0, "x"), (2, "", "en", "s", 0, "x"), (3, "clean words here", None, None, 16, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, FOLDER)
        assert found.schema.names == docs.schema.names, name
        assert {r.doc_id for r in found.collect()} == {1, 2, 3}, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == 3
