"""Trained operators: held-out accuracy, and odd rows."""

import itertools
import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartlift.llm import quality_model, queries, toxicity
from chartlift.llm.labels import held_out, training_labels

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score string, toxic int"
LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")
@pytest.mark.parametrize(("name", "label", "recall", "false"), [("op5_toxicity", "toxic", 0.6, 0.02), ("op6_quality_model", "quality", 0.97, 0.05)])
def test_held_out_rows(spark, name, label, recall, false):
    """Recall and false rate on rows that were not learned from (the smallest folder with both labels)."""
    labels = queries.table(spark, FOLDER, "labels")
    found = queries.QUERIES[name](spark, FOLDER)
    assert found.count() == queries.table(spark, FOLDER, "documents").count()
    rates = found.join(labels, "doc_id").where("held_out").groupBy(label).agg(F.avg("predicted").alias("rate")).collect()
    rates = {r[label]: r.rate for r in rates}
    assert rates[1] >= recall and rates[0] <= false, rates


LARGER = "/root/testdata/sf0.1"
INSULTS = ["loser", "idiot", "pathetic", "scum", "worthless", "moron", "trash", "clown", "disgusting", "stupid"]


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="the given tables are not here")
def test_insults_with_something_put_in(spark):
    """One letter, sign or space inside the only insult of a document: it is still caught in 0.9 of all cases, at a false rate below 0.01."""
    docs, labels = queries.table(spark, LARGER, "documents"), queries.table(spark, LARGER, "labels")
    texts = [r.text for r in docs.join(labels.where("toxic = 0"), "doc_id").where("length(text) BETWEEN 200 AND 4000").orderBy("doc_id").select("text").collect()]
    texts = [t for _, t in toxicity._without_copies([(0, t) for t in texts])]
    rng = np.random.default_rng(5)

    def with_words(text, some):
        words = text.split(" ")
        for word in some:
            words.insert(int(rng.integers(len(words))), word)
        return " ".join(words)

    learned, held = texts[: len(texts) * 2 // 3], texts[len(texts) * 2 // 3 :]
    rows = [(int(i % 3 == 0), with_words(t, rng.choice(INSULTS, size=2)) if i % 3 == 0 else t) for i, t in enumerate(learned)]
    scorer = toxicity.Scorer(toxicity.train(rows, 1 / 3))
    assert (scorer(held) >= toxicity.CUT).mean() <= 0.01
    for kind in ("l", "*", "s"):
        mixed = [with_words(t, [toxicity.altered(INSULTS[i % 10], "abcdefghijklmnopqrstuvwxyz", rng, kind)]) for i, t in enumerate(held)]
        assert (scorer(mixed) >= toxicity.CUT).mean() >= 0.9, kind
    mixed = [" ".join(toxicity.altered(w, "etaoinshr", rng, "l*s") if len(w) > 3 else w for w in t.split(" ")) for t in held]
    assert (scorer(mixed) >= toxicity.CUT).mean() <= 0.05  # clean documents with something put into every word


def enumerated(span):
    """Every subsequence of four characters with its weight, by trying all places; the weights have norm 1 as the operator counts it."""
    out, square = Counter(), 0.0
    for places in itertools.combinations(range(len(span)), 4):
        width = places[3] - places[0] + 1
        if width <= toxicity.SPAN:
            out["".join(span[i] for i in places)] += toxicity.DECAY ** (width - 4)
            square += toxicity.DECAY ** (2 * width - 8)
    return {u: x / math.sqrt(square) for u, x in out.items()}


def kernel(a, b):
    return sum(x * b.get(u, 0.0) for u, x in a.items())


SPANS = ["^idiot", "^idxiot", "^id^iot", "^idioot", "^garden", "^gar^den", "^aaaaaaa", "^abc", "^ab"]


def test_kernel_is_that_of_all_subsequences():
    number, key, weight = toxicity.subsequences(SPANS)
    features = np.zeros((len(SPANS), 1 << toxicity.HASH_BITS))
    np.add.at(features, (number, key), weight)
    exact = np.array([[kernel(enumerated(a), enumerated(b)) for b in SPANS] for a in SPANS])
    assert np.allclose(features @ features.T, exact)
    assert exact[0, 1] > 0.3 and exact[0, 2] > 0.3 and exact[0, 4] < 0.05  # inserted letters and spaces stay near


def test_landmark_map_gives_the_kernel_at_the_landmarks():
    spans = SPANS[:8]
    used, table, root = toxicity._landmark_map(spans)
    features = toxicity._nystroem(spans, used, table, root)
    exact = np.array([[kernel(enumerated(a), enumerated(b)) for b in spans] for a in spans])
    assert np.allclose(features @ features.T, exact, atol=2e-3)


def test_spans_of_a_text_score_like_their_own():
    rng = np.random.default_rng(2)
    model = toxicity.Model(rng.normal(size=1 << toxicity.HASH_BITS), -0.7, np.array([1.0, 0.0]))
    stream = toxicity.stream_of(["You are an Id-iot. A mor on, i d i o t x!", "", "ünder 123 the\tsea... a.b c"])
    words = stream.words()
    assert words == ["^you", "^are", "^an", "^idiot", "^a", "^mor", "^on", "^i", "^d", "^i", "^o", "^t", "^x", "^idiot", "^ünder", "^the", "^sea", "^ab", "^c"]
    one, two = model.spans(stream)
    expected = [toxicity._word_scores(model, [w])[0] if len(w) > 3 else -0.7 for w in words]
    assert np.allclose(one, expected)
    ends = {3, 12, 13, 16, 18}
    assert {i for i in range(len(words)) if two[i] == -np.inf} == ends
    for i in set(range(len(words) - 1)) - ends:
        pair = words[i] + words[i + 1]
        assert np.isclose(two[i], toxicity._word_scores(model, [pair])[0])


def test_long_texts_are_scored_whole(monkeypatch):
    rng = np.random.default_rng(3)
    model = toxicity.Model(rng.normal(size=1 << toxicity.HASH_BITS), -0.7, np.array([1.0, 0.0]))
    texts = [" ".join("".join(rng.choice(list("abcde"), size=6)) for _ in range(300)) for _ in range(5)] + ["x" * 5000, "", None]
    whole = toxicity.Scorer(model)(texts)
    monkeypatch.setattr(toxicity, "CHUNK_CHARS", 90)
    assert np.allclose(toxicity.Scorer(model)(texts), whole)


def test_discriminant_is_the_difference_of_dense_log_densities(spark):
    """The fitted score against densities from explicit inverses and determinants of the shrunk covariances."""
    rng = np.random.default_rng(4)
    size = len(quality_model.NAMES)
    ids = np.array([i for i in range(400) if zlib.crc32(str(i).encode()) % 5])
    label = ids % 3 == 0
    x = rng.normal(size=(len(ids), size)) @ rng.normal(size=(size, size)) * 0.4 + label[:, None]
    measured = spark.createDataFrame([(int(i), row.tolist()) for i, row in zip(ids, x, strict=True)], "doc_id long, stats array<double>")
    model = quality_model.fit(measured, spark.createDataFrame([(int(i), int(y), 0) for i, y in zip(ids, label, strict=True)], LABELS))
    parts = [x[~label], x[label]]
    pooled = sum(len(p) * np.cov(p.T, bias=True) for p in parts) / len(x)
    density = []
    for part in parts:
        c = (1 - quality_model.TO_POOLED) * np.cov(part.T, bias=True) + quality_model.TO_POOLED * pooled
        c = (1 - quality_model.TO_DIAGONAL) * c + quality_model.TO_DIAGONAL * np.diag(np.diag(c)) + quality_model.RIDGE * np.eye(size)
        away = x - part.mean(axis=0)
        density.append(-0.5 * np.einsum("ni,ij,nj->n", away, np.linalg.inv(c), away) - 0.5 * np.linalg.slogdet(c)[1] + np.log(len(part)))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-(density[1] - density[0]))), atol=1e-6)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x", 1), (2, "", "x", 1), (2, "", "x", 1), (None, "some words", "x", 0), (4, "a " * 30000, "x", 0)], SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 1), (None, 1, 1), (4, None, None), (6, 1, 0), (6, 0, 1)], LABELS)
    for operator in (toxicity.toxicity, quality_model.quality):
        found = operator(docs, labels).collect()
        assert len(found) == 5 and all(0 <= r.score <= 1 for r in found)
        assert [operator(docs.limit(0), labels.limit(0)).count(), len(operator(docs, labels.limit(0)).collect())] == [0, 5]
    assert toxicity.without_toxic(docs, None).columns == docs.columns
    assert toxicity.without_toxic(docs, None).count() == 5


def test_training_rows_exclude_the_held_out_and_the_contradicting(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(7, 0, 0)], LABELS)
    used = {r.doc_id for r in training_labels(labels, "quality").collect()}
    assert used == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5} - {7}
