"""Alignment of two vocabularies against loops over tokens and bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("tiktoken")
pytest.importorskip("public_tokenizers")

from chartlift.llm import token_alignment  # noqa: E402
from chartlift.llm.merges import vocabulary_path  # noqa: E402
from chartlift.llm.token_alignment import Rows  # noqa: E402

SCHEMA = "doc_id long, text string, block string, links int, pair string"


def odd_texts():
    rng = random.Random(4)
    texts = [None, "", " ", "   ", "a", "the cat sat", "the cat sat", " x  y\n\n z\t", "<|endoftext|> <s></s><unk> <0x41>", "a▁b", "▁", "é̂ 가나다 𝔘 \U0010ffff", "\x00\x01", "Ａﬁ①", "don't I'll", "Äpfel " * 50]
    texts += ["".join(rng.choice(alphabet) for _ in range(600)) for alphabet in ("ab ", "etaoinshrdlu", "日本語の文", "  \n\t")]
    return [*texts, " " * 9000 + "x", "".join(rng.choice("abcdefgh ") for _ in range(20_000))]


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    code = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in visible)}
    names = {i: bytes(code[c] for c in name) for name, i in a.get_vocab().items() if i != 50256}
    return a, names, sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))


def tokens(libraries, text):
    a, names, b = libraries
    if not text:
        return [], []
    raw = b" " + text.encode()
    left = [(i, names[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()))
    if b"".join(x for _, x in left) != raw or b"".join(x for _, x in right) != raw:
        return [], []
    return left, right


def aligned(libraries, text):
    """n_a, n_b, links (place, place, id, id, bytes), groups as two lists of ids each."""
    left, right = tokens(libraries, text)
    spans = []
    for row in (left, right):
        at, some = 0, []
        for i, x in row:
            some.append((i, at, at + len(x)))
            at += len(x)
        spans.append(some)
    links, j = [], 0
    for x, (i, start, end) in enumerate(spans[0]):
        while j and spans[1][j - 1][2] > start:
            j -= 1
        while j < len(spans[1]) and spans[1][j][1] < end:
            if spans[1][j][2] > start:
                links.append((x, j, i, spans[1][j][0], min(end, spans[1][j][2]) - max(start, spans[1][j][1])))
            j += 1
    cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
    groups, start = [], 0
    for cut in cuts:
        groups.append([[i for i, s, e in some if start <= s and e <= cut] for some in spans] if len(cuts) < 400 else None)
        start = cut
    if groups and groups[0] is None:  # many groups: walk along instead of scanning
        groups, at = [], [0, 0]
        for cut in cuts:
            pair = []
            for k, some in enumerate(spans):
                ids = []
                while at[k] < len(some) and some[at[k]][2] <= cut:
                    ids.append(some[at[k]][0])
                    at[k] += 1
                pair.append(ids)
            groups.append(pair)
    return len(left), len(right), links, groups


def expected(libraries, rows):
    parts = [(n, *aligned(libraries, text)) for n, text in rows]
    total = Counter((i, j) for _, _, _, links, _ in parts for _, _, i, j, _ in links)
    highest = {}
    for (_, j), n in total.items():
        highest[j] = max(n, highest.get(j, 0))
    out = []
    for name, n_a, n_b, links, groups in parts:
        text = ";".join("|".join(",".join(map(str, ids)) for ids in pair) for pair in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        counts = [total[i, j] for _, _, i, j, _ in links]
        best = sum(total[i, j] == highest[j] for _, _, i, j, _ in links)
        out.append((name, n_a, n_b, len(groups), len(links), best, sum(counts), digest, sum(len(a) * len(b) for a, b in groups)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_links", [100, 4_000_000])
def test_tables(spark, libraries, block_links):
    rows = [*enumerate(odd_texts()), (None, "the cat sat"), (3, "the cat")]
    docs = spark.createDataFrame([(n, t, "clash", 1, None) for n, t in rows], SCHEMA).repartition(3)
    found = token_alignment.alignment(docs, block_links=block_links)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"]
    assert sorted(map(tuple, found.collect()), key=repr) == expected(libraries, rows)
    assert token_alignment.alignment(spark.createDataFrame([], SCHEMA)).count() == 0


def test_links(spark, libraries):
    rows = [*enumerate(odd_texts()[:18])]
    found = token_alignment.token_links(spark.createDataFrame([(n, t, "clash", 1, None) for n, t in rows], SCHEMA))
    links = sorted((n, *link) for n, text in rows for link in aligned(libraries, text)[2])
    assert sorted(tuple(r)[:6] for r in found.collect()) == links


def test_small_folder(spark, libraries):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, token_alignment.alignment(docs).collect()), key=repr) == expected(libraries, rows)


@pytest.mark.parametrize("seed", range(5))
def test_products_are_those_of_dense_matrices(seed):
    rng = np.random.default_rng(seed)
    dense = [(rng.random(shape) < 0.3).astype(int) for shape in ((7, 9), (9, 5))]
    rows = [Rows(np.concatenate([[0], np.cumsum(d.sum(axis=1))]), np.nonzero(d)[1], d.shape[1]) for d in dense]
    found, value = rows[0].product(rows[1])
    out = np.zeros((7, 5), dtype=int)
    out[found.owners(), found.columns] = value
    assert (out == dense[0] @ dense[1]).all() and (rows[0].product_sizes(rows[1]) == (dense[0] @ dense[1]).sum(axis=1)).all()
    turned = rows[0].transposed()
    back = np.zeros((9, 7), dtype=int)
    back[turned.owners(), turned.columns] = 1
    assert (back == dense[0].T).all()


def test_chunks_change_nothing():
    rng = np.random.default_rng(1)
    ends_a, ends_b = (np.append(np.flatnonzero(rng.random(5000) < p) + 1, 5001) for p in (0.3, 0.2))
    whole = [np.concatenate(c) for c in zip(*token_alignment.overlaps(ends_a, ends_b), strict=True)]
    for chunk in (1, 17, 400):
        parts = [np.concatenate(c) for c in zip(*token_alignment.overlaps(ends_a, ends_b, chunk), strict=True)]
        assert all((x == y).all() for x, y in zip(whole, parts, strict=True))
