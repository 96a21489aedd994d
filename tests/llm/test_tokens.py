"""Token counts, encoding and decoding against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

from chartlift.llm import bpe_codec, token_counts  # noqa: E402
from chartlift.llm.merges import load, vocabulary_path  # noqa: E402

SCHEMA = "doc_id long, text string, n_tokens string, known int"


def odd_texts():
    random.seed(3)
    texts = ["", " ", "  a", "a ", "a  b\n\n c", "x<|endoftext|> y<|startoftext|>", "<|endoftext|>" * 3, "aaa" * 400, "İΣΑΣ ςΣ's'S don't", "\x00\x1c \x85a\xa0b", "é ́x 가"]
    texts += ["".join(random.choice(alphabet) for _ in range(2500)) for alphabet in ("abcdefghij ", "etaoinshrdlu", "aab", "é̂a")]
    texts += [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}S's" for c in [*range(1, 0x600), 0x88F, 0xC5C, 0x1C89, 0x2003, 0x2028, 0x3000, 0xA7CE, 0x10D50, 0x323B0]]
    return texts


def test_counts_and_ids_are_the_librarys():
    counter, codec = token_counts.Counter(vocabulary_path("byte_bpe_50k.json")), bpe_codec.Codec(vocabulary_path("word_bpe_49k.json"))
    counts = tokenizers.Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    words = tokenizers.Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    texts = odd_texts()
    assert counter.count(texts) == [len(counts.encode(t, add_special_tokens=False).ids) for t in texts]
    assert counter.count(texts[:9]) == counter.count(texts)[:9]  # from remembered words
    for text, (packed, decoded) in zip(texts, codec.run(texts), strict=True):
        ids = words.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, dtype="<u4").tolist() == ids
        assert decoded == words.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("leaf", [2, 5, 48])
def test_trees_agree_with_one_pass(leaf):
    random.seed(leaf)
    merges = load(vocabulary_path("word_bpe_49k.json"))
    tree = bpe_codec.TreeEncoder(merges, leaf)
    for alphabet in ("ab", "etaoinshr", "thequickbrownfox", "é-ab"):
        for size in (1, 2, 7, 100, 1500):
            flat, lengths = merges.symbols(["".join(random.choice(alphabet) for _ in range(size)).encode()])
            assert tree.encode([flat.copy()])[0] == merges.encode_symbols(flat.copy(), lengths)[0]


def test_tables(spark):
    rows = [(1, None, "x", 0), (2, "", "x", 0), (3, "the cat", "x", 0), (3, "the cat", "x", 0), (None, "a" * 3000, "x", 0), (5, "one " * 600, "x", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = sorted((tuple(r) for r in token_counts.token_counts(docs).collect()), key=repr)
    library = tokenizers.Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    sizes = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t, _, _ in rows]
    assert found == sorted([(i, len((t or "").encode()), n, n > 512) for (i, t, _, _), n in zip(rows, sizes, strict=True)], key=repr)
    words = tokenizers.Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    expected = []
    for i, text, _, _ in rows:
        ids = words.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        expected.append((i, len(ids), digest, hashlib.sha256(words.decode(ids, skip_special_tokens=False).encode()).hexdigest(), ids))
    assert sorted((tuple(r) for r in bpe_codec.encode_decode(docs, with_ids=True).collect()), key=repr) == sorted(expected, key=repr)
    for operator in (token_counts.token_counts, bpe_codec.encode_decode):
        assert operator(spark.createDataFrame([], SCHEMA)).count() == 0
