"""BPE encoding and decoding by tree concatenation (operator 2).

A pre-token longer than a leaf is halved until its parts are leaves; the leaves of all pre-tokens of a batch are
encoded in parallel, as one ragged array. Two encoded neighbours are joined by encoding a window around the seam
anew: the window grows until it fits both sides, that is until the token before it and its first token, and its last
token and the one after it, are each what the merges give for those two tokens. A sequence all of whose neighbours
fit is the encoding, so the result is exact. Decoding gives the tokens' strings joined by spaces, which is what a
vocabulary without a decoder of its own stands for.

Null and empty texts have no tokens; repeated rows are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import unicodedata

import numpy as np
import regex
from pyspark.sql import DataFrame

from chartlift.llm.common import map_texts, texts_of
from chartlift.llm.merges import Cutter, Merges, load, narrow, vocabulary_path

VOCABULARY = "word_bpe_49k.json"
# The pattern of the vocabulary, a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
# Small forms of capitals that Unicode 16 and 17 added.
NEW_CASES = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
NEW_CASES |= {0x10D50 + i: 0x10D70 + i for i in range(22)} | {0x16EA0 + i: 0x16EBB + i for i in range(25)}
LEAF = 48
KNOWN_WORDS = 250_000  # remembered words; once there are more, the table starts anew
KNOWN_PAIRS = 100_000


class TreeEncoder:
    """Encodes sequences of base symbols of any length."""

    def __init__(self, merges: Merges, leaf: int = LEAF):
        self.merges, self.leaf = merges, leaf
        self.pairs: dict[tuple[int, int], bool] = {}
        self.parts: dict[int, list[int]] = {}

    def base(self, token: int) -> list[int]:
        """The base symbols of a token."""
        found = self.parts.get(token)
        if found is None:
            halves = self.merges.halves.get(token)
            found = [token] if halves is None else self.base(halves[0]) + self.base(halves[1])
            self.parts[token] = found
        return found

    def direct(self, symbols: list[int]) -> list[int]:
        return self.merges.encode_symbols(np.array(symbols, dtype=np.int32), np.array([len(symbols)]))[0]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens, encoded together, stay as they are."""
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= KNOWN_PAIRS:
                self.pairs.clear()
            found = self.pairs[left, right] = self.direct(self.base(left) + self.base(right)) == [left, right]
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        if self.fits(left[-1], right[0]):
            return left + right
        width = 1
        while True:
            before, window, after = left[:-width], [*left[-width:], *right[:width]], right[width:]
            tokens = self.direct([s for t in window for s in self.base(t)])
            if (not before or self.fits(before[-1], tokens[0])) and (not after or self.fits(tokens[-1], after[0])):
                return [*before, *tokens, *after]
            width *= 2

    def encode(self, sequences: list[np.ndarray]) -> list[list[int]]:
        """All leaves at once, then the joins of each level of the trees."""
        cuts = []
        for sequence in sequences:
            bounds = [0, len(sequence)]
            while max(b - a for a, b in zip(bounds, bounds[1:], strict=False)) > self.leaf:
                halves = [(a + b) // 2 for a, b in zip(bounds, bounds[1:], strict=False) if b - a > self.leaf]
                bounds = sorted([*bounds, *halves])
            cuts.append(bounds)
        leaves = [s[a:b] for s, bounds in zip(sequences, cuts, strict=True) for a, b in zip(bounds, bounds[1:], strict=False)]
        if not leaves:
            return []
        encoded = iter(self.merges.encode_symbols(np.concatenate(leaves), np.array([len(x) for x in leaves])))
        out = []
        for bounds in cuts:
            level = [next(encoded) for _ in bounds[1:]]
            while len(level) > 1:
                pairs = [self.join(a, b) for a, b in zip(level[::2], level[1::2], strict=False)]
                level = pairs + level[len(pairs) * 2 :]
            out.append(level[0])
        return out


class Codec:
    """Texts to ids and back.

    No pre-token reaches across a space, so the words between spaces are encoded apart and remembered.
    """

    def __init__(self, path: str, leaf: int = LEAF, known_words: int = KNOWN_WORDS):
        self.merges = load(path)
        self.tree = TreeEncoder(self.merges, leaf)
        self.cut = Cutter(PATTERN + "| ")
        self.added = regex.compile("(" + "|".join(map(regex.escape, self.merges.added)) + ")")
        self.limit = known_words
        self.packed = {i: i.to_bytes(4, "little") for i in self.merges.names}
        self.known: dict[str, tuple[bytes, str]] = {}

    @staticmethod
    def normal(text: str) -> str:
        """Composed and lower-cased character by character (a final sigma is a sigma)."""
        text = unicodedata.normalize("NFC", text)
        if narrow(text):
            return text.lower()
        text = text.translate(NEW_CASES)
        return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.merges.names.__getitem__, ids))

    def pair(self, ids: list[int]) -> tuple[bytes, str]:
        return b"".join(map(self.packed.__getitem__, ids)), self.decode(ids)

    def tokens(self, pretokens: list[str]) -> list[list[int]]:
        """Ids of each pre-token: short ones are leaves as they are, long ones go through the tree."""
        raw = [t.encode() for t in pretokens]
        short = [n for n, t in enumerate(raw) if len(t) <= self.tree.leaf]
        long = [n for n, t in enumerate(raw) if len(t) > self.tree.leaf]
        out: list[list[int]] = [[]] * len(raw)
        if short:
            for n, ids in zip(short, self.merges.encode_symbols(*self.merges.symbols([raw[n] for n in short])), strict=True):
                out[n] = ids
        for n, ids in zip(long, self.tree.encode([self.merges.symbols([raw[n]])[0] for n in long]), strict=True):
            out[n] = ids
        return out

    def learn(self, words: list[str]) -> None:
        """Remember the ids and the decoded text of words, which hold no space."""
        found = self.cut.findall(self.normal(" ".join(words)))
        unique = list(dict.fromkeys(found))
        pairs = dict(zip(unique, map(self.pair, self.tokens(unique)), strict=True))
        own: list[tuple[bytes, str]] = []
        number = 0
        for token in [*found, " "]:
            if token != " ":
                own.append(pairs[token])
                continue
            if len(own) == 1:
                self.known[words[number]] = own[0]
            else:
                self.known[words[number]] = (b"".join([a for a, _ in own]), " ".join([b for _, b in own]))
            own = []
            number += 1

    def run(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Ids (little-endian unsigned 32-bit integers) and decoded text of each text."""
        split = []
        for text in texts:
            if "<|" in text:
                parts = self.added.split(text)
                split.append([w for part in parts for w in ([part] if part in self.merges.added else part.split(" "))])
            else:
                split.append(text.split(" "))
        known = self.known
        if len(known) > self.limit:
            known.clear()
        missing = [w for w in set().union(*split).difference(known) if w not in self.merges.added]
        if missing:
            self.learn(missing)
        known.update((name, self.pair([i])) for name, i in self.merges.added.items())
        out = []
        for words in split:
            got = list(map(known.__getitem__, words))
            out.append((b"".join([g[0] for g in got]), " ".join([g[1] for g in got if g[0]])))
        return out


def encode_decode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, with_ids: bool = False, with_text: bool = False
) -> DataFrame:
    """doc_id, n_tokens and the sha256 digests of ids and decoded text, in one pass without a shuffle.

    ``with_ids`` and ``with_text`` add the ids as an array and the decoded text.
    """
    path = path or vocabulary_path(VOCABULARY)

    def make():
        codec = Codec(path)

        def handle(ids, texts):
            pairs = codec.run(texts)
            columns = {
                "doc_id": ids, "n_tokens": [len(a) // 4 for a, _ in pairs], "ids_sha256": [hashlib.sha256(a).hexdigest() for a, _ in pairs],
                "decoded_sha256": [hashlib.sha256(b.encode()).hexdigest() for _, b in pairs],
            }
            if with_ids:
                columns["ids"] = [np.frombuffer(a, dtype="<i4") for a, _ in pairs]
            if with_text:
                columns["decoded"] = [b for _, b in pairs]
            return columns

        return handle

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += (", ids array<int>" if with_ids else "") + (", decoded string" if with_text else "")
    return map_texts(texts_of(docs, id_col, text_col), make, schema)
