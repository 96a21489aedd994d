"""Token counts by rank-synchronous merging of ragged arrays (operator 1).

Each text is cut into pre-tokens by the vocabulary's pattern. All pre-tokens of a batch that are not known yet lie
in one ragged array; in every round each of them merges all places of its lowest-ranked pair, and the symbols that
survive are counted. A bounded table keeps the counts of words met before.

Null and empty texts have no tokens; repeated rows are counted each; an empty table gives an empty result. A very
long text without spaces is one sequence of the array like any other.
"""

from __future__ import annotations

import numpy as np
import regex
from pyspark.sql import DataFrame

from chartlift.llm.common import map_texts, texts_of
from chartlift.llm.merges import Cutter, load, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
# The pattern of the vocabulary, a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# A space before one of these does not start a pre-token.
ODD_ASCII = [" " + c for c in " \t\n\v\f\r"]
ODD_OTHER = [" " + c for c in "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"]
KNOWN_WORDS = 400_000  # remembered words; once there are more, the table starts anew


class Counter:
    """Counts tokens of texts.

    A single space before a visible character always starts a pre-token, so a text may be cut there and the parts
    counted apart; where a space is followed by white space or by nothing, the parts around it stay together.
    """

    def __init__(self, path: str, known_words: int = KNOWN_WORDS):
        self.merges = load(path)
        self.cut = Cutter(PATTERN)
        self.join = regex.compile(r"(?<!\A) (?=[^\s])")
        self.added = regex.compile("|".join(map(regex.escape, self.merges.added)))
        self.limit = known_words
        self.known: dict[str, int] = {}

    def words(self, text: str) -> list[str]:
        """Parts that hold whole pre-tokens; all but the first have lost their leading space."""
        odd = text[-1] == " " or any(pair in text for pair in ODD_ASCII)
        if odd or not text.isascii() and any(pair in text for pair in ODD_OTHER):
            return self.join.split(text)
        return text.split(" ")

    def count(self, texts: list[str]) -> list[int]:
        parts: list[list[str]] = []
        heads: list[list[str]] = []
        extra = []
        for text in texts:
            segments = self.added.split(text) if "<|" in text else [text]
            extra.append(len(segments) - 1)
            first, rest = [], []
            for segment in filter(None, segments):
                words = self.words(segment)
                first.append(words[0])
                rest.extend(words[1:])
            heads.append(first)
            parts.append(rest)
        known = self.known
        if len(known) > self.limit:
            known.clear()
        missing = list(set().union(*parts).difference(known))
        # Words with white space inside are counted apart from the others, which are cut in one go.
        plain = [w for w in missing if " " not in w]
        known.update(zip(plain, self.spaced(plain), strict=True))
        odd = [w for w in missing if " " in w]
        known.update(zip(odd, self.single([" " + w for w in odd]), strict=True))
        firsts = list(set().union(*heads))
        first_size = dict(zip(firsts, self.single(firsts), strict=True))
        return [
            n + sum(map(first_size.__getitem__, first)) + sum(map(known.__getitem__, rest))
            for n, first, rest in zip(extra, heads, parts, strict=True)
        ]

    def spaced(self, words: list[str]) -> list[int]:
        """Tokens of each word with the space before it; no word begins with white space or holds a space."""
        tokens = self.cut.findall(" " + " ".join(words)) if words else []
        owner = np.cumsum(np.fromiter((t[0] == " " for t in tokens), dtype=np.int64, count=len(tokens))) - 1
        return self.sizes(tokens, owner, len(words))

    def single(self, words: list[str]) -> list[int]:
        tokens, owner = [], []
        for number, word in enumerate(words):
            own = self.cut.findall(word)
            tokens += own
            owner += [number] * len(own)
        return self.sizes(tokens, np.array(owner, dtype=np.int64), len(words))

    def sizes(self, tokens: list[str], owner: np.ndarray, words: int) -> list[int]:
        unique = list(dict.fromkeys(tokens))
        counts = dict(zip(unique, self.merges.counts([t.encode() for t in unique]).tolist(), strict=True))
        weights = np.fromiter(map(counts.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        return np.bincount(owner, weights=weights, minlength=words).astype(np.int64).tolist()


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every text, in one pass without a shuffle."""
    path = path or vocabulary_path(VOCABULARY)

    def make():
        counter = Counter(path)

        def handle(ids, texts):
            sizes = counter.count(texts)
            return {
                "doc_id": ids, "n_bytes": [len(t) if t.isascii() else len(t.encode()) for t in texts], "n_tokens": sizes, "over_limit": [n > limit for n in sizes],
            }

        return handle

    return map_texts(texts_of(docs, id_col, text_col), make, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
