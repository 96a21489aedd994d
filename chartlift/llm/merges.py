"""Byte-pair merges on ragged arrays, for vocabularies in the tokenizers library's JSON form."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import regex

NONE = np.int32(2**31 - 1)

# Letters and numbers that Unicode gained after version 16, the one the vocabularies' library knows.
NEW_LETTERS = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 "
    "10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF "
    "18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 "
    "1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 "
    "3D000-3FC3F"
)


def narrow(text: str) -> bool:
    """Whether all characters are below U+0100."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Cutter:
    """A vocabulary's pattern; letters that its library does not know yet count as symbols."""

    def __init__(self, pattern: str):
        new = "".join("-".join(f"\\U{int(c, 16):08x}" for c in r.split("-")) for r in NEW_LETTERS.split())
        careful = pattern.replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}").replace(r"[^\s\p{L}\p{N}]", "OTHER")
        careful = careful.replace(r"\p{L}", rf"[\p{{L}}--[{new}]]").replace(r"\p{N}", rf"[\p{{N}}--[{new}]]")
        self.plain = regex.compile(pattern)
        self.careful = regex.compile(careful.replace("OTHER", rf"[[^\s\p{{L}}\p{{N}}]||[{new}]]"), regex.V1)
        self.new = regex.compile(f"[{new}]")

    def findall(self, text: str) -> list[str]:
        if not narrow(text) and self.new.search(text):
            return self.careful.findall(text)
        return self.plain.findall(text)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: printable bytes themselves, the rest from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    table = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


class Merges:
    """The merge table of one vocabulary.

    Every merge makes a token of its own and comes after the merges of its two halves. Hence merging all
    places of a sequence's lowest pair at once gives what merging them one at a time from the left gives.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocabulary = data["model"]["vocab"]
        suffix = data["model"].get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in data["model"]["merges"]]
        self.size = len(vocabulary)
        self.names: dict[int, str] = {i: name for name, i in vocabulary.items()}
        self.added = {token["content"]: token["id"] for token in data["added_tokens"]}
        self.names |= {i: name for name, i in self.added.items()}
        characters = byte_characters()
        self.byte_ids = np.array([vocabulary[c] for c in characters], dtype=np.int32)
        self.last_byte_ids = np.array([vocabulary[c + suffix] for c in characters], dtype=np.int32)
        left = np.array([vocabulary[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int32)
        if len(set(made.tolist())) != len(made):
            raise ValueError("a token is made by two merges; simultaneous merging would not be exact")
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made
        self.halves = {int(m): (int(a), int(b)) for m, a, b in zip(made, left, right, strict=True)}

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)

    def symbols(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All pieces' first symbols in one array, and each piece's length. Pieces are not empty."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        flat = self.byte_ids[raw]
        last = np.cumsum(lengths) - 1
        flat[last] = self.last_byte_ids[raw[last]]
        return flat, lengths

    def rounds(self, flat: np.ndarray, lengths: np.ndarray):
        """Merge until nothing is left; yields (sequence numbers, their symbols, their lengths) as sequences finish.

        In each round every unfinished sequence merges all places of its lowest pair; in a run of overlapping
        places (a a a) every second one counts, from the left.
        """
        which = np.arange(len(lengths))
        ids = flat
        rank = np.full(len(ids), NONE, dtype=np.int32)
        if len(ids) > 1:
            rank[:-1] = self.rank_of(ids[:-1], ids[1:])
        rank[np.cumsum(lengths) - 1] = NONE
        while len(which):
            starts = np.cumsum(lengths) - lengths
            low = np.minimum.reduceat(rank, starts)
            open_ = low != NONE
            if not open_.all():
                done = np.repeat(~open_, lengths)
                yield which[~open_], ids[done], lengths[~open_]
                ids, rank = ids[~done], rank[~done]
                which, lengths, low = which[open_], lengths[open_], low[open_]
                if not len(which):
                    return
            at = np.flatnonzero(rank == np.repeat(low, lengths))
            fresh = np.ones(len(at), dtype=bool)
            fresh[1:] = np.diff(at) != 1
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            ids[at] = self.made[rank[at]]
            ends = np.cumsum(lengths)
            gone = np.zeros(len(ids), dtype=bool)
            gone[at + 1] = True
            lengths = lengths - np.bincount(np.searchsorted(ends, at, side="right"), minlength=len(lengths))
            place = at - np.arange(len(at))  # of the merged symbols once the gaps are closed
            ids, rank = ids[~gone], rank[~gone]
            last = np.zeros(len(ids), dtype=bool)
            last[np.cumsum(lengths) - 1] = True
            touched = np.zeros(len(ids), dtype=bool)
            touched[place] = True
            touched[place[place > 0] - 1] = True
            changed = np.flatnonzero(touched)
            inner = changed[~last[changed]]
            rank[changed] = NONE
            rank[inner] = self.rank_of(ids[inner], ids[inner + 1])

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """How many symbols of each piece survive."""
        out = np.zeros(len(pieces), dtype=np.int64)
        if pieces:
            for which, _, lengths in self.rounds(*self.symbols(pieces)):
                out[which] = lengths
        return out

    def encode_symbols(self, flat: np.ndarray, lengths: np.ndarray) -> list[list[int]]:
        """The surviving symbols of each sequence."""
        out: list[list[int]] = [[]] * len(lengths)
        if len(lengths):
            for which, ids, sizes in self.rounds(flat, lengths):
                values, end = ids.tolist(), 0
                for number, size in zip(which.tolist(), sizes.tolist(), strict=True):
                    out[number] = values[end : end + size]
                    end += size
        return out


@lru_cache(maxsize=4)
def load(path: str) -> Merges:
    """One table per Python worker and file."""
    return Merges(path)


def vocabulary_path(name: str, folder: str | None = None) -> str:
    """Where a public vocabulary file is: in ``folder``, else where the public_tokenizers package keeps it."""
    if folder:
        return f"{folder.rstrip('/')}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)
