"""Hashed word shingles of many texts at once."""

from __future__ import annotations

import numpy as np

GROUP_CHARS = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.concatenate([np.ones(1, dtype=np.uint64), np.cumprod(np.full(n, _BASE, dtype=np.uint64))])
    return _powers[:n]


def _word_hashes(lines: list[bytes]) -> np.ndarray:
    """The hash of each word of all lines; lines are words between single spaces and not empty."""
    raw = np.frombuffer(b" ".join(lines), dtype=np.uint8)
    ends = np.append(np.flatnonzero(raw == 32), len(raw))
    starts = np.concatenate([[0], ends[:-1] + 1])
    lengths = ends - starts
    # Each word's bytes are weighted by powers that start anew in the word.
    inside = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    weighted = (raw.astype(np.uint64) + np.uint64(1)) * _powers_to(int(lengths.max()) + 1)[inside]
    weighted[ends[:-1]] = 0  # the spaces
    return mix(np.add.reduceat(weighted, starts) + lengths.astype(np.uint64) * _STEP)


def _hash_group(texts: list[str], size: int) -> list[np.ndarray]:
    lines = [b" ".join(t.encode().lower().split()) for t in texts]  # bytes: A-Z and the six ASCII blanks only
    full = [i for i, line in enumerate(lines) if line]
    out = [np.zeros(0, dtype=np.uint64)] * len(texts)
    if not full:
        return out
    words = _word_hashes([lines[i] for i in full])
    rolled = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    for k in range(size):
        rolled = rolled * _STEP + words[k : k + len(rolled)]
    rolled = mix(rolled)
    start = 0
    for i in full:
        count = lines[i].count(b" ") + 1
        if count >= size:
            out[i] = np.unique(rolled[start : start + count - size + 1])
        else:
            value = np.uint64(count)
            with np.errstate(over="ignore"):
                for word in words[start : start + count]:
                    value = value * _STEP + word
            out[i] = mix(np.array([value], dtype=np.uint64))
        start += count
    return out


def shingle_sets(texts: list[str], size: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: runs of ``size`` words, or all words of a shorter text."""
    out: list[np.ndarray] = []
    group, chars = [], 0
    for text in texts:
        if group and chars + len(text) > GROUP_CHARS:
            out += _hash_group(group, size)
            group, chars = [], 0
        group.append(text)
        chars += len(text)
    return out + _hash_group(group, size) if group else out
