"""Words and hashes of many texts at once, over one array of bytes."""

from __future__ import annotations

import numpy as np

#: Odd multiplier of the polynomial hash modulo 2**64, and its inverse.
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True

_powers = {BASE: np.ones(1, dtype=np.uint64), INVERSE: np.ones(1, dtype=np.uint64)}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown by doubling."""
    known = _powers[base]
    while len(known) < n:
        known = np.concatenate([known, known * (known[-1:] * base)])
    _powers[base] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PrefixHashes:
    """Polynomial prefix hashes: the hash of any byte range in constant time."""

    def __init__(self, data: np.ndarray):
        self.prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=self.prefix[1:])
        self.back = powers(INVERSE, len(data) + 1)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hashes of data[start:stop], equal for equal strings wherever they stand."""
        return (self.prefix[stop] - self.prefix[start]) * self.back[start]


def lowered(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, with A-Z lower-cased unless told not to, and one blank after each; end of each text)."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b" ".join([*raw, b""]), dtype=np.uint8)
    data = _LOWER[data] if lower else data
    return data, np.cumsum([len(r) + 1 for r in raw])


def words(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, stop, text index) of every maximal run without blanks (0x20, 0x09-0x0D)."""
    data, ends = lowered(texts, lower)
    inside = np.concatenate(([False], ~_BLANK[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, stop = edges[::2], edges[1::2]
    return data, start, stop, np.searchsorted(ends, start, side="right")


def word_hashes(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every word, in order."""
    data, start, stop, text = words(texts, lower)
    return mix(PrefixHashes(data).of(start, stop)), text


def shingle_sets(texts: list[str], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted by text and hash: (hash, bounds of each text).

    A text of fewer words than ``width`` has one shingle, its whole sequence; a text
    without words has none.
    """
    word, text = word_hashes(texts)
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    count = np.diff(first)
    whole = np.flatnonzero((count > 0) & (count < width))
    n = max(0, len(word) - width + 1)
    value = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        value += mix(word[k : k + n] + np.uint64(k + 1))
    same = text[:n] == text[width - 1 :] if n else np.zeros(0, dtype=bool)
    value, owner = mix(value[same]), text[:n][same]
    if len(whole):
        short = np.array([_sequence(word[first[t] : first[t + 1]]) for t in whole], dtype=np.uint64)
        value, owner = np.concatenate([value, short]), np.concatenate([owner, whole])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[fresh], owner[fresh]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def _sequence(word: np.ndarray) -> np.uint64:
    total = np.array([len(word)], dtype=np.uint64)
    for k in range(len(word)):
        total = mix(total + word[k : k + 1] + np.uint64(k))
    return total[0]
