"""Words of many texts at once and their 64-bit hashes, as numpy work over Arrow's bytes.

A word's hash is a polynomial in its bytes, taken from prefix sums: with
``P[i] = sum of byte[j] * B**j for j < i`` the word ``[s, e)`` has
``(P[e] - P[s]) * B**-s`` (mod 2**64, ``B`` odd).  The result is then mixed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
_MIX1, _MIX2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
_powers: dict[str, np.ndarray] = {}

#: Class of a byte: 0 separates, other classes make words of their own kind.
SPACE_ONLY = np.ones(256, np.uint8)
SPACE_ONLY[[0x20, *range(0x09, 0x0E)]] = 0
#: As above, but runs of ASCII punctuation are words of their own.
PUNCT_APART = SPACE_ONLY.copy()
PUNCT_APART[[c for c in range(33, 127) if not chr(c).isalnum()]] = 2
#: Letters, digits and non-ASCII bytes make words; all else separates.
ALNUM_ONLY = (PUNCT_APART == 1).astype(np.uint8)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)


@dataclass
class Words:
    """Words of a run of texts: byte ranges, hashes, and per text the first word (n + 1 values)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    #: With ``prefixes``: per length the hashes of the words' beginnings and the words that are longer.
    begun: tuple = ()

    def rows(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    h = (h ^ (h >> U(30))) * _MIX1
    h = (h ^ (h >> U(27))) * _MIX2
    return h ^ (h >> U(31))


def _power_table(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 21)
        have = np.full(size, U(base))
        have[0] = U(1)
        have = np.cumprod(have, dtype=np.uint64)
        _powers[name] = have
    return have


def words(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray = SPACE_ONLY, fold: np.ndarray = LOWER,
          prefixes: tuple[int, ...] = ()) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``; ``fold`` maps bytes before hashing.

    ``prefixes``: also the hashes of the first so many bytes of longer words.
    """
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    kind = kinds[data]
    change = np.empty(n + 1, bool)
    change[0] = change[n] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:n])
    change[offsets] = True
    cuts = np.flatnonzero(change)
    keep = kind[cuts[:-1]] != 0
    start, end = cuts[:-1][keep], cuts[1:][keep]
    powers = _power_table("up", BASE, n + 1)
    back = _power_table("down", pow(BASE, -1, 1 << 64), n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((fold[data].astype(np.uint64) + U(1)) * powers[:n], out=sums[1:])
    h = mix((sums[end] - sums[start]) * back[start])
    begun = []
    for k in prefixes:
        at = np.flatnonzero(end - start > k)
        s = start[at]
        begun.append((mix((sums[s + k] - sums[s]) * back[s] + U(k)), at))
    return Words(start, end, h, np.searchsorted(start, offsets), tuple(begun))


def ngrams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n-grams and the index of each one's first word; n-grams stay within a text."""
    m = len(w.hash) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row = w.rows()
    at = np.flatnonzero(row[:m] == row[n - 1:])
    h = np.zeros(len(at), np.uint64)
    for k in range(n):
        h = mix(h * U(0x100000001B3) + w.hash[at + k])
    return h, at
