"""Words of a text and their 64-bit hashes, in numpy, for one text at a time.

A word is a run of bytes other than space and the control characters 9 to 13 (UTF-8 never uses these bytes inside a
character). Hashes depend only on the bytes, so every task of every run agrees on them.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
SEPARATORS = (9, 10, 11, 12, 13, 32)
IS_SEPARATOR = np.isin(np.arange(256), SEPARATORS)
STARTS_CHARACTER = (np.arange(256) & 0xC0) != 0x80
PIECE = 1 << 18  # bytes hashed at a time

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS = np.cumprod(np.full(2 * PIECE, _BASE, U64)) * U64(pow(_BASE, -1, 1 << 64))
_INVERSES = np.cumprod(np.full(2 * PIECE, pow(_BASE, -1, 1 << 64), U64)) * U64(_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finisher of splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word."""
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = IS_SEPARATOR[data]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    return edges[0::2], edges[1::2]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= len(_POWERS):
        return _POWERS[:n], _INVERSES[:n]
    inverse = pow(_BASE, -1, 1 << 64)
    return (np.cumprod(np.full(n, _BASE, U64)) * U64(inverse), np.cumprod(np.full(n, inverse, U64)) * U64(_BASE))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    powers, inverses = _powers(len(data))
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_VALUE[data] * powers, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(U64))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each word: a polynomial of its bytes, taken from prefix sums. Long texts go piece by piece, so
    memory besides the words' own arrays does not grow with the text."""
    if not len(starts):
        return np.empty(0, U64)
    cuts = np.searchsorted(starts, np.arange(0, len(data), PIECE))
    parts = []
    for a, b in zip(cuts, [*cuts[1:], len(starts)]):
        if a < b:
            at = starts[a]
            parts.append(_hashes(data[at:ends[b - 1]], starts[a:b] - at, ends[a:b] - at))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def word_hashes(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    return hashes(data, *spans(data))


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words; none if there are fewer."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, U64)
    rolled = words[:m].copy()
    for k in range(1, n):
        rolled *= U64(_BASE)
        rolled += words[k:k + m]
    return mix(rolled)


def repeated(values: np.ndarray) -> np.ndarray:
    """Marks values that occur twice or more."""
    ordered = np.sort(values)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    return np.isin(values, twice) if len(twice) else np.zeros(len(values), bool)


def covered(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Marks the positions below ``size`` that lie in a run of ``length`` from one of the marked starts."""
    steps = np.zeros(size + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(steps, at, 1)
    np.add.at(steps, np.minimum(at + length, size), -1)
    return np.cumsum(steps[:-1]) > 0
