"""Vectorised words of a UTF-8 text: numpy helpers that run inside tasks."""

from __future__ import annotations

import numpy as np

#: Byte values that separate words: the blank and 0x09 to 0x0D, as in ``bytes.split()``.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the SplitMix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit integers."""
    return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * _STEP)


#: Per seed: a number for each byte, and the multiplier of one place with its inverse modulo 2^64.
_BYTES = {seed: stream(seed, 256) for seed in (1, 2)}
_BASE = {seed: int(stream(seed + 8, 1)[0]) | 1 for seed in (1, 2)}
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _powers(seed: int, n: int, inverse: bool) -> np.ndarray:
    """The first ``n`` powers of a seed's multiplier, or of its inverse, modulo 2^64."""
    known = _POWERS.get((seed, inverse))
    if known is None or len(known) < n:
        base = pow(_BASE[seed], -1 if inverse else 1, 1 << 64)
        steps = np.full(max(n, 1 << 20), base, dtype=np.uint64)
        steps[0] = 1
        known = _POWERS[seed, inverse] = np.cumprod(steps)
    return known[:n]


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes as an array, and the start and end of each word."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.empty(len(raw) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(SPACE[raw], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return raw, edges[::2], edges[1::2]


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over random numbers for its bytes, then mixed.

    Differences of one running sum give all words; the inverse power takes out where a word begins.
    """
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    n = len(raw)
    total = np.empty(n + 1, dtype=np.uint64)
    total[0] = 0
    terms = _BYTES[seed][raw]
    terms *= _powers(seed, n, False)
    np.cumsum(terms, out=total[1:])
    out = (total[ends] - total[starts]) * _powers(seed, n, True)[starts]
    return mix64(out + (ends - starts).astype(np.uint64) * _STEP)
