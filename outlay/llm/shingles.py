"""Hashed word shingles of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. modulo 2^64, at least ``n`` of them, kept for the next texts."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(1 << 20, 2 * n), base, np.uint64)
        factors[0] = 1
        known = _POWERS[base] = np.cumprod(factors)
    return known


def word_hashes(texts: list[str]) -> tuple[np.ndarray, ...]:
    """For all words of all texts: hash, text, first byte and byte after the last, in the text, and
    number of the line, counted through all texts.

    Words are runs of anything but ASCII white space, with A-Z in lower case. The running sum of
    bytes times powers makes a word's hash a difference of two sums, whatever its length.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]).lower(), np.uint8)
    space = _SPACE[data]
    inside = np.concatenate(([True], space)), np.concatenate((space, [True]))
    starts = np.flatnonzero(inside[0][:-1] & ~space)
    ends = np.flatnonzero(~space & inside[1][1:]) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _powers(_BASE, len(data))[: len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts]
    firsts = np.cumsum([0] + [len(r) + 1 for r in raw])
    owner = np.searchsorted(firsts, starts, side="right") - 1
    lines = np.searchsorted(np.flatnonzero(data == 0x0A), starts)
    return mix(value), owner, starts - firsts[owner], ends - firsts[owner], lines


def rolled(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` words in a row (``len(words) - k + 1`` of them)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = h * np.uint64(_BASE) + words[i : i + n]
    return mix(h)


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """Of every text, the sorted distinct hashes of its ``k``-word shingles.

    A text with fewer words has its whole sequence as its one shingle, one without words none.
    """
    words, owner, *_ = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    firsts = np.cumsum(counts) - counts
    hashes = rolled(words, k)
    out = []
    for first, n in zip(firsts.tolist(), counts.tolist(), strict=True):
        if n >= k:
            out.append(np.unique(hashes[first : first + n - k + 1]))
        elif n:
            whole = rolled(words[first : first + n], n)
            out.append(mix(whole + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
