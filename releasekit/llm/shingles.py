"""Hashing of words and word shingles, for tasks that work on Arrow batches."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS = np.ones(1, np.uint64)
_STEPS = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        _POWERS = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, _BASE, np.uint64), dtype=np.uint64)])
    return _POWERS


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word: runs of bytes other than space, tab, line feed, vertical tab,
    form feed and return, A-Z lower-cased.  Those are the word limits in code points too, as
    UTF-8 uses bytes below 0x80 for nothing else."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    inside = ~_SPACE[raw]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    raw = raw[inside]
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(raw)) - np.repeat(first, lengths)
    return mix(np.add.reduceat(_BYTES[raw] * _powers(int(lengths.max()))[place], first) + lengths.astype(np.uint64))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words, in order; with fewer words, one hash of the
    whole sequence; without words, none."""
    n = len(words)
    if not n:
        return words
    width = min(size, n)
    h = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        h = h * _STEPS[k % len(_STEPS)] + words[k:n - width + 1 + k]
        if k >= len(_STEPS):
            h = mix(h)
    return mix(h)
