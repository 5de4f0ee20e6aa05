"""Word shingles of whole texts as 64-bit hashes, for batches of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from . import pieces

_K = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(8_1964).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_PLACES = np.random.default_rng(8_2027).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
# A-Z count as a-z.
_BYTES[65:91] = _BYTES[97:123]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash for each word, in order; long texts are taken in pieces."""
    return np.concatenate([_word_hashes(p) for p in pieces.cut(text)])


def _word_hashes(text: bytes) -> np.ndarray:
    b = np.frombuffer(text, np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    space = _SPACE[b]
    start = ~space
    start[1:] &= space[:-1]
    heads = np.flatnonzero(start)
    if not len(heads):
        return np.zeros(0, np.uint64)
    stop = space.copy()
    stop[:-1] = ~space[:-1] & space[1:]
    stop[-1] = not space[-1]
    ends = np.flatnonzero(stop) + 1
    # A prefix sum of bytes times powers gives each word's polynomial up to a power of the place;
    # multiplying by the inverse power brings all words to the same base.
    powers, inverse = _powers(len(b))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[b] * powers[: len(b)], dtype=np.uint64)])
    return mix((total[ends] - total[heads]) * inverse[heads] + (ends - heads).astype(np.uint64) * _K)


_CACHE: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_CACHE[0]) < n:
        base = 0xD6E8FEB86659FD93
        size = max(n, 1 << 16)
        for i, k in enumerate((base, pow(base, -1, 1 << 64))):
            steps = np.full(size, k, np.uint64)
            steps[0] = 1
            _CACHE[i] = np.cumprod(steps, dtype=np.uint64)
    return _CACHE[0], _CACHE[1]


def shingle_set(text: bytes, width: int = 5) -> np.ndarray:
    """The sorted distinct hashes of a text's runs of `width` words; of fewer words, one for the whole; of none, none."""
    w = word_hashes(text)
    if not len(w):
        return w
    if len(w) < width:
        return mix(np.array([np.sum(w * _PLACES[: len(w)], dtype=np.uint64) + np.uint64(len(w))], np.uint64))
    n = len(w) - width + 1
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total += w[i : i + n] * _PLACES[i]
    return np.unique(mix(total))


def sets(texts: Iterator[str | None], width: int = 5) -> Iterator[np.ndarray]:
    for text in texts:
        yield shingle_set((text or "").encode(), width)
