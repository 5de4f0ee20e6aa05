"""Anchors of a text's bytes: places that equal strings of a given length choose alike."""

from __future__ import annotations

import numpy as np

from .shingles import _powers, mix

#: Bytes of an anchor.
GRAM = 100
#: Bytes of a text that are hashed at a time.
SEGMENT = 1 << 22
_TABLE = np.random.default_rng(3_200).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sliding(x: np.ndarray, size: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each `size` neighbours."""
    width = 1
    while width * 2 <= size:
        x = pick(x[:-width], x[width:])
        width *= 2
    return pick(x[: len(x) - (size - width)], x[size - width :]) if size > width else x


def chosen(h: np.ndarray, window: int) -> np.ndarray:
    """Places whose hash is the least of some `window` neighbours; ties are all chosen."""
    least = sliding(h, window, np.minimum)
    edge = np.zeros(window - 1, h.dtype)
    return np.flatnonzero(h == sliding(np.concatenate([edge, least, edge]), window, np.maximum))


def find(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor places, anchor hashes, hashes of the anchors' contexts, and ranges (rows of start, stop) that repeat inside themselves.

    Every string of `length` bytes of the text that is not inside one of the ranges holds an anchor,
    and equal strings hold anchors of equal hash at equal places. The context of an anchor is the
    union of all such strings around it, cut at the text's ends. Long texts are taken in segments
    that overlap by more than an anchor's choice and context reach.
    """
    if len(text) > SEGMENT + 4 * length:
        parts = []
        for start in range(0, len(text), SEGMENT):
            low = max(0, start - 2 * length)
            at, h, c = _find(text[low : start + SEGMENT + 2 * length], length)
            own = (at + low >= start) & (at + low < start + SEGMENT)
            parts.append(_thinned(at[own] + low, h[own], c[own], length))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    return _thinned(*_find(text, length), length)


def _thinned(at: np.ndarray, h: np.ndarray, c: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors without those inside long periodic ranges, and these ranges.

    Equal anchors that follow each other at one distance d, no more than an anchor's length, lie in
    a range of period d. If it is long, each of its strings of `length` bytes also starts d bytes
    before or after. Other strings meet the range at its ends only, so anchors there are enough.
    """
    none = np.zeros((0, 2), np.int64)
    if len(at) < 3:
        return at, h, c, none
    gap = np.diff(at)
    step = np.where((h[1:] == h[:-1]) & (gap <= GRAM), gap, 0)
    heads = np.flatnonzero(np.append(True, step[1:] != step[:-1]))
    tails = np.append(heads[1:], len(step))
    start, stop = at[heads], at[tails] + GRAM
    long = (step[heads] > 0) & (stop - start >= 4 * length)
    if not long.any():
        return at, h, c, none
    keep = np.ones(len(at), bool)
    for i, j, low, high in zip(heads[long].tolist(), tails[long].tolist(), start[long].tolist(), stop[long].tolist(), strict=True):
        own = at[i : j + 1]
        keep[i : j + 1] &= (own < low + length) | (own > high - length)
    return at[keep], h[keep], c[keep], np.stack([start[long], stop[long]], axis=1)


def _find(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    b = np.frombuffer(text, np.uint8)
    if len(b) < length:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    powers, inverse = _powers(len(b) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[b] * powers[: len(b)], dtype=np.uint64)])
    h = mix((total[GRAM:] - total[:-GRAM]) * inverse[: len(b) - GRAM + 1])
    at = chosen(h, length - GRAM + 1)
    start, stop = np.maximum(at - (length - GRAM), 0), np.minimum(at + length, len(b))
    of_bytes = (total[stop] - total[start]) * inverse[start]
    context = mix(of_bytes + mix((at - start).astype(np.uint64) * np.uint64(1 << 20) + (stop - start).astype(np.uint64)))
    return at, h[at].view(np.int64), context.view(np.int64)
