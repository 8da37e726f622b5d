"""Bucket identifiers of q-grams by pointer refinement, and the anchors that stand for windows.

The identifier of a 2q-gram is made of those of the q-gram at its start and of the q-gram at the
later offset q, and is reused for the next doubling, from single bytes up to the window.
Identifiers name their bucket in all documents alike, so tasks refine apart from each other.
"""

from __future__ import annotations

import numpy as np

#: Length of the strings looked for, of the q-grams of the initial buckets, and of the longest
#: refined q-gram. WINDOW - BUCKET offsets of a window compete to be its anchor.
WINDOW = 200
BUCKET = 64
REFINED = 128
SPAN = WINDOW - BUCKET + 1
#: Window starts handled at once; their places take the low bits of a comparison.
CHUNK = 1 << 20
PLACE_BITS = 24
PLACE = np.uint64((1 << PLACE_BITS) - 1)

_K1, _K2, _K3 = map(np.uint64, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_SHIFT = np.uint64(32)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The identifier of a pair of identifiers."""
    h = a * _K1
    h += b
    h ^= h >> _SHIFT
    h *= _K3
    h ^= h >> _SHIFT
    return h


_BYTES = mix(np.arange(1, 257, dtype=np.uint64), np.full(256, _K2))


def refined(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of the q-grams of BUCKET and of REFINED bytes at every start."""
    ids, length, initial = _BYTES[data], 1, None
    while length < REFINED:
        ids = mix(ids[:-length], ids[length:])
        length *= 2
        if length == BUCKET:
            initial = ids
    return initial, ids


def window_ids(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Identifiers of the windows at `starts` from those of their REFINED-grams."""
    return mix(ids[starts], ids[starts + (WINDOW - REFINED)])


def anchors(initial: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """The anchors of all windows: (bucket, context, first window, windows, anchor).

    Of the q-grams inside a window the one of least identifier, the first among equals, is its
    anchor. Equal windows have equal anchors at equal offsets. Neighbouring windows share one;
    the context identifies all bytes of these windows and the place of the anchor.
    """
    least = (initial & ~PLACE) | np.arange(len(initial), dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = SPAN - width
    least = np.minimum(least[: len(least) - rest], least[rest:])
    place = (least & PLACE).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], len(place)] - 1
    at = place[first]
    size = last - first + WINDOW
    middle = first + np.minimum(REFINED, size - REFINED)
    context = mix(mix(ids[first], ids[middle]), ids[last + WINDOW - REFINED])
    context = mix(context, (size << 20 | (at - first)).astype(np.uint64))
    return initial[at], context, first, last - first + 1, at
