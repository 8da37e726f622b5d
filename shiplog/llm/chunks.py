"""Content-defined chunks: cuts where a rolling hash of the last bytes has a rare value.

Equal passages are cut alike wherever they stand, but for their first and last chunk.
"""

from __future__ import annotations

import numpy as np

#: Bytes that the hash looks back on, and the bounds and mean of a chunk's length beyond LEAST.
LOOK_BACK, LEAST, MEAN, MOST = 32, 128, 512, 4096
_FACTOR = np.uint32(0x9E3779B1)
#: Bytes hashed at once.
BLOCK = 1 << 22


def _letters() -> np.ndarray:
    """A number without pattern for each byte."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


LETTERS = _letters()


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Of the last LOOK_BACK bytes up to each: a polynomial, summed in doubling steps."""
    h, width, factor = LETTERS[data], 1, _FACTOR
    while width < LOOK_BACK:
        longer = h.copy()
        longer[width:] += h[:-width] * factor
        h, width = longer, 2 * width
        factor = np.uint32(int(factor) ** 2 & 0xFFFFFFFF)
    return h


def cuts(data: bytes) -> list[int]:
    """Where the chunks of a UTF-8 text begin and where it ends; never within a character."""
    n = len(data)
    if n <= LEAST:
        return [0, n] if n else [0]
    raw = np.frombuffer(data, np.uint8)
    found = []
    for start in range(0, n, BLOCK):
        before = max(start - LOOK_BACK + 1, 0)
        h = rolling_hash(raw[before : start + BLOCK])[start - before :]
        found.append(np.flatnonzero((h >> np.uint32(7)) % np.uint32(MEAN) == 0) + start + 1)
    out = [0]
    for at in [*np.concatenate(found).tolist(), n]:
        while at - out[-1] > MOST:
            out.append(_whole(raw, out[-1] + MOST))
        at = _whole(raw, at) if at < n else n
        if at - out[-1] >= LEAST or at == n > out[-1]:
            out.append(at)
    return out


def chunks(data: bytes) -> list[bytes]:
    bounds = cuts(data)
    return [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def _whole(raw: np.ndarray, at: int) -> int:
    """The next position from `at` on that is not within a character."""
    while at < len(raw) and raw[at] & 0xC0 == 0x80:
        at += 1
    return at
