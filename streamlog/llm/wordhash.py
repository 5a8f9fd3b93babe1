"""Words of UTF-8 texts and their hashes, with numpy over whole buffers."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNDO = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes hashed at a time; words longer than that are hashed alone.
CHUNK = 1 << 20


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of unsigned 64-bit integers that spreads every bit."""
    x = (x + np.uint64((2 * salt + 1) * 0xD1342543DE82EF95 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(29)


def spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of ``[^\\x20\\x09-\\x0D]``."""
    space = np.concatenate(([True], _SPACE[np.frombuffer(data, np.uint8)], [True]))
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[::2], edges[1::2]


def hashes(data: bytes, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of each span, which depends on its bytes only. Spans are ascending and apart."""
    out, raw, at = np.empty(len(starts), np.uint64), np.frombuffer(data, np.uint8), 0
    while at < len(starts):
        to = max(int(np.searchsorted(ends, starts[at] + CHUNK, "right")), at + 1)
        low, high = starts[at], ends[to - 1]
        size = int(high - low)
        power = np.multiply.accumulate(np.full(size, _BASE))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw[low:high].astype(np.uint64) + np.uint64(1)) * power)))
        back = np.multiply.accumulate(np.full(size, _UNDO))
        first, last = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (total[last] - total[first]) * back[first]
        at = to
    return mix(out, salt)


def windows(words: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """A hash for each run of ``width`` word hashes."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        out = out * _BASE + words[k:len(words) - width + 1 + k]
    return mix(out, salt)
