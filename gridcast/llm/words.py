"""Words and word hashes of Arrow text columns, without a Python step per word.

A word is a maximal run of bytes outside ASCII white space (0x20, 0x09-0x0D); A-Z count as a-z, no other
letter changes. A hash is 64 bits of the word's bytes and the same in every process.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; a longer word widens its own window.
WINDOW = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
# One 64-bit number per byte value; capital letters share the number of the small ones.
_CODES = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64)
_CODES[65:91] = _CODES[97:123]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null rows are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def _powers(n: int, base: np.uint64, cache: dict = {}) -> np.ndarray:  # noqa: B006  (shared on purpose)
    if len(cache.get(base, ())) < n:
        row = np.full(n, base, np.uint64)
        row[0] = 1
        cache[base] = np.multiply.accumulate(row)
    return cache[base][:n]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of the first word of each row (one more at the end)."""
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = solid[cuts]
    last[cuts - 1] = solid[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, low + WINDOW, "right")))
        part = _CODES[data[low:ends[j - 1]]]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * _powers(len(part), _BASE), dtype=np.uint64)])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((sums[e] - sums[s]) * _powers(len(part), _INVERSE)[s] + (e - s).astype(np.uint64))
        i = j
    return out


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` successive words; row borders are the caller's business."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = mix(out + hashes[k:k + n])
    return out


def slices(offsets: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Row ranges of at most `limit` bytes each (a single longer row stands alone)."""
    out, low = [], 0
    while low < len(offsets) - 1:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        out.append((low, high))
        low = high
    return out


def lean(run):
    """A function over batches that gives its freed memory back after each of them."""
    def wrapped(batches):
        for out in run(batches):
            yield out
            del out
            give_back()

    return wrapped


def give_back() -> None:
    """Return freed memory to the system: workers live on between stages and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)
