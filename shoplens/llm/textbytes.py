"""Vectorised work on the UTF-8 bytes of a batch of texts (numpy inside a task).

An Arrow string column is one byte buffer plus offsets.  Words, shingles and
n-grams are found on that buffer with numpy, for many documents at once, so no
Python code runs per word.  Callers get slices of a batch (``slices``), so the
temporary arrays stay a few tens of MB whatever the batch size; only a single
document larger than a slice makes a slice as large as itself.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# Byte tables: A-Z to a-z; ASCII white space.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ASCII_SPACE = np.zeros(256, dtype=bool)
ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True
# 0-9, a-z and every byte of a non-ASCII character (text already lower-cased).
ALNUM_WORD = np.zeros(256, dtype=bool)
ALNUM_WORD[48:58] = ALNUM_WORD[97:123] = ALNUM_WORD[128:] = True


def utf8_column(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES):
    """Consecutive document ranges (first, last) of about ``size`` bytes each."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def spans(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``mask`` inside each document: (starts, ends, words before each offset)."""
    n = mask.size
    fresh = np.ones(n, dtype=bool)      # the byte before is no part of the same run
    fresh[1:] = ~mask[:-1]
    inner = offsets[:-1]
    fresh[inner[inner < n]] = True
    starts = np.flatnonzero(mask & fresh)
    last = np.ones(n, dtype=bool)
    last[:-1] = ~mask[1:] | fresh[1:]
    ends = np.flatnonzero(mask & last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for p in (_P, _P_INV):
        a = np.full(n, p, dtype=np.uint64)
        a[0] = 1
        out.append(np.multiply.accumulate(a))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = SLICE_BYTES
    while size < n + 1:
        size *= 2
    return _powers(size)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit integers (xor-shift, multiply)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: a polynomial from prefix sums, then mixed."""
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = powers(data.size)
    prefix = np.empty(data.size + 1, np.uint64)
    prefix[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:data.size], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * down[starts])


def gram_hash(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive word hashes (length ``len(words) - k + 1``)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= _P
        out += words[j:j + n]
    out += np.uint64(k)
    return mix64(out)


def as_signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
