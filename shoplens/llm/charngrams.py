"""Hashed character n-grams of a batch of texts (numpy inside a task)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from shoplens.llm import textbytes as tb

_CODES = 0x110000


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its lower-case letter or 32 (no letter); whether it is a letter."""
    letter = np.zeros(_CODES, bool)
    lower = np.full(_CODES, 32, np.uint32)
    for c in range(_CODES):
        s = chr(c)
        if s.isalpha():
            letter[c] = True
            low = s.lower()
            lower[c] = ord(low) if len(low) == 1 else c
    return lower, letter


def gram_counts(column, size: int, orders=(1, 2, 3)):
    """Per row of a text column: (buckets, counts) of its n-grams, or None when it has no letter.

    Letters are lower-cased, every run of other characters is one blank, and the
    n-grams of each order are hashed into ``size`` buckets.
    """
    lower, _ = _tables()
    raw, offsets = tb.utf8_column(column)
    for a, b in tb.slices(offsets):
        data = raw[offsets[a]:offsets[b]]
        off = offsets[a:b + 1] - offsets[a]
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        if len(codes) != lead[-1]:      # bytes that are no UTF-8: row by row
            rows = [data[s:e].tobytes().decode("utf-8", "replace").encode("utf-32-le") for s, e in zip(off[:-1], off[1:])]
            codes = np.frombuffer(b"".join(rows), np.uint32)
            cuts = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])])
        else:
            cuts = lead[off]
        c = lower[codes]
        blank = c == 32
        keep = np.ones(len(c), bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        first = cuts[:-1]
        keep[first[first < len(c)]] = True
        kept = np.concatenate([[0], np.cumsum(keep)])
        c, cuts = c[keep], kept[cuts]
        parts = []
        for n in orders:
            if len(c) < n:
                parts.append(np.empty(0, np.uint32))
                continue
            h = np.full(len(c) - n + 1, n, np.uint32)
            for j in range(n):
                h = (h + c[j:len(c) - n + 1 + j]) * np.uint32(0x9E3779B1)
                h ^= h >> np.uint32(15)
            parts.append((h % np.uint32(size)).astype(np.int32))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if not (c[lo:hi] != 32).any():
                yield None
                continue
            count = np.bincount(np.concatenate([p[lo:max(lo, hi - n + 1)] for p, n in zip(parts, orders)]), minlength=size)
            at = np.flatnonzero(count)
            yield at, count[at]
