"""Public tokenizers over a batch of texts, with a memo of chunk encodings.

Byte-pair encoding never crosses a pre-token, and no pre-token of the two
vocabularies crosses a white-space boundary.  So a text is cut into chunks at
white space (found on the UTF-8 bytes with numpy), each different chunk is
encoded once with the ``tokenizers`` library, and a text's ids are gathered from
the memo.  The memo is a fixed-size direct-mapped table a Python worker, keyed
by a 64-bit hash and the chunk's byte length.

A text with white space outside ASCII or with the string of an added token (such as
``<|endoftext|>``, which the library replaces by its id) is encoded whole, and a chunk
with characters from U+0250 on goes through the whole tokenizer, so their Unicode
classes are always the library's own.
"""

from __future__ import annotations

import numpy as np
import regex

from shoplens.llm import textbytes as tb

# The pre-token patterns of the two vocabularies.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

MEMO_SLOTS = 1 << 20
POOL_IDS = 6_000_000


def _byte_alphabet() -> dict[int, str]:
    """Bytes as printable characters: visible Latin-1 as itself, the rest from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _wide_space(data: np.ndarray) -> np.ndarray:
    """Positions where a white-space character outside ASCII begins."""
    if data.size < 2:
        return np.empty(0, np.int64)
    a, b = data[:-1], data[1:]
    c = np.zeros_like(a)
    c[:-1] = data[2:]
    two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    dashes = (a == 0xE2) & (b == 0x80) & (((c >= 0x80) & (c <= 0x8A)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    rest = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    return np.flatnonzero(two | dashes | rest)


class ChunkEncoder:
    """Ids of whole texts; ``keep_space``: white space belongs to the chunks (byte-level vocabulary)."""

    def __init__(self, path: str, keep_space: bool):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        # Strings that the tokenizer looks for in the text as it is; all are found as they stand (not normalised).
        self.added = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.model, self.normalizer = self.tok.model, self.tok.normalizer
        self.keep_space = keep_space
        self.pattern = regex.compile(BYTE_PATTERN if keep_space else WORD_PATTERN)
        self.alphabet = _byte_alphabet()
        self.keys = np.zeros(MEMO_SLOTS, np.uint64)
        self.width = np.zeros(MEMO_SLOTS, np.int32)     # bytes of the chunk; 0: free slot
        self.first = np.zeros(MEMO_SLOTS, np.int32)
        self.count = np.zeros(MEMO_SLOTS, np.int32)
        self.pool = np.zeros(POOL_IDS, np.int32)
        self.filled = 0

    def _whole(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _chunk(self, raw: bytes) -> list[int]:
        s = raw.decode("utf-8", "replace")
        if not s.isascii() and max(s) >= "ɐ":
            return self._whole(s)
        if not self.keep_space:
            s = s.lower() if s.isascii() else self.normalizer.normalize_str(s)
        body = s[1:] if s[:1] == " " else s
        parts = [s] if body.isascii() and body.isalpha() else self.pattern.findall(s)
        return [t.id for p in parts for t in self.model.tokenize(p.encode().decode("latin-1").translate(self.alphabet))]

    def _added(self, data: np.ndarray) -> np.ndarray:
        """Positions of the strings of added tokens (a string across two texts marks the first one needlessly)."""
        raw, found = data.tobytes(), []
        for text in self.added:
            at = raw.find(text)
            while at >= 0:
                found.append(at)
                at = raw.find(text, at + 1)
        return np.array(found, np.int64)

    def _cuts(self, data: np.ndarray, off: np.ndarray):
        space = tb.ASCII_SPACE[data]
        if not self.keep_space:
            return tb.spans(~space, off)
        n = data.size
        fresh = np.zeros(n, bool)
        inner = off[:-1]
        fresh[inner[inner < n]] = True
        last = np.zeros(n, bool)                 # the last byte of its text
        ends = off[1:]
        last[ends[ends > 0] - 1] = True
        before = np.zeros(n, bool)
        before[1:] = space[:-1]
        after = np.ones(n, bool)
        after[:-1] = space[1:]
        after |= last
        blank = np.zeros(n, bool)
        blank[1:] = data[:-1] == 32
        begin = fresh | (space & (~before | ~after)) | (~space & before & ~blank)
        starts = np.flatnonzero(begin)
        stops = np.append(starts[1:], n) if len(starts) else starts
        return starts, stops, np.searchsorted(starts, off)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids before each text) for texts at ``off`` in ``data``."""
        if self.filled > POOL_IDS:               # full: forget all, between two slices
            self.width[:] = 0
            self.pool, self.filled = np.zeros(POOL_IDS, np.int32), 0
        starts, ends, cut = self._cuts(data, off)
        h = tb.span_hash(data, starts, ends)
        width = (ends - starts).astype(np.int32)
        slot = (h & np.uint64(MEMO_SLOTS - 1)).astype(np.int64)
        known = (self.keys[slot] == h) & (self.width[slot] == width)
        first, count = self.first[slot], self.count[slot]
        miss = np.flatnonzero(~known)
        if len(miss):
            keys, at, inverse = np.unique(h[miss], return_index=True, return_inverse=True)
            at = miss[at]
            new = [self._chunk(data[s:e].tobytes()) for s, e in zip(starts[at].tolist(), ends[at].tolist())]
            sizes = np.array([len(x) for x in new], np.int32)
            flat = np.array([i for x in new for i in x], np.int32)
            if self.filled + len(flat) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros(len(flat), np.int32)])
            base = self.filled
            self.pool[base:base + len(flat)] = flat
            begin = base + np.cumsum(sizes) - sizes
            first[miss], count[miss] = begin[inverse], sizes[inverse]
            s = slot[at]
            self.keys[s], self.width[s], self.first[s], self.count[s] = keys, width[at], begin, sizes
            self.filled += len(flat)
        total = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        ids = self.pool[np.repeat(first - total[:-1], count) + np.arange(total[-1])]
        ids_off = total[cut]
        odd = np.concatenate([_wide_space(data), self._added(data)])
        if len(odd):
            rows = np.unique(np.searchsorted(off, odd, "right") - 1)
            parts = [ids[ids_off[i]:ids_off[i + 1]] for i in range(len(off) - 1)]
            for i in rows.tolist():
                parts[i] = np.array(self._whole(data[off[i]:off[i + 1]].tobytes().decode("utf-8", "replace")), np.int32)
            ids = np.concatenate(parts)
            ids_off = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, ids_off


_ENCODERS: dict[tuple[str, bool], ChunkEncoder] = {}


def encode_column(column, path: str, keep_space: bool, end_id: int):
    """For slices of a text column: (ids with ``end_id`` after each text, ids before each text)."""
    encoder = _ENCODERS.get((path, keep_space))
    if encoder is None:
        encoder = _ENCODERS[(path, keep_space)] = ChunkEncoder(path, keep_space)
    raw, offsets = tb.utf8_column(column)
    for a, b in tb.slices(offsets):
        ids, off = encoder.encode(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        yield np.insert(ids, off[1:], end_id).astype("<i4"), off + np.arange(len(off))
