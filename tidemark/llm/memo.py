"""Ids of spans (words) remembered in numpy arrays, for encoders that work word by word."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tidemark.llm.bytescan import span_hashes


class SpanMemo:
    """Maps byte spans to ids through an open-addressing table of 64-bit span hashes.

    `encode` gets new spans as bytes and returns their serialised ids. At most `limit` spans are
    remembered; later ones are encoded again whenever they occur. Two of n different spans
    share a hash with probability n^2 / 2^65.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], dtype: np.dtype, limit: int):
        self.encode, self.dtype, self.limit, self.count, self.used = encode, dtype, limit, 0, 0
        self.mask = (1 << (2 * limit - 1).bit_length()) - 1
        self.keys = np.zeros(self.mask + 1, np.uint64)
        self.start = np.zeros(self.mask + 1, np.int64)
        self.size = np.zeros(self.mask + 1, np.int32)
        self.ids = np.zeros(1 << 16, dtype)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Slots of the hashes, -1 for those that are not there."""
        out = np.full(len(hashes), -1, np.int64)
        place, left = (hashes & np.uint64(self.mask)).astype(np.int64), np.arange(len(hashes))
        while len(left):
            key = self.keys[place]
            hit = key == hashes[left]
            out[left[hit]] = place[hit]
            go = ~hit & (key != 0)
            left, place = left[go], (place[go] + 1) & self.mask
        return out

    def _add(self, hashes: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        place, left = (hashes & np.uint64(self.mask)).astype(np.int64), np.arange(len(hashes))
        while len(left):
            free = self.keys[place] == 0
            self.keys[place[free]] = hashes[left[free]]
            own = self.keys[place] == hashes[left]  # of several for one slot, the last one has it
            self.start[place[own]], self.size[place[own]] = start[left[own]], size[left[own]]
            left, place = left[~own], (place[~own] + 1) & self.mask

    def __call__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all spans, one after the other; number of ids before each span and at the end)."""
        hashes = np.maximum(span_hashes(data, begin, end), np.uint64(1))
        slot = self._find(hashes)
        start, size = self.start[slot], self.size[slot].astype(np.int64)
        if (missing := np.flatnonzero(slot < 0)).size:
            new, first, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
            raw, at = data.tobytes(), missing[first]
            spans = [raw[b:e] for b, e in zip(begin[at].tolist(), end[at].tolist(), strict=True)]
            found = self.encode(spans)
            flat = np.frombuffer(b"".join(found), self.dtype)
            width = np.array([len(f) for f in found]) // self.dtype.itemsize
            if self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(flat)), self.dtype)])
            self.ids[self.used : self.used + len(flat)] = flat
            begins = self.used + np.cumsum(width) - width
            start[missing], size[missing] = begins[which], width[which]
            if self.count + len(new) <= self.limit:
                self._add(new, begins, width)
                self.count, self.used = self.count + len(new), self.used + len(flat)
        before = np.concatenate(([0], np.cumsum(size)))
        at = np.arange(before[-1]) + np.repeat(start - before[:-1], size)
        return self.ids[at], before
