"""Vectorised scans over the UTF-8 bytes of a batch of texts.

A batch is one byte array in which every text ends with a line feed that is not part of it, so
that neither words nor lines run over the end of a text. Words are maximal runs of bytes other
than the six ASCII white spaces (0x09-0x0D, 0x20); in UTF-8 these bytes never occur inside a
longer character. A null text is an empty one. Work space per byte is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18
_STEP = np.uint64(0x9E3779B97F4A7C15)

SPACE = np.zeros(256, bool)
SPACE[[*range(9, 14), 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: First bytes of UTF-8 characters; the others continue one.
LEADING = (np.arange(256) & 0xC0) != 0x80


class Texts:
    """Some texts of a batch: rows `first` to `last`, their bytes, and where each text begins."""

    def __init__(self, first: int, last: int, data: np.ndarray, begin: np.ndarray, end: np.ndarray):
        self.first, self.last = first, last
        self.data, self.begin, self.end = data, begin, end

    def __len__(self) -> int:
        return self.last - self.first

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """Number of set bytes of each text."""
        before = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
        return before[self.end] - before[self.begin]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Cut a string column into runs of texts of about `limit` bytes; a longer text stands alone."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    texts = pc.fill_null(column, "").cast(pa.large_binary())
    closed = pc.binary_join_element_wise(texts, pa.scalar(b"\n", pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    if not len(closed):
        return
    _, offsets, data = closed.buffers()
    edge = np.frombuffer(offsets, np.int64)[closed.offset : closed.offset + len(closed) + 1]
    data = np.frombuffer(data, np.uint8)
    first = 0
    while first < len(closed):
        last = max(first + 1, int(np.searchsorted(edge, edge[first] + limit, "right")) - 1)
        at = edge[first : last + 1] - edge[first]
        yield Texts(first, last, data[edge[first] : edge[last]], at[:-1], at[1:] - 1)
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs stay equal, others look independent."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, 1)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x


_PLACE = np.uint64(0xD6E8FEB86659FD93)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the disjoint, ascending byte spans [begin, end); `lower` folds A-Z.

    Every block of eight bytes is put through a finaliser together with its place in the span, and
    the results are added, so that no arrangement of equal blocks cancels out. Two of n different
    spans share a hash with probability n^2 / 2^65, as if hashes were random.
    """
    out, k = np.empty(len(begin), np.uint64), 0
    while k < len(begin):
        low = int(begin[k])
        stop = max(k + 1, int(np.searchsorted(end, low + SLICE_BYTES, "right")))
        own = data[low : int(end[stop - 1])]
        own = _LOWER[own] if lower else own
        out[k:stop] = _block_sums(np.concatenate([own, np.zeros(8, np.uint8)]), begin[k:stop] - low, end[k:stop] - low)
        k = stop
    return out


def _block_sums(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of spans of bytes that are followed by eight more bytes."""
    eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    length = end - begin
    total = np.zeros(len(begin), np.uint64)
    # Most words are shorter than two blocks; the blocks of longer ones are laid out side by side.
    first = eights[begin]
    rest = np.maximum(8 - length, 0).astype(np.uint64) * np.uint64(8)
    some = length > 0
    total[some] = mix((first[some] << rest[some]) ^ _PLACE)
    if (long_ := np.flatnonzero(length > 8)).size:
        blocks = (length[long_] - 1) // 8
        owner = np.repeat(np.arange(len(long_)), blocks)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks) + 1
        at = begin[long_][owner] + 8 * place
        cut = np.maximum(at + 8 - end[long_][owner], 0).astype(np.uint64) * np.uint64(8)
        found = mix((eights[at] << cut) ^ (place.astype(np.uint64) + np.uint64(1)) * _PLACE)
        total[long_] += np.add.reduceat(found, np.cumsum(blocks) - blocks)
    with np.errstate(over="ignore"):
        return mix(total + length.astype(np.uint64) * _STEP)


class Words:
    """The words of some texts: byte spans, and for each text the range [first, last) of its words."""

    def __init__(self, texts: Texts):
        space = SPACE[texts.data]
        before = np.concatenate(([True], space[:-1]))
        self.begin = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(space & ~before)
        self.first = np.searchsorted(self.begin, texts.begin)
        self.last = np.searchsorted(self.begin, texts.end)
        self.space = space
        self.count = self.last - self.first
        self._texts = texts

    def hashes(self, lower: bool = False) -> np.ndarray:
        return span_hashes(self._texts.data, self.begin, self.end, lower)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self._texts)), self.count)


def windows(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of n words inside each text: (hash, text, first word)."""
    count = np.maximum(last - first - n + 1, 0)
    owner = np.repeat(np.arange(len(first)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    total = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            total = (total + hashes[at + j]) * _STEP + np.uint64(2 * j + 1)
    return mix(total), owner, at


def keyed(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes that also tell the text, so that one sort serves all texts of a slice."""
    return mix(hashes ^ mix(owner.astype(np.uint64) + _STEP))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Marks values that occur twice or more."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = np.concatenate(([False], ranked[1:] == ranked[:-1]))
    twice = same.copy()
    twice[:-1] |= same[1:]
    out = np.empty(len(keys), bool)
    out[order] = twice
    return out
