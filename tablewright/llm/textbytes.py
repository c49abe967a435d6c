"""Bytes of many texts at once: slices of Arrow batches as numpy arrays.

The texts of a batch lie behind each other in one byte array, so work on bytes,
words and windows is done for thousands of documents in one vector operation.
Batches are cut into slices of bounded size; only a single long text can make
a slice larger.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

# A fixed pseudo-random number per byte, and an odd factor per position.
_TABLE = np.random.default_rng(20260731).integers(0, 2**64, 256, dtype=np.uint64)
FACTOR = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(FACTOR, -1, 2**64)
_powers = {f: np.ones(1, np.uint64) for f in (FACTOR, INVERSE)}


def powers(factor: int, n: int) -> np.ndarray:
    """factor ** 0 .. factor ** (n - 1), modulo 2 ** 64."""
    have = _powers[factor]
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(pow(factor, len(have), 2**64))])
        _powers[factor] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; a one-to-one map."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Texts:
    """Some texts: ``data`` holds their bytes, ``offsets`` where each begins (and the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int = 0):
        self.data, self.offsets, self.first = data, offsets, first

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def starts(self) -> np.ndarray:
        """Flags of the bytes that begin a text."""
        flags = np.zeros(len(self.data) + 1, bool)
        flags[self.offsets] = True
        return flags[:-1]

    def prefix(self) -> np.ndarray:
        """Running hash: entry i covers the bytes before i."""
        n = len(self.data)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[self.data] * powers(FACTOR, n), out=out[1:])
        return out

    def spans_hash(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes from each start to its end, wherever they lie."""
        if not len(start):
            return np.zeros(0, np.uint64)
        shift = powers(INVERSE, int(start.max()) + 1)[start]
        return mixed((prefix[end] - prefix[start]) * shift + (end - start).astype(np.uint64))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words, and the index of the first word of each text (and the end)."""
        if not len(self.data):
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(len(self.offsets), np.int64)
        inside = ~_SPACE[self.data]
        begins = self.starts()
        before = np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        start = np.flatnonzero(inside & (~before | begins))
        after = np.empty_like(inside)
        after[-1], after[:-1] = False, inside[1:] & ~begins[1:]
        end = np.flatnonzero(inside & ~after) + 1
        return start, end, np.searchsorted(start, self.offsets)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data | np.uint8(32), data)


def windows(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside a text, and the index of each text's first (and the end).

    ``words`` are word hashes, ``first`` the index of each text's first word.
    """
    n = len(words)
    counts = np.maximum(np.diff(first) - (k - 1), 0)
    where = np.zeros(len(first), np.int64)
    np.cumsum(counts, out=where[1:])
    if n < k:
        return np.zeros(0, np.uint64), where
    h = words[: n - k + 1].copy()
    for i in range(1, k):
        h = mixed(h) + words[i : n - k + 1 + i]
    at = np.arange(where[-1]) + np.repeat(first[:-1] - where[:-1], counts)
    return mixed(h[at]), where


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of a column in slices; a missing text counts as an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), n)
        yield Texts(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], at)
        at = to


def batches_of(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of the batches with the rows that belong to them."""
    for batch in batches:
        for part in slices(batch.column(text)):
            yield batch.slice(part.first, len(part)), part
