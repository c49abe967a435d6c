"""Directly addressable codes: token ids in chunk levels, any of which is found without decoding its neighbours.

The low bits of every id lie in the first level, the next bits of those ids
that need them in the second, and so on. A bit per chunk says whether its id
goes on; the rank of that bit, taken from a directory of running counts and
the bits of at most one directory block, is the place of the id's next chunk.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

MAGIC = b"TWDAC1\r\n"
RANK_BITS = 512  # bits of a continuation bitmap between two counts of its directory
_HEAD = "<8sIIQQ"  # magic, levels, zero, documents, tokens
_LEVEL = "<IIQQQQ"  # width, shift, chunks, offsets of chunks, bitmap and directory
_HEAD_BYTES, _LEVEL_BYTES = struct.calcsize(_HEAD), struct.calcsize(_LEVEL)
_SLICE = 1 << 16  # values packed at once; a multiple of eight, so that slices end at whole bytes


def best_widths(ids: np.ndarray) -> list[int]:
    """Widths of the levels that take the fewest bits for these ids, continuation bits included."""
    lengths = np.zeros(33, np.int64)
    for at in range(0, len(ids), _SLICE):
        part = ids[at : at + _SLICE].astype(np.float64)
        lengths += np.bincount(np.frexp(part)[1], minlength=33)
    longer = np.concatenate([np.cumsum(lengths[::-1])[::-1], [0]])  # ids of so many bits or more
    top = int(np.flatnonzero(lengths)[-1]) if len(ids) else 0
    if top <= 1:
        return [1]
    least, step = [0] * (top + 1), [0] * (top + 1)
    for low in range(top - 1, -1, -1):
        here = len(ids) if low == 0 else int(longer[low + 1])
        costs = [
            here * (high - low + (high < top)) + (least[high] if high < top else 0) for high in range(low + 1, top + 1)
        ]
        step[low] = int(np.argmin(costs)) + low + 1
        least[low] = min(costs)
    widths, low = [], 0
    while low < top:
        widths.append(step[low] - low)
        low = step[low]
    return widths


def _pack(values: np.ndarray, width: int) -> bytes:
    parts = []
    for at in range(0, len(values), _SLICE):
        raw = values[at : at + _SLICE].astype("<u4").view(np.uint8).reshape(-1, 4)
        bits = np.unpackbits(raw[:, : (width + 7) // 8], axis=1, bitorder="little")[:, :width]
        parts.append(np.packbits(bits.reshape(-1), bitorder="little").tobytes())
    return b"".join(parts)


def _unpack(data: np.ndarray, width: int, start: int, stop: int) -> np.ndarray:
    """The chunks from ``start`` to ``stop``."""
    out = np.zeros((stop - start, 4), np.uint8)
    n_bytes = (width + 7) // 8
    for at in range(start, stop, _SLICE):
        to = min(at + _SLICE, stop)
        first = at * width // 8
        bits = np.unpackbits(data[first : (to * width + 7) // 8], bitorder="little")
        skip = at * width - first * 8
        rows = bits[skip : skip + (to - at) * width].reshape(-1, width)
        out[at - start : to - start, :n_bytes] = np.packbits(rows, axis=1, bitorder="little")
    return out.reshape(-1).view("<u4").astype(np.uint32, copy=False)


def _aligned(size: int) -> int:
    return (size + 7) // 8 * 8


def encode(doc_ids: Sequence[int | None], lengths: Sequence[int], ids: np.ndarray, widths: Sequence[int] | None = None) -> bytes:
    """A file of some documents: their ids, the number of tokens of each, and all tokens one after another."""
    ids = np.ascontiguousarray(ids, np.uint32)
    missing = np.array([d is None for d in doc_ids], np.uint8)
    numbers = np.array([0 if d is None else d for d in doc_ids], "<i8")
    starts = np.zeros(len(numbers) + 1, "<u8")
    np.cumsum(np.asarray(lengths, np.uint64), out=starts[1:])
    if int(starts[-1]) != len(ids):
        raise ValueError("lengths do not add up to the tokens")
    widths = list(widths or best_widths(ids))
    levels, sections, shift = [], [], 0
    for k, width in enumerate(widths):
        last = k == len(widths) - 1
        chunks = _pack(ids & np.uint32((1 << width) - 1), width)
        rest = ids >> np.uint32(width) if width < 32 else np.zeros(len(ids), np.uint32)
        goes_on = rest > 0
        if last and goes_on.any():
            raise ValueError("the levels are too narrow for these ids")
        bitmap = b"" if last else np.packbits(goes_on, bitorder="little").tobytes()
        counts = np.zeros(0, "<u8")
        if not last:
            padded = np.zeros(-(-len(ids) // RANK_BITS) * RANK_BITS, np.uint8)
            padded[: len(ids)] = goes_on
            counts = np.zeros(len(padded) // RANK_BITS + 1, "<u8")
            np.cumsum(padded.reshape(-1, RANK_BITS).sum(axis=1, dtype=np.uint64), out=counts[1:])
        levels.append((width, shift, len(ids)))
        sections.append((chunks, bitmap, counts.tobytes()))
        ids, shift = rest[goes_on], shift + width
    out = [struct.pack(_HEAD, MAGIC, len(widths), 0, len(numbers), int(starts[-1]))]
    at = _aligned(_HEAD_BYTES + _LEVEL_BYTES * len(widths))
    at += _aligned(len(missing)) + numbers.nbytes + starts.nbytes
    for (width, low, n), parts in zip(levels, sections):
        offsets = []
        for part in parts:
            offsets.append(at)
            at += _aligned(len(part))
        out.append(struct.pack(_LEVEL, width, low, n, *offsets))
    head = b"".join(out)
    body = [head, bytes(_aligned(len(head)) - len(head)), numbers.tobytes(), starts.tobytes(), missing.tobytes()]
    body.append(bytes(_aligned(len(missing)) - len(missing)))
    for part in (p for parts in sections for p in parts):
        body += [part, bytes(_aligned(len(part)) - len(part))]
    return b"".join(body)


@dataclass(frozen=True)
class _Level:
    width: int
    shift: int
    n: int
    chunks: np.ndarray
    bitmap: np.ndarray
    counts: np.ndarray


class Codes:
    """A file of codes, as bytes or any buffer (a memory map reads only what is asked for)."""

    def __init__(self, data):
        data = np.frombuffer(data, np.uint8)
        magic, n_levels, _, self.n_docs, self.n_tokens = struct.unpack(_HEAD, data[:_HEAD_BYTES].tobytes())
        if magic != MAGIC:
            raise ValueError("not a file of token codes")
        self.levels = []
        for k in range(n_levels):
            at = _HEAD_BYTES + k * _LEVEL_BYTES
            width, shift, n, chunks, bitmap, counts = struct.unpack(_LEVEL, data[at : at + _LEVEL_BYTES].tobytes())
            last = k == n_levels - 1
            self.levels.append(
                _Level(
                    width, shift, n,
                    data[chunks : chunks + (n * width + 7) // 8],
                    data[bitmap : bitmap + (0 if last else (n + 7) // 8)],
                    data[counts : counts + (0 if last else 8 * (-(-n // RANK_BITS) + 1))].view("<u8"),
                )
            )
        at = _aligned(_HEAD_BYTES + n_levels * _LEVEL_BYTES)
        self._numbers = data[at : at + 8 * self.n_docs].view("<i8")
        at += 8 * self.n_docs
        self.starts = data[at : at + 8 * (self.n_docs + 1)].view("<u8").astype(np.int64)
        at += 8 * (self.n_docs + 1)
        self.missing = data[at : at + self.n_docs].astype(bool)

    @property
    def doc_ids(self) -> list[int | None]:
        return [None if m else int(d) for d, m in zip(self._numbers, self.missing)]

    @staticmethod
    def _rank(level: _Level, at: np.ndarray) -> np.ndarray:
        """Continuation bits set before each place."""
        block = at // RANK_BITS
        total = level.counts[block].astype(np.int64)
        first, whole = block * (RANK_BITS // 8), at // 8
        for i in range(len(at)):
            bits = int.from_bytes(level.bitmap[first[i] : whole[i]].tobytes(), "little").bit_count()
            if at[i] % 8:
                bits += (int(level.bitmap[whole[i]]) & ((1 << int(at[i] % 8)) - 1)).bit_count()
            total[i] += bits
        return total

    def take(self, places) -> np.ndarray:
        """The tokens at some places, each by its own chunks and ranks alone."""
        at = np.asarray(places, np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.n_tokens):
            raise IndexError("place outside the file")
        out = np.zeros(len(at), np.uint32)
        who = np.arange(len(at))
        for k, level in enumerate(self.levels):
            for j, i in zip(who, at):
                first = int(i) * level.width
                window = level.chunks[first // 8 : (first + level.width + 7) // 8].tobytes()
                chunk = (int.from_bytes(window, "little") >> (first % 8)) & ((1 << level.width) - 1)
                out[j] |= np.uint32(chunk << level.shift)
            if k == len(self.levels) - 1 or not len(at):
                break
            goes_on = (level.bitmap[at // 8] >> (at % 8).astype(np.uint8)) & 1 == 1
            who, at = who[goes_on], self._rank(level, at[goes_on])
        return out

    def token(self, place: int) -> int:
        return int(self.take([place])[0])

    def span(self, start: int, stop: int) -> np.ndarray:
        """The tokens from ``start`` to ``stop``; only their chunks are read."""
        out = np.zeros(stop - start, np.uint32)
        where = np.arange(stop - start)
        for k, level in enumerate(self.levels):
            if not len(where):
                break
            out[where] |= _unpack(level.chunks, level.width, start, stop) << np.uint32(level.shift)
            if k == len(self.levels) - 1:
                break
            bits = np.unpackbits(level.bitmap[start // 8 : (stop + 7) // 8], bitorder="little")
            bits = bits[start % 8 : start % 8 + stop - start].astype(bool)
            where = where[bits]
            start = int(self._rank(level, np.array([start]))[0]) if start < level.n else 0
            stop = start + len(where)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.span(int(self.starts[k]), int(self.starts[k + 1]))
