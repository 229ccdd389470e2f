"""Words, shingles and their 64-bit hashes over Arrow string columns, in numpy.

A word is a maximal run of bytes other than space and ``\\t \\n \\v \\f \\r``
(all ASCII, so bytes and code points agree). A hash takes a span's length and
then its bytes, eight at a time, each step through a non-linear mix that starts at
the seed: words made to collide under one seed do not under another. Everything works on slices of a few MB, so memory does not follow the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64's finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Longer spans are hashed as the hashes of their pieces of this many bytes.
_PIECE = 256
_ODD, _ADD = U(0x9FB21C651E98DF25), U(0xD6E8FEB86659FD93)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base))
    if n:
        out[0] = U(1)
    return np.multiply.accumulate(out)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each (a longer text is one part)."""
    _, at = buffers(batch.column(column))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the spans ``data[start:end]``."""
    size = (end - start).astype(np.int64)
    first = mix(np.array([seed], U) * _ODD + _ADD)[0]
    out = mix(size.astype(U) * _ADD + first)
    wide = size > _PIECE
    if wide.any():
        n = -(-size[wide] // _PIECE)
        edge = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(start[wide], n) + (np.arange(edge[-1]) - np.repeat(edge[:-1], n)) * _PIECE
        pieces = span_hashes(data, at, np.minimum(at + _PIECE, np.repeat(end[wide], n)), seed)
        out[wide] = mix(out[wide] ^ span_hashes(pieces.astype("<u8").view(np.uint8), 8 * edge[:-1], 8 * edge[1:], seed))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each byte on
    live = np.flatnonzero((size > 0) & ~wide)
    at, left = start[live], size[live]
    while len(live):
        block = eight[at]
        short = left < 8
        block[short] &= (U(1) << (left[short].astype(U) * U(8))) - U(1)
        out[live] = mix((out[live] ^ block) * _ODD + _ADD)
        on = left > 8
        live, at, left = live[on], at[on] + 8, left[on] - 8
    return out


class Words:
    """The words of some texts: ``start``/``end`` bytes, ``hash``, ``first[d]:first[d + 1]`` per text."""

    def __init__(self, column: pa.Array, lower: bool = False, seed: int = 0):
        self.data, self.at = buffers(column)
        self.seed = seed
        raw, at = self.data, self.at
        self.texts = len(at) - 1
        space = _SPACE[raw]
        before, after = np.ones(len(raw), bool), np.ones(len(raw), bool)
        if len(raw):
            before[1:] = space[:-1]
            after[:-1] = space[1:]
            full = at[1:] > at[:-1]
            before[at[:-1][full]] = True
            after[at[1:][full] - 1] = True
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(~space & after) + 1
        self.first = np.searchsorted(self.start, at)
        self.count = np.diff(self.first)
        self._lower = lower
        self._hash: np.ndarray | None = None

    def spans(self, start: np.ndarray, end: np.ndarray, seed: int | None = None) -> np.ndarray:
        """Hashes of byte spans."""
        return span_hashes(_LOWER[self.data] if self._lower else self.data, start, end, self.seed if seed is None else seed)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = self.spans(self.start, self.end)
        return self._hash

    @property
    def text(self) -> np.ndarray:
        """The text number of every word."""
        return np.repeat(np.arange(self.texts), self.count)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``size`` words inside one text."""
        return windows(self.hash, self.first, size)


def windows(values: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the runs of ``size`` values that stay inside one group."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    total = np.zeros(n, U)
    for k, factor in enumerate(powers(0xC2B2AE3D27D4EB4F, size + 1)[1:]):
        total += values[k:k + n] * factor
    inside = np.ones(n, bool)
    for edge in first[1:-1]:
        inside[max(0, edge - size + 1):min(n, edge)] = False
    at = np.flatnonzero(inside)
    return at, mix(total[at])
