"""Vectorised scans of Arrow string columns: words, lines, rolling hashes.

A column's UTF-8 bytes are read as one uint8 array. Hashes of all words or
lines of a chunk of rows come from one prefix sum: a piece's hash is
``sum(T[byte] * B**offset)`` modulo 2**64 with a random table T and odd B,
finished by a 64-bit mixer. Rows are taken in chunks of about CHUNK bytes, so
the working arrays stay small; a text longer than that is a chunk of its own
(about 50 bytes of working memory per byte of it).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
U = np.uint64
_GOLD = 0x9E3779B97F4A7C15


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _table(seed: int) -> np.ndarray:
    return mix64((np.arange(256, dtype=U) + U(1 + 256 * seed)) * U(_GOLD))


WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE, BASE_INV = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK, 1 << max(1, n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up, down = np.full(size, BASE, U), np.full(size, BASE_INV, U)
        up[0] = down[0] = 1
        _POWERS[size] = np.cumprod(up), np.cumprod(down)
    return _POWERS[size]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null row is an empty piece."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; at least one row each."""
    a, rows = 0, len(offsets) - 1
    while a < rows:
        b = int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1
        b = min(rows, max(a + 1, b))
        yield a, b
        a = b


def slices(batches: Iterator[pa.RecordBatch], column: int, size: int = 4 * CHUNK) -> Iterator[pa.RecordBatch]:
    """The batches cut (without copying) where ``column`` passes about ``size``
    bytes: what a task makes of a batch stays a few MB, however wide the rows."""
    for batch in batches:
        _, offsets = bytes_of(batch.column(column))
        for a, b in chunks(offsets, size):
            yield batch.slice(a, b - a)
        pa.default_memory_pool().release_unused()


class Hasher:
    """Hashes of pieces [start, end) of one byte array; equal bytes, equal hash."""

    def __init__(self, data: np.ndarray, seed: int):
        up, self._down = _powers(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, U)
        np.cumsum(_table(seed)[data] * up[:len(data)], out=self._sums[1:])
        self._seed = U((seed * 2 + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self._sums[end] - self._sums[start]) * self._down[start]
        return mix64(h + (end - start).astype(U) * self._seed)


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of all words; ``starts``: where rows begin (a word never
    crosses a row)."""
    inside = ~WHITE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    at = starts[starts < len(data)]
    first[at] = inside[at]
    at = at[at > 0] - 1
    last[at] = inside[at]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def bare(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words [start, end): which hold more than punctuation, and the bounds
    of those without the punctuation at their edges (ASCII, and U+2000-203F:
    typographic quotes and dashes)."""
    mark = ~WORD_BYTE[data]
    at = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80))
    for i in range(3):
        mark[at + i] = True
    inner = np.flatnonzero(~mark)
    lo, hi = np.searchsorted(inner, start), np.searchsorted(inner, end)
    some = hi > lo
    return some, inner[lo[some]], inner[hi[some] - 1] + 1


class Shingles:
    """The ``width``-word shingles of a chunk of rows, A-Z lower-cased:
    ``hashes`` of those starting at each word but the chunk's last, ``whole``
    whether such a shingle stays inside its row, ``cut`` each row's first
    word (and an end), ``start``/``end`` the words' bytes in the chunk. With
    ``strip``, words of punctuation are left out and others read ``bare``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int, strip: bool = False):
        base = offsets[0]
        data = LOWER[data[base:offsets[-1]]]
        starts = offsets[:-1] - base
        self.width = width
        self.start, self.end = words(data, starts)
        first, last = self.start, self.end
        if strip and len(first):
            some, first, last = bare(data, first, last)
            self.start, self.end = self.start[some], self.end[some]
        self.words = Hasher(data, 1)(first, last) if len(first) else np.zeros(0, U)
        self.cut = np.searchsorted(self.start, np.append(starts, len(data)))
        self.factor = mix64(np.arange(1, width + 1, dtype=U) * U(_GOLD)) | U(1)
        n = max(0, len(self.words) - width + 1)
        self.hashes = np.zeros(n, U)
        for i in range(width):
            self.hashes += self.words[i:i + n] * self.factor[i]
        self.hashes = mix64(self.hashes)

    @property
    def whole(self) -> np.ndarray:
        row_end = np.repeat(self.cut[1:], np.diff(self.cut))[:len(self.hashes)]
        return np.arange(len(self.hashes)) + self.width <= row_end

    def distinct(self, row: int) -> np.ndarray:
        """The sorted distinct hashes of one row; with fewer words than a
        shingle its whole sequence is one, without words there is none."""
        a, b = self.cut[row], self.cut[row + 1]
        if b - a >= self.width:
            return np.unique(self.hashes[a:b - self.width + 1])
        if b > a:
            part = (self.words[a:b] * self.factor[:b - a]).sum(dtype=U) + U(b - a)
            return mix64(np.array([part], U))
        return np.zeros(0, U)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Per row of a chunk the sorted distinct hashes of its shingles."""
    found = Shingles(data, offsets, width)
    return [found.distinct(r) for r in range(len(offsets) - 1)]
