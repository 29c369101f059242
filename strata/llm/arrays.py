"""Vectorised text primitives over Arrow columns: byte views, word spans and
64-bit hashes of words, shingles and byte windows.  All arithmetic is modulo
2**64, so equal content has equal hashes wherever it lies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text that one vectorised step works on.
SLICE_BYTES = 2 << 20

_B = 0x9E3779B97F4A7C15
_U = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, base, _U)]))


_LO = 1 << 14
_POW = _powers(_B, _LO)
_INV = pow(_B, -1, 1 << 64)
_IPOW = _powers(_INV, _LO)


def _high(base: int, n: int) -> np.ndarray:
    return _powers(pow(base, _LO, 1 << 64), n)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, stop) ranges of rows with at most ``limit`` bytes of text, one
    row at least."""
    off = offsets(column)
    i, n = 0, len(column)
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j
    pa.default_memory_pool().release_unused()  # workers outlive tasks and share an executor's memory


def _large(column: pa.Array) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def offsets(column: pa.Array) -> np.ndarray:
    c = _large(column)
    return np.frombuffer(c.buffers()[1], np.int64)[c.offset:c.offset + len(c) + 1] if len(c) else np.zeros(1, np.int64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes, end to end, and where each row begins (n + 1
    offsets).  A null is empty."""
    c = _large(column)
    if not len(c):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(c.buffers()[1], np.int64)[c.offset:c.offset + len(c) + 1]
    data = np.frombuffer(c.buffers()[2], np.uint8)[off[0]:off[-1]] if c.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (the splitmix64 finaliser)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


class Spans:
    """Hashes of any byte spans of one buffer, by prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        hi = n // _LO + 1
        self.sums = np.empty(n + 1, _U)
        self.sums[0] = 0
        block = np.empty(min(n, _LO), _U)
        for k, high in enumerate(_high(_B, hi)):  # a block at a time stays in a core's cache
            a, b = k * _LO, min((k + 1) * _LO, n)
            part, sums = block[:b - a], self.sums[a + 1:b + 1]
            np.add(data[a:b], _U(1), out=part, dtype=_U)
            part *= _POW[:b - a]
            part *= high
            np.cumsum(part, out=sums)
            sums += self.sums[a]
        self._hi = _high(_INV, hi + 1)

    def raw(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        h = self.sums[stop] - self.sums[start]
        return h * (self._hi[start >> 14] * _IPOW[start & (_LO - 1)])

    def hash(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, stop) + (stop - start).astype(_U) * _U(0xD6E8FEB86659FD93))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of a word when white space alone separates words: all but
#: 09-0D and 20.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Bytes of a word made of digits, ASCII letters and anything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, off: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and stops of words in the buffer, and how many words precede
    each row (n + 1 counts).  Words never cross rows."""
    inside = kind[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = off[:-1][off[:-1] < len(data)]
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = off[1:][off[1:] > 0] - 1
    last[edge] = inside[edge]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, off)


def shingle_hashes(words: np.ndarray, before: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words in each row, in order, and how many
    precede each row.  A row of fewer words, but not none, gives its whole
    sequence as one."""
    n = np.diff(before)
    per = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    ahead = np.concatenate([[0], np.cumsum(per)])
    row = np.repeat(np.arange(len(n)), per)
    at = np.arange(ahead[-1]) - ahead[row] + before[row]
    size = np.minimum(n, k)[row]
    h = size.astype(_U)
    padded = np.concatenate([words, np.zeros(k, _U)])
    for j in range(k):
        step = mix(h * _U(0x9FB21C651E98DF25) + padded[at + j])
        h = np.where(j < size, step, h)
    return h, ahead


def rows_of(ahead: np.ndarray) -> np.ndarray:
    """The row of each item, from the counts before each row."""
    return np.repeat(np.arange(len(ahead) - 1), np.diff(ahead))


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    if len(v) < width:
        return v[:0]
    span = 1
    while span * 2 <= width:
        v = np.minimum(v[:len(v) - span], v[span:])
        span *= 2
    rest = width - span
    return np.minimum(v[:len(v) - rest], v[rest:]) if rest else v
