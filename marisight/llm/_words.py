"""Vectorised word and shingle hashing over Arrow string columns.

Every function works on the UTF-8 buffer of one Arrow batch, so the cost per word is a handful of
numpy operations and no Python object is made per word.  Words are maximal runs of bytes outside
``[\\x20\\x09-\\x0D]``; as those separators are ASCII, splitting bytes equals splitting code points.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
_WORD_BASE = _U(0x9E3779B97F4A7C15)
_RUN_BASE = _U(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: a bijection that spreads every input bit over the word."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


#: one random-looking 64-bit value per byte
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xA0761D6478BD642F))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def _inverse(b: int) -> int:
    return pow(b, -1, 1 << 64)


_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _powers(base: _U, n: int, inverse: bool = False) -> np.ndarray:
    """base**0 … base**(n-1) modulo 2**64 (of the inverse, if asked)."""
    key = (int(base), inverse)
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        b = _inverse(int(base)) if inverse else int(base)
        out = np.full(max(n, 1 << 12), _U(b), dtype=_U)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        _POWERS[key] = have = out
    return have[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string or binary array; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """The words of a batch: byte spans, and the first word number of each row."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # len(rows) + 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(column: pa.Array, lower: bool = False) -> Words:
    data, offsets = utf8(column)
    if lower:
        data = _LOWER[data]
    solid = ~_SPACE[data]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    closes = solid.copy()
    closes[:-1] &= ~solid[1:]
    bounds = offsets[(offsets > 0) & (offsets < len(data))]
    if len(bounds):  # a word never runs over the end of its row
        opens[bounds] = solid[bounds]
        closes[bounds - 1] = solid[bounds - 1]
    start = np.flatnonzero(opens)
    return Words(data, start, np.flatnonzero(closes) + 1, np.searchsorted(start, offsets))


def word_hashes(w: Words) -> np.ndarray:
    """One 64-bit hash per word: a polynomial over byte values, mixed with the length."""
    if not len(w.start):
        return np.zeros(0, _U)
    out = np.empty(len(w.start), _U)
    step = 1 << 19  # keeps the working set small, whatever the batch holds
    lo = 0
    while lo < len(w.start):
        hi = max(lo + 1, int(np.searchsorted(w.start, w.start[lo] + step)))
        a, b = int(w.start[lo]), int(w.end[hi - 1])
        total = np.zeros(b - a + 1, _U)
        np.cumsum(_BYTE[w.data[a:b]] * _powers(_WORD_BASE, b - a), out=total[1:])
        s, e = w.start[lo:hi] - a, w.end[lo:hi] - a
        out[lo:hi] = (total[e] - total[s]) * _powers(_WORD_BASE, b - a + 1, True)[s] + (e - s).astype(_U)
        lo = hi
    return mix(out)


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive entries (ignoring row ends): len(hashes) - k + 1 values."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.zeros(n, _U)
    for j in range(k):
        out *= _RUN_BASE
        out += hashes[j : j + n]
    return mix(out)


def spans(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end) of entries, position independent."""
    n = len(hashes)
    total = np.zeros(n + 1, _U)
    np.cumsum(hashes * _powers(_RUN_BASE, n), out=total[1:])
    return mix((total[end] - total[start]) * _powers(_RUN_BASE, n + 1, True)[start] + (end - start).astype(_U))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
