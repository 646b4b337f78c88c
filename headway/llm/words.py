"""Vectorised words and word hashes over Arrow string columns.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D.  These are
single bytes in UTF-8, so splitting the bytes equals splitting the text.  Each
word is hashed to 64 bits by a polynomial over random byte values, taken from
one running sum over the whole batch, and mixed at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Text bytes handled at once; a longer single text is handled alone.
SLICE_BYTES = 2 << 20
#: Words longer than this are hashed one by one.
LONG_WORD = 1 << 16

_M = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
_rng = np.random.default_rng(20240601)
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = _ALNUM[128:] = True

#: Hash of the token that ends a text.
END = np.uint64(0x00000000E0F0E0F1)

_powers: dict[tuple[int, int], np.ndarray] = {}


def powers(base: int, n: int, key: int = 0) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get((base, key))
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        steps = np.full(size, base & _M, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if size <= 1 << 23:
            _powers[(base, key)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit generator: spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of some consecutive rows of a batch.

    ``first``/``last`` row numbers in the batch; ``bounds[i]:bounds[i+1]`` are
    the words of row ``first + i``; ``starts``/``ends`` byte offsets in ``data``.
    """

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return offs, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes, or one longer row."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def _hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + SLICE_BYTES, "right"))
        if j <= i:
            j = i + 1
        lo, hi = int(starts[i]), int(ends[j - 1])
        if hi - lo <= 2 * SLICE_BYTES:
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(values[data[lo:hi]] * powers(_BASE, hi - lo), out=sums[1:])
            s = starts[i:j] - lo
            out[i:j] = (sums[ends[i:j] - lo] - sums[s]) * powers(_INV, hi - lo + 1)[s]
        i = j
    for k in np.flatnonzero(ends - starts > LONG_WORD):
        kept = values[data[starts[k] : ends[k]]]
        out[k] = int.from_bytes(hashlib.blake2b(np.trim_zeros(kept, "b").tobytes(), digest_size=8).digest(), "little")
    return mix(out)


def words_of(column: pa.Array, lower: bool = False, bare: bool = False, limit: int = SLICE_BYTES) -> Iterator[Words]:
    """Words of every row, in slices of rows.

    ``lower``: A-Z count as a-z.  ``bare``: letter case (also of Latin-1
    letters) and punctuation do not count, and words of punctuation alone are
    left out.
    """
    values = _VALUES
    if lower or bare:
        values = values[_LOWER]
    if bare:
        values = np.where(_ALNUM, values, np.uint64(0))
    offsets, data = string_buffers(column)
    for i, j in row_slices(offsets, limit):
        base = int(offsets[i])
        b = data[base : int(offsets[j])]
        rows = offsets[i : j + 1] - base
        n = len(b)
        solid = ~_SPACE[b]
        begin = solid.copy()
        begin[1:] &= ~solid[:-1]
        finish = solid.copy()
        finish[:-1] &= ~solid[1:]
        inner = rows[(rows > 0) & (rows < n)]
        begin[inner] = solid[inner]
        finish[inner - 1] = solid[inner - 1]
        starts = np.flatnonzero(begin)
        ends = np.flatnonzero(finish) + 1
        if bare:
            if n > 1:  # upper-case Latin-1 letters are 0xC3 0x80-0x9E
                up = np.flatnonzero((b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[:-1] == 0xC3)) + 1
                if len(up):
                    b = b.copy()
                    b[up] += 0x20
            core = np.flatnonzero(_ALNUM[b])
            if len(core):
                at = np.searchsorted(core, starts)
                first = core[np.minimum(at, len(core) - 1)]
                keep = (at < len(core)) & (first < ends)
                starts, ends = first[keep], ends[keep]
            else:
                starts, ends = starts[:0], ends[:0]
        bounds = np.searchsorted(starts, rows)
        yield Words(i, j, b, starts, ends, bounds, _hash_words(b, starts, ends, values))


_GRAM = 0xD1342543DE82EF95
_GRAM_INV = pow(_GRAM, -1, 1 << 64)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position; len(hashes) - k + 1 values."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if k <= 8:
        out = hashes[:n].copy()
        for j in range(1, k):
            out *= np.uint64(_GRAM)
            out += hashes[j : n + j]
        return mix(out)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(_GRAM, len(hashes), 1), out=sums[1:])
    return mix((sums[k:] - sums[:n]) * powers(_GRAM_INV, n, 1))


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """Row (from 0) of each word."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def word_texts(words: Words, which: np.ndarray) -> list[str]:
    """The text of the words numbered ``which``."""
    data = words.data.tobytes()
    return [data[s:e].decode("utf-8", "replace") for s, e in zip(words.starts[which], words.ends[which], strict=True)]
