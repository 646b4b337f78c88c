"""Alignment of word sequences (arrays of word hashes)."""

from __future__ import annotations

import numpy as np

#: Cells of a band that are laid out at once; where it has more, columns of bits are swept instead.
BAND_CELLS = 1 << 22
#: Words of a text whose columns are single numbers of as many bits; a longer one's band is swept row by row.
BIT_WORDS = 1 << 15


def least_distance(a: np.ndarray, b: np.ndarray) -> int:
    """A lower bound of the edit distance: words of the longer that the other lacks."""
    words, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    common = np.minimum(np.bincount(at[: len(a)], minlength=len(words)), np.bincount(at[len(a) :], minlength=len(words))).sum()
    return max(len(a), len(b)) - int(common)


def _trim(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b, n = a[head:], b[head:], n - head
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    return a[: len(a) - tail], b[: len(b) - tail]


def _by_diagonals(a: np.ndarray, b: np.ndarray, band: int) -> int | None:
    """Edit distance if at most ``band``: furthest reach on each diagonal per number of edits."""
    n, m, width = len(a), len(b), 2 * band + 1
    padded = np.full(n + 2 * band + 1, np.uint64(0), np.uint64)
    inside = np.zeros(len(padded), bool)
    take = min(m, n + band + 1)
    padded[band : band + take], inside[band : band + take] = b[:take], True
    # rows: diagonal (offset of b against a), columns: place in a
    diagonals = np.lib.stride_tricks.sliding_window_view(padded, n + 1)[:width, :n]
    valid = np.lib.stride_tricks.sliding_window_view(inside, n + 1)[:width, :n]
    stop = np.where((diagonals == a) & valid, n, np.arange(n, dtype=np.int32))
    run = np.full((width, n + 2), n, np.int32)  # the next place at or after i where the words differ
    run[:, :n] = np.minimum.accumulate(stop[:, ::-1], axis=1)[:, ::-1]
    offset = np.arange(-band, band + 1)
    goal = m - n + band
    reach = np.full(width + 2, -(1 << 30), np.int64)
    lane = np.arange(width)
    for edits in range(band + 1):
        if edits == 0:
            new = np.full(width, -(1 << 30), np.int64)
            new[band] = 0
        else:
            new = np.maximum(np.maximum(reach[1:-1] + 1, reach[2:] + 1), reach[:-2])
        top = np.minimum(n, m - offset)
        new = np.minimum(new, top)
        ok = (new >= 0) & (new + offset >= 0)
        new = np.where(ok, np.minimum(run[lane, np.clip(new, 0, n)], top), -(1 << 30))
        if new[goal] >= n:
            return edits
        reach[1:-1] = new
    return None


def _by_rows(a: np.ndarray, b: np.ndarray, band: int) -> int | None:
    """The same within memory proportional to the band."""
    n, m, width = len(a), len(b), 2 * band + 1
    far = 1 << 30
    lane = np.arange(width)
    j0 = lane - band
    row = np.where((j0 >= 0) & (j0 <= m), j0, far).astype(np.int64)
    for i in range(1, n + 1):
        j = i + j0
        ok = (j >= 0) & (j <= m)
        same = np.zeros(width, bool)
        use = (j >= 1) & (j <= m)
        same[use] = b[j[use] - 1] == a[i - 1]
        new = np.where(j >= 1, row + ~same, far)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        new = np.where(ok, new, far)
        row = np.where(ok, np.minimum.accumulate(new - lane) + lane, far)
    found = int(row[m - n + band])
    return found if found <= band else None


def _by_bits(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """Edit distance if at most ``limit``: a column's rises and falls are the bits of two numbers (Myers, Hyyrö)."""
    n, top = len(a), len(a) - 1
    places: dict[int, int] = {}
    for i, word in enumerate(a.tolist()):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << n) - 1
    rises, falls, score, left = full, 0, n, len(b)
    for word in b.tolist():
        same = places.get(word, 0)
        up = same | falls
        along = (((same & rises) + rises) ^ rises) | same
        more, less = falls | (full & ~(along | rises)), rises & along
        score += (more >> top & 1) - (less >> top & 1)
        left -= 1
        if score - left > limit:
            return None
        more = more << 1 | 1
        rises = (less << 1 | ~(up | more)) & full
        falls = more & up & full
    return score if score <= limit else None


def _bits_are_less(n: int, m: int, band: int) -> bool:
    """Whether columns of bits take less time than the band's diagonals, by the measured cost of each."""
    return m * (1.0 + n / 1500) < 100 + 0.015 * (2 * band + 1) * (n + 1) + 25 * band


def edit_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """Word edit distance if at most ``limit``, else None; the band widens from the lower bound."""
    if abs(len(a) - len(b)) > limit:
        return None
    a, b = _trim(a, b)
    if not len(a) or not len(b):
        found = max(len(a), len(b))
        return found if found <= limit else None
    least = least_distance(a, b)
    if least > limit:
        return None
    band = least + 8
    while True:
        band = min(band, limit)
        wide = (2 * band + 1) * (len(a) + 1) > BAND_CELLS
        if len(a) <= BIT_WORDS and (wide or _bits_are_less(len(a), len(b), band)):
            return _by_bits(a, b, limit)
        found = (_by_rows if wide else _by_diagonals)(a, b, band)
        if found is not None or band >= limit:
            return found
        band *= 4


def edit_similarity(a: np.ndarray, b: np.ndarray, least: float) -> float | None:
    """1 - distance / words of the longer, if at least ``least``; two empty sequences: 1."""
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    limit = int((1.0 - least) * longer + 1e-9)
    found = edit_distance(a, b, limit)
    return None if found is None else 1.0 - found / longer


def local_alignment(
    item: np.ndarray, passage: np.ndarray, match: int = 2, mismatch: int = -1, gap: int = -1
) -> tuple[int, int, int]:
    """Smith-Waterman: (score, start, end) of the best aligned stretch of ``passage``.

    Ties: the stretch that ends first.
    """
    n, m = len(item), len(passage)
    if not n or not m:
        return 0, 0, 0
    steps = np.arange(m + 1)
    score = np.zeros(m + 1, np.int64)
    origin = np.arange(m + 1)
    best = (0, 0, 0)
    for word in item:
        # score and start travel together: a higher score first, then a later start
        hit = np.where(passage == word, match, mismatch)
        new = np.empty(m + 1, np.int64)
        start = np.empty(m + 1, np.int64)
        new[0], start[0] = 0, 0
        diagonal, above = score[:-1] + hit, score[1:] + gap
        new[1:] = np.maximum(diagonal, above)
        start[1:] = np.where(diagonal >= above, origin[:-1], origin[1:])
        start[new <= 0] = steps[new <= 0]
        new = np.maximum(new, 0)
        lifted = new - gap * steps
        at = np.maximum.accumulate(np.where(lifted == np.maximum.accumulate(lifted), steps, 0))
        along = lifted[at] + gap * steps
        better = along > new
        new, start = np.where(better, along, new), np.where(better, start[at], start)
        score, origin = new, start
        top = int(np.argmax(score))
        if score[top] > best[0]:
            best = (int(score[top]), int(origin[top]), top)
    return best
