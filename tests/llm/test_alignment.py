import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import alignment

SEQUENCE = st.lists(st.integers(0, 3), max_size=24)


def array(x):
    return np.array(x, np.uint64)


def table(a, b):
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y)))
        rows.append(row)
    return rows[-1][-1]


@settings(max_examples=300, deadline=None)
@given(SEQUENCE, SEQUENCE, st.integers(0, 24), st.booleans())
def test_edit_distance_equals_the_full_table(a, b, limit, rows):
    cells = alignment.BAND_CELLS
    alignment.BAND_CELLS = 0 if rows else cells
    try:
        got = alignment.edit_distance(array(a), array(b), limit)
    finally:
        alignment.BAND_CELLS = cells
    want = table(a, b)
    assert got == (want if want <= limit else None)
    assert alignment.least_distance(array(a), array(b)) <= want


@settings(max_examples=300, deadline=None)
@given(SEQUENCE, SEQUENCE, st.integers(0, 24))
def test_each_way_gives_the_distance(a, b, limit):
    """By diagonals, by rows of a band, by columns of bits: what they find is the full table's distance."""
    want = table(a, b)
    if a and b:
        assert alignment._by_bits(array(a), array(b), limit) == (want if want <= limit else None)
        if abs(len(a) - len(b)) <= limit:
            for way in (alignment._by_diagonals, alignment._by_rows):
                assert way(array(a), array(b), limit) == (want if want <= limit else None)


def test_long_texts_take_columns_of_bits(monkeypatch):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 400, 1500).astype(np.uint64)
    b = np.delete(a, rng.choice(1500, 90, replace=False))
    b[rng.choice(len(b), 100, replace=False)] = 999
    got = alignment.edit_distance(a, b, 300)
    monkeypatch.setattr(alignment, "_by_bits", None)
    monkeypatch.setattr(alignment, "BIT_WORDS", 0)
    assert got is not None and got == alignment.edit_distance(a, b, 300)


@settings(max_examples=200, deadline=None)
@given(SEQUENCE, SEQUENCE)
def test_local_alignment_equals_the_full_table(a, b):
    def full(a, b):
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        return max(map(max, h))

    score, start, end = alignment.local_alignment(array(a), array(b))
    assert score == full(a, b) == full(a, b[start:end])


def test_similarity():
    a = np.arange(100, dtype=np.uint64)
    assert alignment.edit_similarity(a, a, 0.8) == 1.0
    assert alignment.edit_similarity(a[:0], a[:0], 0.8) == 1.0
    assert alignment.edit_similarity(a, a[20:], 0.8) == pytest.approx(0.8)
    assert alignment.edit_similarity(a, a[21:], 0.8) is None
