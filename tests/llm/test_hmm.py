"""Hidden Markov scores: base model, exact likelihood, training."""

import math
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from headway.llm import hmm
from tests.llm.conftest import as_documents, prose


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["\0end"]


def base(rows):
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _, _ in rows]
    counts = Counter(t for (_, text, _), h in zip(rows, held, strict=True) if not h for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for (i, text, _), h in zip(rows, held, strict=True):
        own = tokens(text)
        out.append((i, h, len(own), sum(counts[t] > 0 for t in own), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)))
    return out


def languages(n):
    """Texts in one of two vocabularies each."""
    return [(i, prose(i, 30 + i % 80).replace("a", "q" if i % 2 else "a").replace("o", "w" if i % 2 else "o"), "s") for i in range(n)]


@pytest.mark.parametrize("which", ["odd", "many"])
def test_base_score_and_counts(spark, odd_rows, which):
    rows = odd_rows if which == "odd" else languages(400)
    got = hmm.hmm_scores(as_documents(spark, rows), states=2, rounds=3).collect()
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(base(rows), key=key), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert math.isfinite(g[6]) and g[6] <= 0
    if which == "many":
        held = [r for r in got if r.held_out]
        assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_nothing_and_no_training_rows(spark, none):
    assert hmm.hmm_scores(none).collect() == []
    i = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (r,) = hmm.hmm_scores(as_documents(spark, [(i, "a b", "s")])).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and math.isfinite(r.score)


def small_model(states=3, seed=0):
    rng = np.random.default_rng(seed)
    size = 1 + hmm.HASHED
    return hmm.first_model(np.zeros(0, np.uint64), rng.random(size) * 50, np.ones(size), states)


def test_likelihood_sums_over_all_paths():
    m = small_model()
    cls = np.array([3, 0, 17, 5])
    want = sum(
        m.begin[p[0]] * m.emit[cls[0], p[0]] * math.prod(m.move[a, b] * m.emit[c, b] for a, b, c in zip(p, p[1:], cls[1:], strict=False))
        for p in product(range(3), repeat=4)
    )
    assert hmm.log_likelihood(m, cls, np.array([4]))[0] == pytest.approx(math.log10(want))


def test_long_texts_by_products_equal_the_plain_recursion():
    m, rng = small_model(), np.random.default_rng(1)
    lengths = np.array([1, 5, 1025, 3000, 1024, 700])
    cls = rng.integers(0, len(m.emit), lengths.sum())
    got, at = hmm.log_likelihood(m, cls, lengths), 0
    for n, g in zip(lengths, got, strict=True):
        a, log = m.begin * m.emit[cls[at]], 0.0
        for c in cls[at + 1 : at + n]:
            log += math.log10(a.sum())
            a = (a / a.sum()) @ m.move * m.emit[c]
        assert g == pytest.approx(log + math.log10(a.sum()))
        at += n


def test_expected_counts_equal_sums_over_all_paths():
    m = small_model(2)
    cls, lengths = np.array([4, 9, 4, 2, 0, 7]), np.array([4, 2])
    got = hmm.expected_counts(m, cls, lengths)
    want = {"begin": np.zeros(2), "move": np.zeros((2, 2)), "emit": np.zeros_like(m.emit)}
    for own in (cls[:4], cls[4:]):
        paths = list(product(range(2), repeat=len(own)))
        p = np.array([m.begin[x[0]] * m.emit[own[0], x[0]] * math.prod(m.move[a, b] * m.emit[c, b] for a, b, c in zip(x, x[1:], own[1:], strict=False)) for x in paths])
        for x, share in zip(paths, p / p.sum(), strict=True):
            want["begin"][x[0]] += share
            for a, b in zip(x, x[1:], strict=False):
                want["move"][a, b] += share
            for s, c in zip(x, own, strict=True):
                want["emit"][c, s] += share
    for name, x in want.items():
        assert np.allclose(got[name], x)
    assert not got["resume"].any()


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(7)
    m = small_model(2)
    cls = np.concatenate([rng.integers(lo, lo + 50, 90) for lo in (0, 200) * 30])
    lengths = np.full(60, 90)
    steps = []
    for _ in range(6):
        steps.append(hmm.log_likelihood(m, cls, lengths).sum())
        m = hmm.renewed(m, hmm.expected_counts(m, cls, lengths))
    assert steps == sorted(steps) and steps[-1] > steps[0] + 1000


def test_shares_of_a_class_sum_to_one():
    """All words of a class, and one unknown word, share its mass."""
    words = np.arange(1, 5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.arange(1, 5000) % 13 + 1
    blank = hmm.Model(np.zeros(0, np.uint64), *(np.zeros(0) for _ in range(6)))
    cls = blank.classes(words)
    size = 1 + hmm.HASHED
    m = hmm.first_model(blank.top, np.bincount(cls, counts, minlength=size), np.bincount(cls, minlength=size).astype(float), 2)
    total = np.bincount(cls, 10 ** m.word_share(words, counts), minlength=size)
    seen = np.unique(cls)
    assert np.allclose(total[seen] + 1 / m.mass[seen], 1)
    assert np.allclose(m.emit.sum(axis=0), 1)
