import re

import numpy as np
import pyarrow as pa

from headway.llm.words import gram_hashes, rows_of, word_texts, words_of

TEXTS = ["One  two\tthree", None, "", " \n", "two three One", "É, é! x-y", "a" * 70000 + " b", "one TWO"]


def test_words_are_runs_without_white_space():
    for limit in (1, 20, 1 << 20):
        got = []
        for w in words_of(pa.array(TEXTS), limit=limit):
            texts = word_texts(w, np.arange(len(w.starts)))
            rows = rows_of(w.bounds)
            got += [[t for t, r in zip(texts, rows, strict=True) if r == k] for k in range(w.last - w.first)]
        assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in TEXTS]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    by_word: dict[str, set[int]] = {}
    for limit in (1, 1 << 20):
        for w in words_of(pa.array(TEXTS), limit=limit):
            for t, h in zip(word_texts(w, np.arange(len(w.starts))), w.hashes.tolist(), strict=True):
                by_word.setdefault(t, set()).add(h)
    assert all(len(h) == 1 for h in by_word.values())
    assert len({h for x in by_word.values() for h in x}) == len(by_word)


def test_lower_and_bare():
    (w,) = words_of(pa.array(["One one ÉTÉ été"]), lower=True)
    assert w.hashes[0] == w.hashes[1] and w.hashes[2] != w.hashes[3]
    (w,) = words_of(pa.array(["(Été, été. ... x-y x-y! xy"]), bare=True)
    assert len(w.hashes) == 5  # the dots are no word
    assert w.hashes[0] == w.hashes[1] and w.hashes[2] == w.hashes[3] != w.hashes[4]


def test_grams_depend_on_their_words_alone():
    h = np.arange(1, 100, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in (1, 5, 8, 50):
        g = gram_hashes(h, k)
        assert len(g) == 100 - k
        assert (gram_hashes(h[7:], k) == g[7:]).all()
    assert len(gram_hashes(h[:3], 5)) == 0
