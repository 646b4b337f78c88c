"""Phrase collocations against a plain count; Misra-Gries guarantees; exact large products."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from headway.llm import collocations as co
from tests.llm.conftest import DOCUMENTS

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count=10, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in (1, 2, 3):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i : i + k])] += 1
    candidates = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= min_count}
    out = []
    for (lang, g), a in candidates.items():
        if any(x == lang and len(h) > len(g) and 100 * b >= 50 * a and g in (h[:2], h[1:]) for (x, h), b in candidates.items()):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    ranked, ranks = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        ranks[lang] += 1
        if ranks[lang] <= top:
            ranked.append((lang, ranks[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return ranked


def found(spark, rows, **kw):
    docs = spark.createDataFrame([(k, t, x, "s", 0, 0.5, "x", 1, 2) for k, (x, t) in enumerate(rows)], DOCUMENTS)
    return sorted(tuple(r) for r in co.collocations(docs, **kw).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def sentences(seed, count, langs=("en", "de", None, "und")):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)] + ["É", "Über", "naïve", "İ"]
    rows = []
    for _ in range(count):
        words = []
        for _ in range(rnd.randrange(60)):
            words += rnd.choice([["New", "York"], ["on", "the", "Other", "hand"], [rnd.choice(vocabulary)], [rnd.choice(vocabulary)], [rnd.choice(vocabulary)]])
            words.append(rnd.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\r\n"]))
        rows.append((rnd.choice(langs), " ".join(words)))
    return rows


def test_against_plain_counts(spark):
    rows = sentences(3, 120) + [("en", None), ("en", ""), (None, "..!\n\t "), ("fr", "one two three")]
    rows += [("xx", "the " * 3000), ("xx", "the cat " * 500)]
    assert found(spark, rows) == sorted(brute(rows))


def test_limits_and_ties(spark):
    rows = sentences(5, 80, ("en",))
    assert found(spark, rows, min_count=3, top=7) == sorted(brute(rows, 3, 7))


def test_empty_table(spark):
    assert found(spark, []) == []


@pytest.mark.parametrize("mass", [64, 4096])
def test_many_partitions_and_flushes(spark, mass, monkeypatch):
    """Small partitions and task tables make summaries meet and counters run out; results are the same."""
    monkeypatch.setattr(co, "MASS", mass)
    monkeypatch.setattr(co, "HELD", 500)
    rows = sentences(8, 60, ("en", "de"))
    assert found(spark, rows) == sorted(brute(rows))


def test_misra_gries_keeps_every_frequent_key():
    rnd = np.random.default_rng(1)
    for _ in range(30):
        threshold = int(rnd.integers(2, 30))
        stream = rnd.zipf(1.3, 5000).astype(np.uint32) % 4000
        parts = [np.unique(x, return_counts=True) for x in np.array_split(stream, int(rnd.integers(1, 20)))]
        capacity = len(stream) // threshold + 1
        keys, counts, taken = co.merge_summaries(parts, capacity)
        assert len(keys) <= capacity and taken * (capacity + 1) <= len(stream)
        true = Counter(stream.tolist())
        left = dict(zip(keys.tolist(), counts.tolist(), strict=True))
        assert all(left.get(k, 0) <= n <= left.get(k, 0) + taken for k, n in true.items())
        assert {k for k, n in true.items() if n >= threshold} <= {k for k, c in left.items() if c + taken >= threshold}


def test_scores_are_exact(spark):
    cases = [(10**12 + 7, 3 * 10**12 + 1, 2 * 10**12 + 9), (10, 10, 10), (4_000_000_001, 4_000_000_003, 4_000_000_007), (10, 10**13, 10**13)]
    got = spark.createDataFrame(cases, "a long, l long, r long").select(co._score("a", "l", "r").alias("s")).collect()
    assert [r.s for r in got] == [1_000_000 * a * a // (x * y) for a, x, y in cases]
