"""Adaptive dimension scan against brute force."""

import numpy as np
import pytest

from headway.llm import ads_search

SCHEMA = "vec_id long, embedding array<float>, label int, q int, list int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 1, 2) for i, v in vectors], SCHEMA)


def brute(vectors, k=20):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], np.float32).astype(np.float64)
    out = {}
    for n in np.flatnonzero(ids % 20 == 0):
        score = (x * x[n]).sum(axis=1)
        other = np.flatnonzero(ids != ids[n])
        top = other[np.lexsort((ids[other], -score[other]))[:k]]
        out[int(ids[n])] = [(int(ids[t]), score[t]) for t in top]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("norms", [False, True])
def test_recall_and_exact_scores(spark, norms):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 32)) + 3 * rng.standard_normal((8, 32))[rng.integers(0, 8, 3000)]
    if norms:
        x *= rng.uniform(0.2, 5, (3000, 1))
    vectors = [(i, list(map(float, v))) for i, v in enumerate(x.astype(np.float32))]
    want, got = brute(vectors), found(ads_search.search(table(spark, vectors), lists=12))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)
    for q, rows in got.items():
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))
        for i, s in rows:
            assert s == pytest.approx(float(np.float64(np.float32(x[i])) @ np.float64(np.float32(x[q]))), rel=1e-12)


def test_odd_vectors_and_ties(spark):
    good = [(i, [float(i % 5), 1.0, 0.5]) for i in range(1, 60)] + [(0, [1.0, 1.0, 1.0])]
    odd = [(100, None), (120, []), (140, [0.0, 0.0, 0.0]), (160, [1.0, None, 2.0]), (180, [1.0, float("nan"), 2.0]), (200, [float("inf"), 0.0, 1.0]), (None, [1.0, 2.0, 3.0])]
    got = found(ads_search.search(table(spark, good + odd + [good[3], good[3]])))
    want = brute(good)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_few_vectors_and_none(spark):
    assert found(ads_search.search(table(spark, [(20, [1.0, 0.0]), (21, [0.5, 0.5]), (40, [0.0, 1.0])]))) == {
        20: [(21, 0.5), (40, 0.0)],
        40: [(21, 0.5), (20, 0.0)],
    }
    assert ads_search.search(table(spark, [])).collect() == []
    assert ads_search.search(table(spark, [(20, [1.0])])).collect() == []


def test_many_equal_vectors(spark):
    vectors = [(i, [1.0, 2.0, 2.0]) for i in range(300)] + [(300 + i, [float(i), 0.0, 1.0]) for i in range(50)]
    got, want = found(ads_search.search(table(spark, vectors), lists=4)), brute(vectors)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_scan_keeps_what_is_near():
    rng = np.random.default_rng(1)
    rotation = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    x, q = rng.standard_normal((2000, 64)) @ rotation, rng.standard_normal(64) @ rotation
    d = ((x - q) ** 2).sum(axis=1)
    limit = np.sort(d)[19]
    kept = ads_search.scan(x, q, limit)
    assert (d[kept] <= limit * (1 + 1e-8)).all()  # the last test is exact
    assert len(kept) >= 19  # rejecting a near vector early is rare


def test_stray_widths_and_one_id_with_two_vectors(spark):
    good = [(i, [float(i % 7), 1.0, 0.25 * (i % 3)]) for i in range(60)]
    stray = [(100, [9.0, 9.0]), (120, [1.0]), (140, [5.0, 5.0, 5.0, 5.0])]
    lesser = [(20, [-50.0, 0.0, 1.0]), (33, [-1.0, 99.0, 99.0])]
    got = found(ads_search.search(table(spark, lesser + stray + good)))
    want = brute(good)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
