"""Quality classifier: held-out accuracy, rows, and the update rule."""

import zlib

import numpy as np

from headway.llm import ngram_quality as nq
from tests.llm.conftest import as_documents, prose


def corpus(spark, n=400):
    rows, labels = [], []
    for i in range(n):
        good = i % 4 > 0
        text = prose(i, 40 + i % 100)
        bad = [text.upper().replace(" ", "!! "), " ".join(w for w in text.split()[:5] for _ in range(12)), text.replace(" ", " | ")][i // 4 % 3]
        rows.append((i, text if good else bad, "s"))
        if i % 2 or not good:
            labels.append((i, int(good)))
    return as_documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    got = {r.doc_id: r for r in nq.quality_scores(docs, labels).collect()}
    assert len(got) == 400
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [i for i, r in got.items() if r.held_out]
    assert sum(got[i].predicted == (i % 4 > 0) for i in held) >= 0.97 * len(held)
    kept = nq.keep_good(docs, labels)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}


def test_labels_of_held_out_rows_are_not_learnt(spark):
    docs, labels = corpus(spark, 120)
    lies = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - quality, quality) as quality")
    a = {r.doc_id: r.score for r in nq.quality_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in nq.quality_scores(docs, lies).collect()}
    assert a == b


def test_odd_rows(spark, odd, odd_rows, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (None, 0), (6, 7), (8, 0)], "doc_id long, quality int")
    got = nq.quality_scores(odd, labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert all(not r.held_out for r in got if r.doc_id is None)
    empty = {r.score for r in got if r.doc_id in (3, 4, 5)}
    assert len(empty) == 1
    assert nq.quality_scores(none, labels).collect() == []
    unlabelled = nq.quality_scores(odd, labels.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.5}


def test_ftrl_equals_a_plain_loop():
    rng = np.random.default_rng(2)
    examples = [(rng.choice(40, 6, replace=False), rng.uniform(0.1, 1, 6), int(rng.integers(0, 2))) for _ in range(50)]
    z, n = {}, {}

    def weight(i):
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        return 0.0 if abs(zi) <= 0.02 else (np.sign(zi) * 0.02 - zi) / ((1 + ni**0.5) / 0.5 + 0.01)

    for _ in range(2):
        for index, value, label in examples:
            p = 1 / (1 + np.exp(-sum(weight(i) * v for i, v in zip(index, value, strict=True))))
            old = {i: weight(i) for i in index}
            for i, v in zip(index, value, strict=True):
                g = (p - label) * v
                z[i] = z.get(i, 0.0) + g - ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / 0.5 * old[i]
                n[i] = n.get(i, 0.0) + g * g
    got = nq.ftrl(examples, epochs=2)
    assert np.allclose([got[i] for i in range(40)], [weight(i) for i in range(40)])
