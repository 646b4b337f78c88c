"""Decontamination: planted copies and edits are found, other documents are not."""

import random

import pyarrow as pa
import pytest

from headway.llm import decontaminate as dc
from headway.llm.alignment import local_alignment
from headway.llm.words import words_of
from tests.llm.conftest import as_documents, prose
from tests.llm.test_dedup import edited

ITEMS = "item_id long, text string, key string, score string"


def items(spark, rows):
    return spark.createDataFrame([(i, t, "k", "s") for i, t in rows], ITEMS)


def shortened(text, seed):
    rnd, words = random.Random(seed), text.split()
    for _ in range(3):
        words.pop(rnd.randrange(len(words)))
    return " ".join(words)


@pytest.mark.parametrize("block_words", [1_000_000, 60])
def test_planted_passages(spark, block_words):
    tests = [(k, prose(9000 + k, 25 + k)) for k in range(8)] + [(50, prose(9000, 25)), (60, "a b"), (61, None), (62, "?")]
    rows, planted = [], set()
    for k in range(60):
        body = prose(k, 80)
        if k % 3 == 0:
            item = k % 8
            passage = tests[item][1]
            passage = [passage, passage.upper().replace(" ", ", "), edited(passage, k, 0.12), shortened(passage, k)][k % 4]
            body = f"{prose(700 + k, 30)} {passage} {body}"
            planted |= {(k, item)} | ({(k, 50)} if item == 0 else set())
        rows.append((k, body, "s"))
    docs = as_documents(spark, rows)
    got = dc.contaminated_pairs(docs, items(spark, tests), block_words).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted and len(got) == len(planted)
    for r in got:
        assert 0.6 <= r.score <= 1 and 20 <= r.start_word <= 35 and r.end_word > r.start_word
        if r.doc_id % 4 in (0, 1):
            assert r.score == 1.0 and r.end_word - r.start_word == len(tests[r.item_id % 50][1].split())
    kept = dc.drop_contaminated(docs, items(spark, tests), block_words)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == set(range(60)) - {i for i, _ in planted}


def test_long_and_short_items_are_judged_whole(spark):
    """One row an item, scored over its whole length, and no document dropped for a last word or a short item."""
    long = prose(40, 2001)
    words = long.split()
    tests = [(1, long), (2, words[5]), (3, " ".join(words[7:9])), (4, prose(41, 2600))]
    half = prose(41, 2600).split()
    rows = [
        (1, f"{prose(1, 30)} {words[-1]} {prose(2, 30)}", "s"),  # the item's last word alone
        (2, f"{prose(3, 30)} {edited(long, 5, 0.05)} {prose(4, 30)}", "s"),
        (3, words[5], "s"),
        (4, " ".join(half[:2000]), "s"),  # 0.77 of the item
        (5, " ".join(half[:1300]), "s"),  # half of it
        (6, " ".join(half[1000:2600]), "s"),  # 0.62 of it, from a middle place on
        *((10 + k, f"{words[5]} {words[7]} {words[8]} {prose(10 + k, 40)}", "s") for k in range(5)),
    ]
    docs = as_documents(spark, rows)
    got = {(r.doc_id, r.item_id): r for r in dc.contaminated_pairs(docs, items(spark, tests)).collect()}
    assert got.keys() == {(2, 1), (3, 2), (4, 4), (6, 4)}
    assert 0.85 < got[2, 1].score < 1 and got[2, 1].start_word == 30 and got[2, 1].end_word == 2031
    assert abs(got[4, 4].score - 2000 / 2600) < 0.01 and abs(got[6, 4].score - 1600 / 2600) < 0.01
    kept = dc.drop_contaminated(docs, items(spark, tests))
    assert {r.doc_id for r in kept.collect()} == {1, 5, 10, 11, 12, 13, 14}


def test_scores_of_all_documents_equal_alignment_without_seeds(spark):
    """Common items, an edit at every fourth word, words put in after each pair: all that score 0.6 are found."""
    tests = [(k, prose(9100 + k, 4 + k)) for k in range(30)] + [(40, "a b c d e f g h")]
    rows = []
    for i, text in tests:
        words = text.split()
        fourth = [f"new{k}" if k % 4 == 3 else x for k, x in enumerate(words)]
        pairs = [y for k, x in enumerate(words) for y in ([x, "more"] if k % 2 else [x])]
        gap = words[: len(words) // 2] + ["gap"] * (len(words) // 2) + words[len(words) // 2 :]
        for k, x in enumerate((fourth, pairs, gap, words)):
            rows.append((10 * i + k, f"{prose(i, 6)} {' '.join(x)} {prose(i + 50, 6)}", "s"))
    rows += [(1000 + k, f"a b c {'x' if k % 2 else 'd'} {'y' if k % 3 else 'e'} f g h", "s") for k in range(40)]  # each word frequent
    want = set()
    for i, text in tests:
        (a,) = words_of(pa.array([text]), bare=True)
        for d, own, _ in rows:
            (b,) = words_of(pa.array([own]), bare=True)
            if local_alignment(a.hashes, b.hashes)[0] / (2 * len(a.hashes)) >= dc.SCORE:
                want.add((d, i))
    got = dc.contaminated_pairs(as_documents(spark, rows), items(spark, tests)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) > 100


def test_odd_rows(spark, odd, odd_rows, none):
    tests = [(1, prose(2, 120)), (None, prose(3, 90)), (2, ""), (3, None), (1, prose(2, 120)), (4, prose(1, 6000))]
    got = dc.contaminated_pairs(odd, items(spark, tests)).collect()
    assert sorted((r.doc_id, r.item_id) for r in got if r.doc_id is not None and r.doc_id < 6) == [(1, 1), (2, 1), (2, 1)]
    assert [(r.doc_id, r.item_id) for r in got if r.doc_id is None] == [(None, None)] * 2
    assert {(r.doc_id, r.item_id) for r in got if (r.doc_id or 0) >= 6} == {(6, 4), (7, 4)}
    assert dc.contaminated_pairs(none, items(spark, tests)).collect() == []
    assert dc.contaminated_pairs(odd, items(spark, [])).collect() == []
    assert dc.drop_contaminated(odd, items(spark, [])).count() == len(odd_rows)
