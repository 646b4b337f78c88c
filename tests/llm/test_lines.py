"""Line dedup against a plain computation; hot lines over many partitions."""

import hashlib
import random
from collections import defaultdict

import pytest

from headway.llm import line_dedup

from tests.llm.conftest import as_documents, prose

_WHITE = " \t\n\x0b\x0c\r"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=40, min_docs=5):
    def key(line):
        return line.strip(_WHITE).translate(_LOWER)

    holders = defaultdict(set)
    for i, text, _ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(line_dedup.NO_DOC if i is None else i)
    out = []
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        me = line_dedup.NO_DOC if i is None else i
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or me == max(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def check(spark, rows):
    got = line_dedup.line_dedup(as_documents(spark, rows))
    want = brute(rows)
    assert sorted(map(str, ((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got.collect()))) == sorted(map(str, want))


def test_odd_rows(spark, odd_rows):
    check(spark, odd_rows)


def test_empty_table(spark, none):
    got = line_dedup.line_dedup(none)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"] and got.collect() == []


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_shared_lines(spark, partitions):
    """One line in two thirds of all documents, others in four to six; whatever the partitioning."""
    rnd = random.Random(partitions)
    hot = "All rights to this harbour report stay with its AUTHOR and nobody else."
    shared = [prose(100 + k, 8) for k in range(12)]
    rows = []
    for i in range(240):
        lines = [prose(1000 + i, 9), "short", ""]
        lines += [hot if rnd.random() < 0.5 else f" \t{hot.upper()} \r"] * rnd.choice([0, 1, 2])
        rows.append([i if i % 50 else None, lines])
    for k, line in enumerate(shared):
        for i in rnd.sample(range(240), 4 + k % 3):
            rows[i][1].insert(rnd.randrange(3), line + ("" if k % 2 else "\x0b"))
    rows = [(i, "\n".join(x), "s") for i, x in rows] + [(7, "\n".join([hot] * 3), "again")]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_code_points_not_bytes(spark):
    check(spark, [(i, "é" * 39 + f"\n{'é' * 40}\nx{i}", "s") for i in range(6)])


def test_bitmaps_of_losing_texts_only(spark):
    line = prose(5, 12)
    docs = as_documents(spark, [(i, f"a{i}\n{line}", "s") for i in range(5)] + [(9, "alone", "s")])
    assert {r.doc for r in line_dedup.keep_bitmaps(docs).collect()} == {0, 1, 2, 3}
