"""Sharding and mixing against sequential computations."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from headway.llm import mixing, sharding
from tests.llm.conftest import as_documents, prose


def check_shards(rows, got, n=24):
    size = lambda t: len((t or "").encode()) + 8
    want = Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < n
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_hold_every_row_once(spark, odd, odd_rows, none):
    check_shards(odd_rows, sharding.byte_prefix_shards(odd).collect())
    assert sharding.byte_prefix_shards(none).collect() == []


def test_shards_are_contiguous_and_near_equal(spark):
    rows = [(i, prose(i, 30 + i % 50), "s") for i in range(400)] + [(1000 + i, prose(9, 60), "s") for i in range(300)]
    got = sharding.byte_prefix_shards(as_documents(spark, rows), shards=8, whole_share=0.0).collect()
    check_shards(rows, got, 8)
    # sequentially: rows in order of the text's MD5, cut where their middles pass the targets
    order = sorted(rows, key=lambda r: (hashlib.md5(r[1].encode()).digest(), r[0]))
    total, before, want = sum(len(r[1]) + 8 for r in rows), 0, {}
    for i, t, _ in order:
        want[i] = min(7, (2 * before + len(t) + 8) * 8 // (2 * total))
        before += len(t) + 8
    assert {r.doc_id: r.shard for r in got} == want
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in got)


def test_small_groups_stay_whole(spark):
    rows = [(10 * g + k, prose(g, 60), "s") for g in range(200) for k in range(3)]
    got = sharding.byte_prefix_shards(as_documents(spark, rows), shards=8, whole_share=0.1).collect()
    check_shards(rows, got, 8)
    shards = defaultdict(set)
    for r in got:
        shards[r.doc_id // 10].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def sequential_mix(rows, share=1.5, limit=2.0):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        stopped = {s for s in open_ if limit * sizes[s] <= level * weight[s]}
        if not stopped:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in stopped:
            target[s] = limit * sizes[s]
            left -= target[s]
        open_ -= stopped
    return sizes, target


@pytest.mark.parametrize("which", ["odd", "many"])
def test_mix_meets_its_targets(spark, odd_rows, which):
    rows = odd_rows if which == "odd" else [(i, prose(i, 5 + i % 90), f"s{i % 7 if i % 3 else 0}") for i in range(500)]
    docs = as_documents(spark, rows)
    got = mixing.budget_prefix_mix(docs).collect()
    assert got and sorted(got, key=str) == sorted(mixing.budget_prefix_mix(docs).collect(), key=str)
    sizes, target = sequential_mix(rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    assert len(got) == len(rows)
    for s in sizes:
        assert taken[s] == pytest.approx(target[s], abs=0.51)


def test_mix_of_nothing(none):
    assert mixing.budget_prefix_mix(none).collect() == []
    assert mixing.mixed_documents(none).collect() == []


def test_mixed_documents_come_as_often_as_taken(spark):
    rows = [(i, prose(i, 40), "ab"[i % 2]) for i in range(60)] + [(99, "", "a")]
    docs = as_documents(spark, rows)
    out = mixing.mixed_documents(docs)
    assert out.schema == docs.schema
    times = Counter(r.doc_id for r in out.collect())
    for r in mixing.budget_prefix_mix(docs).collect():
        if r["size"]:
            assert abs(times[r.doc_id] - r.taken / r["size"]) <= 0.5
    assert 99 not in times
