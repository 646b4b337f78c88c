"""Commits of several tables: all or nothing, for readers too."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from headway.plans import generations as gn


def table(spark, value, rows=20):
    return spark.range(rows).withColumn("value", F.lit(value))


def seen(store):
    return [None if t is None else {r.value for r in t.collect()} for t in store.read("a", "b")]


def test_tables_change_together(spark, tmp_path):
    store = gn.Generations(spark, str(tmp_path / "w"))
    assert store.current() == {} and store.read("a", "b") == [None, None]
    assert store.commit({"a": table(spark, 1), "b": lambda: table(spark, 1, 5)}) == {"a": 20, "b": 5}
    old = store.read("a", "b")
    store.commit({"a": table(spark, 2), "b": table(spark, 2)})
    assert seen(store) == [{2}, {2}]
    assert [{r.value for r in t.collect()} for t in old] == [{1}, {1}]  # a reader keeps what it has begun with
    store.commit({"b": table(spark, 3)}, partitions={"b": ("value",)})
    assert seen(store) == [{2}, {3}]


def test_a_write_that_fails_half_way_changes_nothing(spark, tmp_path):
    store = gn.Generations(spark, str(tmp_path / "w"))
    store.commit({"a": table(spark, 1), "b": table(spark, 1)})
    dies = table(spark, 2, 1000).withColumn("x", F.when(F.col("id") == 700, F.raise_error(F.lit("half-way"))))
    with pytest.raises(Exception, match="half-way"):
        store.commit({"a": table(spark, 2), "b": dies})
    assert seen(store) == [{1}, {1}]
    assert store.reclaim() >= 1  # what the failed commit had written
    assert seen(store) == [{1}, {1}]


def test_a_pointer_that_cannot_be_written_changes_nothing(spark, tmp_path, monkeypatch):
    store = gn.Generations(spark, str(tmp_path / "w"))
    store.commit({"a": table(spark, 1), "b": table(spark, 1)})

    def broken(*args):
        raise OSError("gone")

    monkeypatch.setattr(store.files, "write_line", broken)
    with pytest.raises(OSError):
        store.commit({"a": table(spark, 2), "b": table(spark, 2)})
    assert seen(store) == [{1}, {1}]


def test_a_commit_in_between_is_noticed(spark, tmp_path):
    store = gn.Generations(spark, str(tmp_path / "w"))

    def meanwhile():
        store.commit({"a": table(spark, 9), "b": table(spark, 9)})
        return table(spark, 2)

    with pytest.raises(RuntimeError, match="another commit"):
        store.commit({"a": meanwhile})
    assert seen(store) == [{9}, {9}]


def test_marts_are_reclaimed(spark, golden, tmp_path):
    root = str(tmp_path / "marts")
    assert gn.read_marts(spark, root) is None
    for _ in range(2):
        rows = gn.commit_marts(golden, root)
    assert rows["fct_stop_events"] == 4
    assert gn.Generations(spark, root).reclaim() == 4
    assert all(len(os.listdir(f"{root}/{t}")) == 1 for t in gn.MART_TABLES)
    assert gn.read_marts(spark, root).total_stop_events().first()[0] == 4
