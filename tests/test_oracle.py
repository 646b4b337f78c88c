"""Every registered query equals its DuckDB oracle on the sf0.001 tables
(row count, column names, order-insensitive value hash) -- the same gate
the driver applies at sf0.01."""

from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_all_queries_match_oracle(spark):
    import __spark_entry__ as entry
    from headway.plans.registry import QUERIES
    from tools.oracle_check import run

    res = run(spark, SF, names=list(QUERIES), verbose=False)  # tests/llm has the others
    sql = entry.oracle_sql()
    assert set(sql) <= set(entry.queries())
    bad = {k: v for k, v in res.items() if k in sql and not (v["schema"] and v["types"] and v["values"] and v["rows"] == v["oracle_rows"])}
    assert bad == {}


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["route_id", "route_short_name", "total_events", "avg_delay_sec", "median_delay_sec", "pct_on_time"]
    assert df.count() > 0
