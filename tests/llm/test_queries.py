"""Registered queries over the smallest tables, their oracles, and the pipeline."""

import importlib

import duckdb
import pytest

from headway.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ROWS = {"1": "embeddings", "3": "pages", "6": "pages", "11": "conversations"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in ("documents", "pages", "embeddings", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_table(spark, db, name):
    got = QUERIES[name](spark, SF).toPandas()
    number = name[2:].split("_")[0]
    table = ROWS.get(number, "documents")
    rows = db.sql(f"SELECT count(*) FROM {table}").fetchall()[0][0]
    if number == "1":
        asked = db.sql("SELECT count(*) FROM embeddings WHERE vec_id % 20 = 0").fetchall()[0][0]
        assert len(got) == asked * min(20, rows - 1)
    elif number == "4":
        assert 0 < len(got) < rows
    elif number == "11":
        assert len(got) == db.sql("SELECT count(DISTINCT conv_id) FROM conversations").fetchall()[0][0]
    elif number == "12":
        assert 0 < len(got) <= 2000 * db.sql("SELECT count(DISTINCT lang) FROM documents").fetchall()[0][0]
    else:
        assert len(got) == rows
    if name in ORACLES:
        want = db.sql(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        columns = sorted(got.columns)
        a, b = (sorted(map(str, x[columns].astype(object).where(x[columns].notna(), None).values.tolist())) for x in (got, want))
        assert a == b


def test_pipeline(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = None
    stages = docs
    for name, stage in pipeline.STAGES[:-1]:
        stages = stage(spark, stages, SF).cache()
        assert stages.schema == docs.schema, name
        now = {r.doc_id for r in stages.select("doc_id").collect()}
        assert now and (ids is None or now <= ids), name
        ids = now
    out = pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == ids and len(out) == stages.count()
    assert {r.shard for r in out} <= set(range(24))
