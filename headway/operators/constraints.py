"""Declared data tests compiled to one scan a mart (Q5-Q8).

Each mart is scanned once, whatever number of tests it takes part in.  A row
gives entries (test, key, rows, parents): one for each test on single rows
(nulls, bounds) that it fails, and one for each keyed test (unique,
relationships) with its key, as a row of the tested mart or of the parent.  One
aggregate by (test, key) then holds everything: a key that is there more than
once is not unique, a key without a parent is at fault as often as it is held.
Partial aggregation makes a key that a third of all rows share one row a task,
and rows without a fault add nothing to the tests on single rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.operators import quality


@dataclass(frozen=True)
class Test:
    """One declared test of a column of a model."""

    model: str
    kind: str  # not_null, unique, relationships, delay_bounds
    column: str
    parent: str = ""
    field: str = ""
    severity: str = "error"


def declared(bounds_severity: str = "error") -> list[Test]:
    """The tests of the marts."""
    return [
        *(Test(m, "unique", c) for m, cols in quality.UNIQUE_TESTS.items() for c in cols),
        *(Test(m, "not_null", c) for m, cols in quality.NOT_NULL_TESTS.items() for c in cols),
        *(Test(m, "relationships", c, p, f) for m, c, p, f in quality.RELATIONSHIP_TESTS),
        Test("fct_stop_events", "delay_bounds", "arrival_delay_seconds", severity=bounds_severity),
    ]


def _at_fault(test: Test) -> Column:
    """Whether a row by itself fails the test."""
    c = F.col(test.column)
    if test.kind == "not_null":
        return c.isNull()
    return ((c < quality.DELAY_LOWER_SEC) | (c > quality.DELAY_UPPER_SEC)) & c.isNotNull()


def _row_entry(number: int, key: Column, rows: Column, parents: Column) -> Column:
    return F.struct(F.lit(number).alias("test"), key.alias("key"), rows.cast("long").alias("rows"), parents.cast("long").alias("parents"))


def _model_entries(df: DataFrame, model: str, tests: Sequence[Test]) -> DataFrame:
    """One scan of a mart: partial counts (test, key, rows, parents) of every test it takes part in."""
    none, one = F.lit(0), F.lit(1)
    single, keyed = [], []
    for number, test in enumerate(tests):
        if test.model == model and test.kind in ("not_null", "delay_bounds"):
            single.append((number, _at_fault(test)))
        elif test.model == model:
            keyed.append(_row_entry(number, F.col(test.column).cast("string"), one, none))
        if test.parent == model:
            keyed.append(_row_entry(number, F.col(test.field).cast("string"), none, one))
    # tests on single rows: an entry only where one fails, so that good rows add nothing
    entries = [F.when(bad, _row_entry(number, F.lit(None).cast("string"), one, none)) for number, bad in single]
    every = F.array_compact(F.array(*entries, *[F.when(e["key"].isNotNull(), e) for e in keyed]))
    return df.select(F.explode(every).alias("e")).select("e.*")


def summaries(mart: Callable[[str], DataFrame], tests: Sequence[Test] | None = None) -> DataFrame:
    """One row a test: model, test, column_name, failures, status.

    ``mart`` gives a mart by its name; each that a test names is asked for once."""
    tests = list(tests if tests is not None else declared())
    models = list(dict.fromkeys(m for t in tests for m in (t.model, t.parent) if m))
    entries = quality.union_all([_model_entries(mart(m), m, tests) for m in models])
    keys = entries.groupBy("test", "key").agg(F.sum("rows").alias("rows"), F.sum("parents").alias("parents"))
    kind = F.element_at(F.array(*[F.lit(t.kind) for t in tests]), F.col("test") + 1)
    failing = (
        F.when(kind == "unique", (F.col("rows") > 1).cast("long"))
        .when(kind == "relationships", F.when(F.col("parents") == 0, F.col("rows")).otherwise(0))
        .otherwise(F.col("rows"))
    )
    counted = keys.groupBy("test").agg(F.sum(failing).alias("failures"))
    every = [F.struct(F.lit(k).alias("test"), *[F.lit(getattr(t, f)).alias(f) for f in ("model", "kind", "column", "severity")]) for k, t in enumerate(tests)]
    listed = counted.sparkSession.range(1).select(F.explode(F.array(*every)).alias("t")).select("t.*")
    failures = F.coalesce("failures", F.lit(0)).cast("long")
    fault = F.when(F.col("severity") == "error", "fail").otherwise("warn")
    return listed.join(counted, "test", "left").select(
        "model",
        F.col("kind").alias("test"),
        F.col("column").alias("column_name"),
        failures.alias("failures"),
        F.when(failures > 0, fault).otherwise("pass").alias("status"),
    )


def of_marts(marts: Mapping[str, DataFrame] | object, tests: Sequence[Test] | None = None) -> DataFrame:
    """``summaries`` of a mapping or an object with a mart an attribute."""
    return summaries(marts.__getitem__ if isinstance(marts, Mapping) else lambda m: getattr(marts, m), tests)
