"""Scale guards: properties of the physical plans that must not regress."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

from headway.plans.warehouse import Marts, Warehouse


def _plan(df, mode="simple") -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_fact_plan_has_no_nested_loop_and_partial_dedup(golden):
    for form in ("resolved", "range"):
        plan = _plan(Warehouse(golden.raw, fact_form=form).fct_stop_events)
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
        # WindowGroupLimit appears both below and above the dedup exchange.
        lines = [ln for ln in plan.splitlines() if "WindowGroupLimit" in ln or "Exchange hashpartitioning(service_date" in ln]
        kinds = ["limit" if "WindowGroupLimit" in ln else "exchange" for ln in lines]
        assert kinds.count("limit") == 2 and "exchange" in kinds
        assert kinds.index("exchange") < len(kinds) - 1  # a limit sits below the exchange


def test_status_filter_reaches_parquet_scan(golden):
    plan = _plan(golden.stg_trip_updates)
    assert "PushedFilters: [IsNotNull(schedule_relationship), EqualTo(schedule_relationship,0)]" in plan


def test_aggregates_combine_before_shuffle(golden):
    plan = _plan(Marts.of(golden).punctuality_by_route())
    assert "partial_percentile" in plan and "partial_avg" in plan
    # The dimension joins the aggregated result, not the raw fact.
    join_line = next(i for i, ln in enumerate(plan.splitlines()) if "Join" in ln and "route_id" in ln and "LeftOuter" in ln)
    below = "\n".join(plan.splitlines()[join_line:])
    assert "percentile" in below


def test_versions_are_attached_by_date_to_reduced_observations(golden):
    plan = _plan(golden.fct_stop_events)
    assert "BroadcastHashJoin [service_date" in plan
    lines = plan.splitlines()
    join = next(i for i, ln in enumerate(lines) if "BroadcastHashJoin [service_date" in ln)
    dedup = next(i for i, ln in enumerate(lines) if "Exchange hashpartitioning(service_date" in ln)
    assert join < dedup  # plans print the last step first
