"""The command line drives build, query, check and publish over a landing zone."""

from __future__ import annotations

from headway.__main__ import main
from headway.operators import quality


def test_cli_build_query_check_publish(spark, golden_root, tmp_path, capsys):
    wh = str(tmp_path / "wh")
    assert main(["build", "--root", golden_root, "--out", wh]) == 0
    assert main(["query", "--warehouse", wh, "total_stop_events"]) == 0
    assert capsys.readouterr().out.split()[-1] == "4"
    # hours after the last poll, and eleven days after: found whatever its age
    for now, status in (("2031-03-12T09:20:00+00:00", 0), ("2031-03-12T11:20:00+00:00", 1), ("2031-03-23T18:00:00+00:00", 1)):
        assert main(["check", "--root", golden_root, "--warehouse", wh, "--now", now]) == status
        out = capsys.readouterr().out
        assert ("stale" in out) == bool(status) and "ready" in out and "no_data" not in out
    assert main(["check", "--root", golden_root, "--warehouse", str(tmp_path / "none"), "--now", "2031-03-12T09:20:00+00:00"]) == 1
    assert "missing" in capsys.readouterr().out
    assert main(["publish", "--warehouse", wh, "--target", str(tmp_path / "pub")]) == 0
    got = {r.table_name: r.status for r in quality.readiness_of_root(spark, wh, ["fct_stop_events", "nope"]).collect()}
    assert got == {"fct_stop_events": "ready", "nope": "missing"}


def test_approx_median_option(golden):
    from headway.operators import analytics

    rows = analytics.punctuality_by_route(golden.fct_stop_events, golden.dim_routes, median="approx").collect()
    assert {r.route_id: r.median_delay_sec for r in rows} == {"N2": 400.0, "L7": 0.0}
