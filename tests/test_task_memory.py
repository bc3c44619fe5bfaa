"""Plans whose tasks hold few rows in memory, however large the tables are."""

from __future__ import annotations

import pytest

from headway import catalogue


def plan(df, kind):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.mark.parametrize("name", ["route_lengths", "longest_routes", "service_hours"])
def test_trips_and_stops_meet_as_counts(spark, sf_dir, name):
    """No row is copied for distinct counts, and rows are counted before the union."""
    text = plan(catalogue.QUERIES[name](spark, sf_dir), "optimizedPlan")
    assert "Expand" not in text
    lines = text.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(n for n, line in enumerate(lines) if line.lstrip(" :+-").startswith("Union"))
    parts = [x for x in lines[at + 1:] if depth(x) == depth(lines[at]) + 3]
    assert len(parts) == 2 and all("Aggregate" in x for x in parts)


def test_pairs_are_dealt_to_tasks_by_their_number(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(catalogue, "DISTINCT_ROWS", 7_000, raising=False)
    rows = catalogue.QUERIES["sketched_trips_per_stop"](spark, sf_dir)
    text = plan(rows, "executedPlan")
    # 60,000 stop times; the distinct pairs are made behind the exchange only.
    dealt = [n for n, line in enumerate(text.splitlines()) if "REPARTITION_BY_NUM" in line]
    assert dealt and ", 9)" in text.splitlines()[dealt[0]]
    below = "\n".join(text.splitlines()[dealt[0] + 1:]).partition("Join")[0]
    assert "Aggregate" not in below
