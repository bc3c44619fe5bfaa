from __future__ import annotations

import re

import pytest

from plan_rows import rows_read

from headway.operators import marts, rollups
from headway.plans import colocated
from headway.sources.snapshots import Snapshot


@pytest.fixture()
def layout(spark, tmp_path):
    """A trip with a third of all stop times, and others; some trips twice or without times."""
    stop_times = spark.range(6000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('t', id % 500)) trip_id", "concat('s', id % 37) stop_id",
        "id stop_sequence", "'x' arrival_time",
        "if(id % 11 = 0, null, format_string('%02d:00:00', id % 26)) departure_time",
    )
    trips = spark.range(1100).selectExpr(
        "if(id = 7, 'hot', concat('t', id % 600)) trip_id", "concat('r', id % 9) route_id", "'a' service_id"
    )
    # Small rows would all be put into one file.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    made = colocated.save(stop_times, trips, str(tmp_path), f"near_{tmp_path.name}".lower(), 4, hot_rows=1000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    yield stop_times, trips, made
    for name in (made.stop_times, made.trips):
        spark.sql(f"drop table {name}")


def same(a, b):
    a = a.select(*b.columns)
    assert a.count() == b.count() and a.exceptAll(b).isEmpty()


def test_rollups_equal_those_of_any_layout(spark, layout):
    stop_times, trips, made = layout
    same(colocated.trip_rollup(spark, made), rollups.trip_rollup(stop_times))
    same(colocated.visit_rollup(spark, made), rollups.visit_rollup(stop_times, trips))


def test_bucketed_rows_are_not_shuffled(spark, layout):
    _, _, made = layout
    cold_times, cold_trips = colocated._each(spark, made)[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        trip_plan = rollups.trip_rollup(cold_times)._jdf.queryExecution().executedPlan().toString()
        visit_plan = rollups.visit_rollup(cold_times, cold_trips)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in trip_plan
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", visit_plan)
    assert len(exchanges) == 1 and exchanges[0].startswith("route_id")
    assert "SortMergeJoin" in visit_plan.split("Exchange")[1]


def test_visits_of_both_layouts_are_added_up_once(spark, layout):
    """A task holds its keys in one partial and one final sum, not in sums of sums."""
    _, _, made = layout
    plan = colocated.visit_rollup(spark, made)._jdf.queryExecution().executedPlan().toString()
    sums = re.findall(r"HashAggregate\(keys=\[route_id#\w+, stop_id#[^\n]*", plan)
    assert len(sums) == 2 and len(re.findall(r"Exchange hashpartitioning\(route_id", plan)) == 1
    above, below = plan.split("Exchange hashpartitioning(route_id")
    assert "Union" in below and "partial_sum" in below and "Union" not in above


def test_a_hot_trip_is_kept_out_and_split(spark, layout):
    _, _, made = layout
    hot = Snapshot(spark, made.root)
    assert [r.trip_id for r in hot.load("hot").collect()] == ["hot"]
    stored = hot.load(made.HOT_STOP_TIMES)
    assert stored.count() == 2000 and len(stored.inputFiles()) > 1
    assert spark.table(made.stop_times).where("trip_id = 'hot'").isEmpty()


def test_more_rows_make_more_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(colocated, "BUCKET_ROWS", 100)
    stop_times = spark.range(1150).selectExpr(
        "concat('t', id % 300) trip_id", "concat('s', id % 37) stop_id", "id stop_sequence",
        "'x' arrival_time", "format_string('%02d:00:00', id % 26) departure_time",
    )
    trips = spark.range(300).selectExpr("concat('t', id) trip_id", "concat('r', id % 9) route_id", "'a' service_id")
    made = colocated.save(stop_times, trips, str(tmp_path), f"more_{tmp_path.name}".lower(), 4)
    try:
        assert made.buckets == 12
        # Some buckets of so few trips may be empty.
        assert 6 < len(spark.table(made.stop_times).inputFiles()) <= 12
        same(colocated.visit_rollup(spark, made), rollups.visit_rollup(stop_times, trips))
    finally:
        for name in (made.stop_times, made.trips):
            spark.sql(f"drop table {name}")


PLACES = "stop_id string, stop_name string, latitude double, longitude double"
NAMES = "route_id string, route_short_name string, route_long_name string, route_type bigint"


@pytest.fixture()
def places(spark):
    """Routes and stops; a stop without place, one twice, one route twice."""
    stops = [(f"s{i}", f"Stop {i}", None if i == 5 else 22.0 + i, 114.0) for i in [*range(30), 3]]
    routes = [(f"r{i}", f"{i}", f"Route {i}", 3) for i in [*range(8), 2]]
    return spark.createDataFrame(routes, NAMES), spark.createDataFrame(stops, PLACES)


def test_trajectories_equal_those_of_any_layout(spark, layout, places):
    stop_times, trips, made = layout
    routes, stops = places
    try:
        colocated.save_trajectories(spark, made, routes, stops)
        stored = colocated.trajectories(spark, made)
        same(stored, marts.trip_trajectories(marts.Network(stop_times, trips, routes, stops)))
        assert spark.table(made.trajectories).where("trip_id = 'hot'").isEmpty()
        one = spark.table(made.trajectories).where("trip_id = 't4'")
        assert not one.isEmpty()
        # One bucket of four.
        assert rows_read(one, "trip_id") < spark.table(made.trajectories).count() / 2
    finally:
        spark.sql(f"drop table if exists {made.trajectories}")


def test_only_large_stops_move_the_stop_times(spark, layout, places):
    _, _, made = layout
    cold, _ = colocated.trip_trajectories(spark, made, *places)
    small = cold.repartition(made.buckets, "trip_id")
    small.collect()
    plan = small._jdf.queryExecution().executedPlan().toString()
    # Trips and routes may move; the branch of the stop times holds no exchange.
    stop_times = [p for p in plan.split("Exchange") if "departure_time" in p.splitlines()[0]]
    assert "BroadcastHashJoin" in plan and stop_times == []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cold, _ = colocated.trip_trajectories(spark, made, *places)
        plan = cold._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # With all sides large: trips by route and by trip, routes, the stop times by stop, and stops.
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(keys) == ["route_id", "route_id", "stop_id", "stop_id", "trip_id"]
