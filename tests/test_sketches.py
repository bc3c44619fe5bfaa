from __future__ import annotations

import random

from headway.operators import sketches
from headway.plans import build
from headway.sources import samples, tables


def test_small_groups_are_exact_and_sketches_merge(spark):
    rows = [("t1", "s1", 1, None, "07:00:00"), ("t1", "s2", 2, None, "07:10:00"), ("t2", "s1", 1, None, "08:00:00"),
            ("t3", "s1", 1, None, None), ("t9", "s1", 1, None, "09:00:00")]
    stop_times = spark.createDataFrame(
        rows, "trip_id string, stop_id string, stop_sequence long, arrival_time string, departure_time string"
    )
    trips = spark.createDataFrame(
        [("t1", "r1", "a"), ("t1", "r1", "a"), ("t2", "r1", "a"), ("t3", "r2", "a")],
        "trip_id string, route_id string, service_id string",
    )
    stored = sketches.visit_sketches(stop_times, trips)
    assert {tuple(r)[:4] for r in stored.collect()} == {
        ("r1", "s1", 7, 2), ("r1", "s2", 7, 2), ("r1", "s1", 8, 1)
    }
    assert {tuple(r) for r in sketches.approx_trips(stored, "hour_of_day").collect()} == {(7, 1), (8, 1)}
    assert sketches.approx_trips(stored).first()[0] == 2
    assert {tuple(r) for r in sketches.approx_departure(stored, "stop_id", share=1.0).collect()} == {
        ("s1", 8 * 3600), ("s2", 7 * 3600 + 600)
    }


def test_errors_are_as_stated(spark):
    draw = random.Random(3)
    rows = [(f"t{draw.randrange(30_000)}", f"s{n % 5}", f"{n % 20:02d}:{draw.randrange(60):02d}:00") for n in range(60_000)]
    stop_times = spark.createDataFrame(rows, "trip_id string, stop_id string, departure_time string")
    trips = spark.range(30_000).selectExpr("concat('t', id) trip_id", "concat('r', id % 3) route_id")
    stored = sketches.visit_sketches(stop_times, trips)
    exact = {k: len({t for t, s, _ in rows if s == k}) for k in {r[1] for r in rows}}
    for stop, trips_found in sketches.approx_trips(stored, "stop_id").collect():
        assert abs(trips_found - exact[stop]) <= sketches.DISTINCT_ERROR * exact[stop]
    seconds = sorted(int(d[:2]) * 3600 + int(d[3:5]) * 60 for _, _, d in rows)
    middle = sketches.approx_departure(stored).first()[0]
    below = sum(s < middle for s in seconds) / len(seconds)
    upto = sum(s <= middle for s in seconds) / len(seconds)
    assert below - sketches.RANK_ERROR <= 0.5 <= upto + sketches.RANK_ERROR


def test_reports_read_the_stored_sketches_only(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    build.build_staging(spark, samples.raw_feed(spark, sf_dir), root)
    assert build.build_sketches(spark, root) > 0
    stored = tables.load(spark, root, build.SKETCHES)
    report = sketches.approx_trips(stored, "route_id")
    assert report.count() > 0 and all(build.SKETCHES in f for f in report.inputFiles())
