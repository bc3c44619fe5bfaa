"""Plan properties that matter at scale."""

from __future__ import annotations

import re

import pytest

from headway import catalogue
from plan_rows import rows_read
from pyspark.sql import functions as F

from headway.operators import marts, rollups
from headway.plans import build, event_reports, reports
from headway.sources import samples, tables
from headway.sources.snapshots import Snapshot

SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture()
def settings(spark):
    changed = []

    def apply(values):
        for key, value in values.items():
            spark.conf.set(key, value)
            changed.append(key)

    yield apply
    for key in changed:
        spark.conf.unset(key)


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def executed(df) -> str:
    """The final adaptive plan, after a run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


STREAMS = {n for n in catalogue.QUERIES if n.startswith(("live_", "stream_ingest", "stored_"))}


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - STREAMS))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    df = catalogue.QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_a_hot_trip_is_split(spark, settings, tmp_path):
    """A third of all stop times belong to one trip."""
    # Several input files, as a hot partition is split along map outputs.
    spark.range(0, 600_000, 1, 16).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 9973 as string)) trip_id",
        "cast(id % 5000 as string) stop_id",
        "'07:00:00' departure_time",
    ).write.parquet(f"{tmp_path}/st")
    stop_times = spark.read.parquet(f"{tmp_path}/st")
    trips = stop_times.selectExpr("trip_id", "concat('r', trip_id) route_id").distinct()
    settings(SMALL_SKEW)
    visits = rollups.route_stop_rollup(stop_times, trips)
    assert "skew=true" in executed(visits)
    hot = visits.where("route_id = 'rhot'").selectExpr("count(*) n", "sum(visits) v").first()
    assert (hot.n, hot.v) == (5000, 200_000)


def test_trip_rollup_combines_before_its_shuffle(spark, sf_dir):
    plan = rollups.trip_rollup(samples.network(spark, sf_dir).stop_times)
    text = plan._jdf.queryExecution().executedPlan().toString()
    above, below = text.split("Exchange hashpartitioning(trip_id", 1)
    assert "partial_min" in below and "partial_bit_or" in below


def test_marts_read_only_the_columns_they_need(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    build.build_staging(spark, samples.raw_feed(spark, sf_dir), root)
    net = build.stored_network(spark, root, with_rollups=False)
    text = executed(rollups.route_stop_rollup(net.stop_times, net.trips))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert "trip_id:string,stop_id:string,departure_time:string" in schemas
    assert "trip_id:string,route_id:string" in schemas
    one_stop = tables.load(spark, root, "stg_stop_times").where("stop_id = '7'")
    assert "EqualTo(stop_id,7)" in executed(one_stop)


def test_stream_kpis_do_not_copy_event_rows(spark, sf_dir):
    """The distinct counts expand the few (line, station) rows only."""
    text = optimized(event_reports.stream_kpis(samples.rail_events(spark, sf_dir)))
    expand = text.index("Expand")
    assert "Aggregate [line" in text[expand:]


def test_hub_names_are_limited_before_the_shuffle(spark, sf_dir):
    df = catalogue.QUERIES["transfer_hubs"](spark, sf_dir)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_stored_order_shrinks_the_trip_rollup(spark, tmp_path):
    """From the stored staging table the map side sends about a row per trip."""
    stop_times = spark.range(60000).selectExpr(
        "concat('t', id % 2000) trip_id", "concat('s', id % 997) stop_id",
        "cast(id div 2000 as bigint) stop_sequence", "'07:00:00' arrival_time",
        "'07:00:00' departure_time",
    )
    root = str(tmp_path)
    tables.save(
        stop_times.repartitionByRange(16, *build.TRIP_ORDER).sortWithinPartitions(*build.TRIP_ORDER),
        root, "stg_stop_times",
    )
    stored = tables.load(spark, root, "stg_stop_times")
    sent = stored.select("trip_id", F.spark_partition_id().alias("p")).distinct().count()
    assert sent < 2 * 2000
    assert build.STAGING_CLUSTERS["stg_stop_times"] == build.TRIP_ORDER


def test_stored_marts_do_not_read_trips_or_stop_times(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    build.build_staging(spark, samples.raw_feed(spark, sf_dir), root)
    build.build_rollups(spark, root)
    net = build.stored_network(spark, root)
    results = [
        marts.route_service_hours(net), marts.service_frequency(net), marts.longest_routes(net),
        marts.early_night_routes(net), reports.departures_by_hour_of_mode(net, 3),
    ]
    for df in results:
        text = optimized(df) + "".join(df.inputFiles())
        assert "stg_stop_times" not in text and "stg_trips" not in text


def scans(plan: str, column: str) -> int:
    return len(re.findall(rf"FileScan parquet [^\n]*{column}", plan))


def test_stored_trajectories_read_times_after_their_ranges_are_sampled(spark, sf_dir, tmp_path):
    """The sample runs all that lies below the range exchange a second time."""
    saved = {}

    class Kept:
        def save(self, df, name, by=()):
            saved[name] = df
            return 0

    net = samples.network(spark, sf_dir)
    build.save_mart(Kept(), marts.trip_trajectories(net), "mart_trip_trajectories")
    stored = saved["mart_trip_trajectories"]
    above, below = optimized(stored).split("RepartitionByExpression")
    assert "departure_timestamp_ms" in above and "departure_timestamp_ms" not in below
    assert stored.columns == marts.trip_trajectories(net).columns
    assert stored.exceptAll(marts.trip_trajectories(net)).isEmpty()


def test_visits_match_a_time_once(spark):
    stop_times = spark.createDataFrame(
        [("t", "s", t) for t in ("07:05:00", "24:00:00", "7:5", "x", None, "99999999999999:00:00")],
        "trip_id string, stop_id string, departure_time string",
    )
    trips = spark.createDataFrame([("t", "r")], "trip_id string, route_id string")
    rows = rollups.visits(stop_times, trips)
    assert optimized(rows).count("RLIKE") == 1
    found = sorted((r.hour_of_day if r.hour_of_day is not None else -1, r.timed) for r in rows.collect())
    assert found == [(-1, False)] * 3 + [(-1, True)] * 2 + [(7, True)]


def test_the_heatmap_makes_the_trip_rollup_once(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    build.build_staging(spark, samples.raw_feed(spark, sf_dir), root)
    net = build.stored_network(spark, root, with_rollups=False)
    plan = executed(reports.frequency_heatmap(reports.hourly_frequency_of(net)))
    plan = plan.partition("== Initial Plan ==")[0]
    assert scans(plan, "departure_time") == 1
    assert "ReusedExchange" in plan
    by_marts = reports.hourly_frequency(marts.service_frequency(net), marts.route_service_hours(net))
    assert sorted(by_marts.collect()) == sorted(reports.hourly_frequency_of(net).collect())


def test_the_stored_heatmap_reads_ten_routes(spark, tmp_path):
    """Rows that the scan of the frequencies returns, of 300 routes with 24 hours."""
    hours = spark.range(24).selectExpr("id hour_of_day")
    routes = spark.range(300).selectExpr(
        "if(id = 0, '', concat('R', id)) route_short_name", "'x' route_long_name", "3L route_type",
        "id + 1 total_trips", "'05:00:00' first_departure", "'06:00:00' last_departure", "1L total_stops",
    )
    frequency = routes.crossJoin(hours).selectExpr(
        "route_short_name", "route_type", "hour_of_day", "total_trips trips_per_hour"
    )
    root = str(tmp_path)
    tables_at = Snapshot(spark, root)
    assert build.save_mart(tables_at, frequency, "mart_service_frequency") == 7200
    build.save_mart(tables_at, routes, "mart_route_service_hours")
    tables_at.commit()
    stored = tables.load(spark, root, "mart_service_frequency")
    assert sorted(stored.drop(tables.PART_OF).select(*frequency.columns).collect()) == sorted(frequency.collect())
    found = reports.hourly_frequency(stored, tables.load(spark, root, "mart_route_service_hours"))
    assert "dynamicpruning" in executed(found)
    assert sorted(found.collect()) == sorted(
        reports.hourly_frequency(frequency, routes).collect()
    )
    top_parts = {
        r[0] for r in routes.orderBy("total_trips", ascending=False).limit(10)
        .select(tables.part_of("route_short_name")).collect()
    }
    wanted = routes.where(tables.part_of("route_short_name").isin(top_parts)).count() * 24
    assert rows_read(found, "key_part") == wanted < 7200 / 10
