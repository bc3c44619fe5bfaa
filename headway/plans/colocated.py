"""Stop times and trips laid out together, so that rollups join them where they lie.

Both are stored in the same number of buckets by trip, in catalog tables. A bucket is one task, so a
trip with very many stop times would make one task long; such trips are found first and
kept, with their stop times, in tables without buckets, where the join may split them. A trip
is in one of the two layouts, so results of both add up.

Use it where the layout is read more often than written: it costs one shuffle of
the stop times, which each rollup then saves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headway.operators import marts, rollups
from headway.plans import build
from headway.sources import tables
from headway.sources.snapshots import Snapshot

#: Stop times of a trip from which on it is kept out of the buckets.
HOT_ROWS = 1_000_000
#: Stop times of a bucket, about; more of them make more buckets.
BUCKET_ROWS = 1_000_000


@dataclass(frozen=True)
class Layout:
    """Names of the bucketed catalog tables, and the root of the others."""

    stop_times: str
    trips: str
    trajectories: str
    root: str
    buckets: int

    HOT_STOP_TIMES = "hot_stop_times"
    HOT_TRIPS = "hot_trips"
    HOT_TRAJECTORIES = "hot_trajectories"


def save(
    stop_times: DataFrame, trips: DataFrame, root: str, prefix: str, buckets: int,
    hot_rows: int = HOT_ROWS,
) -> Layout:
    """Stores both tables below ``root``; the bucketed ones are named ``prefix_...``.

    There are at most as many hot trips as stop times divided by ``hot_rows``. A bucket is
    a task, so there are more than ``buckets`` of them if these would hold more than
    ``BUCKET_ROWS`` stop times each.
    """
    names = [f"{prefix}_{table}" for table in ("stop_times", "trips", "trajectories")]
    others = Snapshot(stop_times.sparkSession, root)
    counts = stop_times.groupBy("trip_id").agg(F.count(F.lit(1)).alias("n"))
    seen = Observation(f"{prefix} stop times")
    counted = counts.observe(seen, F.sum("n").alias("rows"))
    others.save(counted.where(F.col("n") >= hot_rows).select("trip_id"), "hot")
    buckets = max(buckets, -(-(seen.get["rows"] or 0) // BUCKET_ROWS))
    layout = Layout(*names, root, buckets)
    hot = others.load("hot")
    # In the order of all columns, so that one trip is many files.
    hot_times = stop_times.join(hot, "trip_id", "left_semi")
    others.save(tables.clustered(hot_times, *stop_times.columns), Layout.HOT_STOP_TIMES)
    others.save(trips.join(hot, "trip_id", "left_semi"), Layout.HOT_TRIPS)
    others.commit()
    for df, name in ((stop_times, layout.stop_times), (trips, layout.trips)):
        cold = df.join(hot, "trip_id", "left_anti")
        tables.save_bucketed(cold, name, buckets, "trip_id", path=f"{root}/{name}")
    return layout


def _each(spark: SparkSession, layout: Layout) -> list[tuple[DataFrame, DataFrame]]:
    """(stop times, trips) in buckets, and of hot trips."""
    others = Snapshot(spark, layout.root)
    return [
        (spark.table(layout.stop_times), spark.table(layout.trips)),
        (others.load(Layout.HOT_STOP_TIMES), others.load(Layout.HOT_TRIPS)),
    ]


def trip_rollup(spark: SparkSession, layout: Layout) -> DataFrame:
    """``rollups.trip_rollup``: no shuffle of bucketed stop times."""
    cold, hot = (rollups.trip_rollup(stop_times) for stop_times, _ in _each(spark, layout))
    return cold.unionAll(hot)


def visit_rollup(spark: SparkSession, layout: Layout) -> DataFrame:
    """``rollups.visit_rollup``: bucketed stop times meet their trips in place, and only
    their partial sums are shuffled. Both layouts are added up at once, as a task would
    hold its keys again for each sum of sums."""
    cold, hot = (rollups.visits(*each) for each in _each(spark, layout))
    return rollups.visit_totals(cold.unionAll(hot))


def trip_trajectories(
    spark: SparkSession, layout: Layout, routes: DataFrame, stops: DataFrame
) -> list[DataFrame]:
    """``marts.trip_trajectories`` of trips in buckets, and of hot trips. Bucketed stop times
    meet their trips in place; only stops too many to broadcast make them move."""
    return [
        marts.trip_trajectories(marts.Network(times, trips, routes, stops))
        for times, trips in _each(spark, layout)
    ]


def save_trajectories(
    spark: SparkSession, layout: Layout, routes: DataFrame, stops: DataFrame
) -> None:
    """Stores the trajectories in the buckets of their trips, each bucket in trip order, and
    those of hot trips by ranges of the same order."""
    cold, hot = trip_trajectories(spark, layout, routes, stops)
    name = layout.trajectories
    tables.save_bucketed(
        cold, name, layout.buckets, "trip_id", path=f"{layout.root}/{name}", order=build.TRIP_ORDER
    )
    others = Snapshot(spark, layout.root)
    others.save(tables.clustered(hot, *build.TRIP_ORDER), Layout.HOT_TRAJECTORIES)
    others.commit()


def trajectories(spark: SparkSession, layout: Layout) -> DataFrame:
    """The stored trajectories; a filter on trips reads their buckets only."""
    hot = Snapshot(spark, layout.root).load(Layout.HOT_TRAJECTORIES)
    return spark.table(layout.trajectories).unionAll(hot)
