"""Small tables that all stop-time marts are built from.

``stop_times`` is the one table that is really big. Rather than join it to
trips and routes in every mart and count distinct keys over the joined rows
(Spark would copy each row once per distinct count), it is reduced at once:

* ``trip_rollup``: one row per trip; combines on the map side, so stop times in
  trip order, as feeds and the stored staging table have them, shrink before
  their shuffle, and a hot trip is no problem. ``with_routes`` adds the routes.
* ``visit_rollup``: one row per route, stop and hour; one shuffle of (trip,
  stop, hour), then partial sums. Its size is bounded by the network, not by
  the timetable. Visits per route and stop, or per route and hour, come from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import times


def trip_rollup(stop_times: DataFrame) -> DataFrame:
    """trip_id -> first and last valid departure (in text order), served hours
    0-23 as bits, highest stop sequence. NULL where no departure is valid."""
    given = F.col("departure_time")
    prepared = stop_times.select(
        "trip_id",
        "stop_sequence",
        F.when(times.is_service_time(given), given).alias("departure"),
    ).withColumn("hour", times.hour_of(F.col("departure")))
    bit = F.expr("shiftleft(1L, cast(hour as int))")
    return prepared.groupBy("trip_id").agg(
        F.min("departure").alias("first_departure"),
        F.max("departure").alias("last_departure"),
        F.bit_or(F.when(F.col("hour").between(0, 23), bit)).alias("hours"),
        F.max("stop_sequence").alias("max_stop_sequence"),
    )


def runs(trips: DataFrame) -> DataFrame:
    """(trip_id, route_id) -> number of equal trip rows. Repeated rows of a
    trip multiply a number from here on and not the rows of a join."""
    return (
        trips.where("trip_id is not null and route_id is not null")
        .groupBy("trip_id", "route_id")
        .agg(F.count(F.lit(1)).alias("trip_copies"))
    )


def with_routes(trip_rows: DataFrame, trips: DataFrame) -> DataFrame:
    """The trip rollup per (trip_id, route_id), with the number of equal trip
    rows. Trips without stop times or route are left out."""
    return trip_rows.join(runs(trips), "trip_id")


def visits(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """Stop times with the routes of their trips, as ``visit_totals`` adds them up. The
    join is the only one on the big table; AQE splits a hot trip's partition."""
    departure, hour = F.col("departure_time"), F.col("hour_of_day")
    # One step each, so that a time is matched and its hour read once.
    timed = F.coalesce(times.is_service_time(departure), F.lit(False))
    checked = stop_times.select("trip_id", "stop_id", departure, timed.alias("timed"))
    hours = checked.select(
        "trip_id", "stop_id", "timed", F.when(F.col("timed"), times.hour_of(departure)).alias("hour_of_day")
    )
    return (
        hours.withColumn("hour_of_day", F.when(hour.between(0, 23), hour))
        .join(runs(trips), "trip_id")
        .select("route_id", "stop_id", "hour_of_day", "timed", "trip_copies")
    )


def visit_totals(rows: DataFrame) -> DataFrame:
    """The sums of ``visits``, which combine before the shuffle by the keys."""
    return rows.groupBy("route_id", "stop_id", "hour_of_day", "timed").agg(
        F.sum("trip_copies").alias("visits")
    )


def visit_rollup(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """(route_id, stop_id, hour 0-23 or NULL, timed) -> stop visits. ``timed``
    tells whether the departure is a valid time; its hour may be above 23."""
    return visit_totals(visits(stop_times, trips))


def route_stops_of(visits: DataFrame) -> DataFrame:
    """``route_stop_rollup`` from a stored ``visit_rollup``."""
    return visits.groupBy("route_id", "stop_id").agg(
        F.sum("visits").alias("visits"),
        F.sum(F.when(F.col("timed"), F.col("visits")).otherwise(0)).alias("timed_visits"),
    )


def route_hours_of(visits: DataFrame) -> DataFrame:
    """(route_id, hour 0-23) -> stop visits."""
    return (
        visits.where("hour_of_day is not null")
        .groupBy("route_id", "hour_of_day")
        .agg(F.sum("visits").alias("visits"))
    )


def route_stop_rollup(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """(route_id, stop_id) -> stop visits, and visits at a valid time, straight
    from the stop times, with one join as in ``visit_rollup``."""
    timed = F.coalesce(times.is_service_time(F.col("departure_time")), F.lit(False))
    copies = F.col("trip_copies")
    return (
        stop_times.select("trip_id", "stop_id", timed.alias("timed"))
        .join(runs(trips), "trip_id")
        .groupBy("route_id", "stop_id")
        .agg(
            F.sum(copies).alias("visits"),
            F.sum(F.when(F.col("timed"), copies).otherwise(0)).alias("timed_visits"),
        )
    )
