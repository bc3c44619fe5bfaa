"""The ten marts.

Results are unordered; a stored table keeps no order, so reports sort when
they read. ``Network`` gives every mart its inputs from the staging tables
and, where they are stored, from the rollups.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.functions import times
from headway.operators import rollups

ROUTE_GROUP = ("route_short_name", "route_long_name", "route_type")
HUB_MIN_ROUTES = 3
HUB_NAMES_SHOWN = 10
LONGEST_KEPT = 20


@dataclass
class Network:
    """Staging tables of one feed; stored rollups replace computed ones."""

    stop_times: DataFrame | None = None
    trips: DataFrame | None = None
    routes: DataFrame | None = None
    stops: DataFrame | None = None
    calendar: DataFrame | None = None
    stored_route_trips: DataFrame | None = None
    stored_route_stop_rollup: DataFrame | None = None
    stored_route_hours: DataFrame | None = None

    @cached_property
    def route_trips(self) -> DataFrame:
        """The trip rollup with the routes of the trips."""
        if self.stored_route_trips is not None:
            return self.stored_route_trips
        return rollups.with_routes(rollups.trip_rollup(self.stop_times), self.trips)

    @cached_property
    def route_stop_rollup(self) -> DataFrame:
        if self.stored_route_stop_rollup is not None:
            return self.stored_route_stop_rollup
        return rollups.route_stop_rollup(self.stop_times, self.trips)

    @cached_property
    def runs(self) -> DataFrame:
        return rollups.runs(self.trips)

    def route_groups(self, *group: str) -> DataFrame:
        """(route_id, group columns), each once, with the number of equal rows."""
        return (
            self.routes.where("route_id is not null")
            .groupBy("route_id", *group)
            .agg(F.count(F.lit(1)).alias("route_copies"))
        )

    def trip_groups(self, *group: str) -> DataFrame:
        """(trip_id, group columns of its route) with the number of matching
        trip and route rows.

        Repeated rows are counted first, so that no join multiplies them. That
        costs a shuffle of trips, which are few next to stop times, and as the
        join by trip then has a plain shuffle on both sides, AQE can split a
        hot trip.
        """
        copies = F.col("trip_copies") * F.col("route_copies")
        return self.runs.join(self.route_groups(*group), "route_id").select(
            "trip_id", *group, copies.alias("copies")
        )

    def trips_in_groups(self, group: tuple[str, ...], *measures: str) -> DataFrame:
        """Measures of the trip rollup with the group columns of the trip's
        route, each trip once per group (staging does not promise unique trip
        or route ids). Without stored rollups the rows are joined by trip last,
        which leaves them partitioned for the distinct."""
        if self.stored_route_trips is None:
            named = self.trip_groups(*group).select("trip_id", *group)
            rows = rollups.trip_rollup(self.stop_times).select("trip_id", *measures)
            return rows.join(named, "trip_id").distinct()
        named = self.route_groups(*group).drop("route_copies")
        rows = self.route_trips.select("trip_id", "route_id", *measures)
        return rows.join(named, "route_id").drop("route_id").distinct()

    def stops_in_groups(self, group: tuple[str, ...], timed: bool) -> DataFrame:
        """Distinct (group columns, stop_id); with ``timed`` only of visits at
        a valid time. Without a stored rollup the pairs come straight from the
        stop times, one shuffle less than through it."""
        if self.stored_route_stop_rollup is not None:
            visits = self.route_stop_rollup.join(self.route_groups(*group), "route_id")
            kept = visits.where("timed_visits > 0") if timed else visits
        else:
            visits = self.stop_times
            if timed:
                visits = visits.where(times.is_service_time(F.col("departure_time")))
            kept = visits.select("trip_id", "stop_id").join(self.trip_groups(*group), "trip_id")
        return kept.select(*group, "stop_id").distinct()

    def departures_per_stop(self) -> DataFrame:
        """stop_id -> stop visits and the lowest mode code."""
        if self.stored_route_stop_rollup is not None:
            visits = self.route_stop_rollup.join(self.route_groups("route_type"), "route_id")
            number = F.col("visits") * F.col("route_copies")
        else:
            visits = self.stop_times.select("trip_id", "stop_id").join(
                self.trip_groups("route_type"), "trip_id"
            )
            number = F.col("copies")
        return visits.groupBy("stop_id").agg(
            F.sum(number).alias("visits"), F.min("route_type").alias("route_type")
        )


def _with_stop(net: Network, per_stop: DataFrame) -> DataFrame:
    """Adds name and coordinates; ``copies`` counts equal stop rows."""
    places = net.stops.groupBy("stop_id", "stop_name", "latitude", "longitude").agg(
        F.count(F.lit(1)).alias("copies")
    )
    return per_stop.join(places, "stop_id")


def stops_ranked(net: Network) -> DataFrame:
    """Stop -> departures, and one of its modes (the lowest code, so that the
    choice is repeatable)."""
    return _with_stop(net, net.departures_per_stop()).select(
        "stop_id",
        "stop_name",
        "latitude",
        "longitude",
        (F.col("visits") * F.col("copies")).alias("total_departures"),
        "route_type",
    )


def trips_by(net: Network, *group: str) -> DataFrame:
    """Trips per group of routes. Trips are counted per route before the join,
    so a route with very many trips joins as one row."""
    per_route = net.trips.groupBy("route_id").agg(F.count("trip_id").alias("trips"))
    return (
        per_route.join(net.route_groups(*group), "route_id")
        .groupBy(*group)
        .agg(F.sum(F.col("trips") * F.col("route_copies")).alias("total_trips"))
    )


def trips_per_route(net: Network) -> DataFrame:
    return trips_by(net, "route_short_name", "route_long_name")


def peak_hour_analysis(net: Network, strict: bool = True) -> DataFrame:
    """Hour -> stop visits. No check of the time's format: hours from 24 on
    are kept, and malformed times fail the query (``strict=False`` drops
    them)."""
    hours = net.stop_times.where("departure_time is not null").select(
        times.hour_of(F.col("departure_time"), strict).alias("hour_of_day"), "trip_id"
    )
    if not strict:
        hours = hours.where("hour_of_day is not null")
    return hours.groupBy("hour_of_day").agg(F.count("trip_id").alias("total_trips"))


def route_service_hours(net: Network) -> DataFrame:
    """Route -> first and last departure (in text order), trips and stops."""
    trips = (
        net.trips_in_groups(ROUTE_GROUP, "first_departure", "last_departure")
        .where("first_departure is not null")
    )
    # Text needs a sort to be aggregated, so the many stops are counted apart first.
    spans = trips.groupBy(*ROUTE_GROUP).agg(
        F.min("first_departure").alias("first_departure"),
        F.max("last_departure").alias("last_departure"),
        F.count(F.lit(1)).alias("trips"),
    )
    stops = net.stops_in_groups(ROUTE_GROUP, timed=True).groupBy(*ROUTE_GROUP).agg(
        F.count(F.lit(1)).alias("stops")
    )
    return (
        spans.unionByName(stops, allowMissingColumns=True)
        .groupBy(*ROUTE_GROUP)
        .agg(
            F.min("first_departure").alias("first_departure"),
            F.max("last_departure").alias("last_departure"),
            F.coalesce(F.sum("trips"), F.lit(0)).alias("total_trips"),
            F.coalesce(F.sum("stops"), F.lit(0)).alias("total_stops"),
        )
    )


FREQUENCY_GROUP = ("route_short_name", "route_type")


def trips_per_hour(trips: DataFrame, *group: str) -> DataFrame:
    """(group columns, hour 0-23) -> rows of ``trips`` that depart in that hour, by the
    bits of their ``hours``."""
    counts = trips.where("hours is not null").groupBy(*group).agg(
        *[F.sum(F.expr(f"bit_get(hours, {h})").cast("bigint")).alias(f"h{h}") for h in range(24)]
    )
    per_hour = F.array(*[
        F.struct(F.lit(h).cast("bigint").alias("hour_of_day"), F.col(f"h{h}").alias("trips_per_hour"))
        for h in range(24)
    ])
    return counts.select(*group, F.inline(per_hour)).where("trips_per_hour > 0")


def service_frequency(net: Network) -> DataFrame:
    """(route short name, mode, hour 0-23) -> trips that depart in that hour."""
    return trips_per_hour(net.trips_in_groups(FREQUENCY_GROUP, "hours"), *FREQUENCY_GROUP)


def transfer_hubs(
    net: Network, min_routes: int = HUB_MIN_ROUTES, names: int = HUB_NAMES_SHOWN
) -> DataFrame:
    """Stops with coordinates that at least ``min_routes`` routes serve, with
    the first ``names`` route names in text order."""
    served = net.route_stop_rollup.join(
        net.route_groups("route_short_name", "route_type"), "route_id"
    )
    counts = (
        served.groupBy("stop_id")
        .agg(
            F.countDistinct("route_id").alias("route_count"),
            F.countDistinct("route_type").alias("transport_modes"),
        )
        .where(F.col("route_count") >= min_routes)
    )
    # The rank limit is applied before the shuffle by stop as well, so a stop
    # never sends more than ``names`` rows per task.
    by_name = W.partitionBy("stop_id").orderBy("route_short_name")
    shown = (
        served.where("route_short_name is not null")
        .select("stop_id", "route_short_name")
        .distinct()
        .withColumn("rank", F.row_number().over(by_name))
        .where(F.col("rank") <= names)
        .groupBy("stop_id")
        .agg(F.array_sort(F.collect_list("route_short_name")).alias("names"))
        .select("stop_id", F.array_join("names", ",").alias("routes_serving"))
    )
    located = net.stops.where("latitude is not null and longitude is not null").distinct()
    return (
        counts.join(shown, "stop_id", "left")
        .join(located, "stop_id")
        .select(
            "stop_id",
            "stop_name",
            "latitude",
            "longitude",
            "route_count",
            "transport_modes",
            "routes_serving",
        )
    )


def weekday_vs_weekend(net: Network) -> DataFrame:
    """Kind of service -> distinct trips."""
    weekday, weekend = F.col("weekday_count") > 0, F.col("weekend_count") > 0
    kinds = net.calendar.select(
        "service_id",
        F.when(weekday & weekend, "Both")
        .when(weekday, "Weekday Only")
        .when(weekend, "Weekend Only")
        .otherwise("Unknown")
        .alias("service_type"),
    ).distinct()
    return (
        net.trips.select("trip_id", "service_id")
        .join(kinds, "service_id")
        .groupBy("service_type")
        .agg(F.countDistinct("trip_id").alias("total_trips"))
    )


def route_lengths(net: Network) -> DataFrame:
    """Route -> distinct stops, distinct trips, highest stop sequence."""
    # Trips and stops are counted apart: Spark's plan for several distinct counts
    # would hold each stop time once for each count in the memory of its tasks.
    trips = net.trips_in_groups(ROUTE_GROUP, "max_stop_sequence").groupBy(*ROUTE_GROUP).agg(
        F.count(F.lit(1)).alias("trips"), F.max("max_stop_sequence").alias("max_stop_sequence")
    )
    stops = net.stops_in_groups(ROUTE_GROUP, timed=False).groupBy(*ROUTE_GROUP).agg(
        F.count("stop_id").alias("stops")
    )
    return (
        trips.unionByName(stops, allowMissingColumns=True)
        .groupBy(*ROUTE_GROUP)
        .agg(
            F.coalesce(F.sum("stops"), F.lit(0)).alias("unique_stops"),
            F.coalesce(F.sum("trips"), F.lit(0)).alias("total_trips"),
            F.max("max_stop_sequence").alias("max_stop_sequence"),
        )
    )


def longest_routes(net: Network, n: int = LONGEST_KEPT) -> DataFrame:
    """The n routes with the most stops; only these are stored."""
    return route_lengths(net).orderBy(F.desc("unique_stops"), *ROUTE_GROUP).limit(n)


def early_night_routes(net: Network) -> DataFrame:
    """Routes that start before 06 or whose last departure is at 23 or later."""
    spans = (
        net.trips_in_groups(ROUTE_GROUP, "first_departure", "last_departure")
        .where("first_departure is not null")
        .groupBy(*ROUTE_GROUP)
        .agg(
            F.min("first_departure").alias("first_departure"),
            F.max("last_departure").alias("last_departure"),
        )
    )
    first, last = times.hour_of(F.col("first_departure")), times.hour_of(F.col("last_departure"))
    return spans.select(
        "*",
        first.alias("first_hour"),
        last.alias("last_hour"),
        (first < 6).alias("is_early_bird"),
        (last >= 23).alias("is_night_owl"),
    ).where("is_early_bird or is_night_owl")


def timestamped(visits: DataFrame) -> DataFrame:
    """Adds the time of a visit on the animation's day, the last column of trajectories."""
    return visits.withColumn("departure_timestamp_ms", times.epoch_ms(F.col("departure_time")))


def trip_trajectories(net: Network) -> DataFrame:
    """One row per stop visit with place and time. ``build`` stores it sorted
    by trip and sequence. Trips are joined first, so that stop times that lie
    next to their trips (``plans.colocated``) need not move for it."""
    visits = net.stop_times.where(times.is_service_time(F.col("departure_time"))).select(
        "trip_id", "stop_id", "stop_sequence", "departure_time"
    )
    places = net.stops.where("latitude is not null and longitude is not null")
    named = net.trips.select("trip_id", "route_id").join(
        net.routes.select("route_id", "route_short_name", "route_long_name"), "route_id"
    )
    return (
        visits.join(named, "trip_id")
        .join(places, "stop_id")
        .select(
            "trip_id",
            "route_short_name",
            "route_long_name",
            "stop_sequence",
            "stop_name",
            "latitude",
            "longitude",
            "departure_time",
        )
        .transform(timestamped)
    )


# The staging tables each mart is made of.
_STOP_TIMED = ("stg_stop_times", "stg_trips", "stg_routes")
NEEDS = {
    "mart_stops_ranked": (*_STOP_TIMED, "stg_stops"),
    "mart_trips_per_route": ("stg_trips", "stg_routes"),
    "mart_peak_hour_analysis": ("stg_stop_times",),
    "mart_route_service_hours": _STOP_TIMED,
    "mart_service_frequency": _STOP_TIMED,
    "mart_transfer_hubs": (*_STOP_TIMED, "stg_stops"),
    "mart_weekday_vs_weekend": ("stg_trips", "stg_calendar"),
    "mart_longest_routes": _STOP_TIMED,
    "mart_early_night_routes": _STOP_TIMED,
    "mart_trip_trajectories": (*_STOP_TIMED, "stg_stops"),
}

MARTS = {
    "mart_stops_ranked": stops_ranked,
    "mart_trips_per_route": trips_per_route,
    "mart_peak_hour_analysis": peak_hour_analysis,
    "mart_route_service_hours": route_service_hours,
    "mart_service_frequency": service_frequency,
    "mart_transfer_hubs": transfer_hubs,
    "mart_weekday_vs_weekend": weekday_vs_weekend,
    "mart_longest_routes": longest_routes,
    "mart_early_night_routes": early_night_routes,
    "mart_trip_trajectories": trip_trajectories,
}
