"""Network reports over marts and staging tables.

Every report takes DataFrames and returns one; labels, ranks, medians and
pivots are part of the plan. ``route_type`` filters by mode, None means all.
Where a report keeps the first n rows, ties are broken by the key columns, so
results repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.functions import grid, labels, times
from headway.operators import marts as m
from headway.operators import medians
from headway.sources import tables

# The modes a reader can filter by.
MODE_FILTERS = {"All": None, "Bus": 3, "Tram": 0, "Ferry": 4, "Peak Tram": 7}
WELL_SERVED_STOPS = 3


def of_mode(df: DataFrame, route_type: int | None) -> DataFrame:
    return df if route_type is None else df.where(F.col("route_type") == route_type)


def with_mode(df: DataFrame) -> DataFrame:
    return df.withColumn("transport_type", labels.mode_label(F.col("route_type")))


def top(df: DataFrame, n: int, measure: str, *ties: str | Column) -> DataFrame:
    return df.orderBy(F.desc(measure), *ties).limit(n)


def network_kpis(
    spark: SparkSession,
    stops_ranked: DataFrame,
    trips_per_route: DataFrame,
    peak_hours: DataFrame,
    routes: DataFrame,
) -> DataFrame:
    """One row: stops with coordinates, departures, routes, the busiest stop
    and route, and the peak hour. Each input is read once."""
    stops = stops_ranked.agg(
        F.struct(
            F.count_if(F.col("latitude").isNotNull()).alias("total_stops"),
            F.sum("total_departures").alias("total_departures"),
            F.min_by(
                "stop_name", F.struct(-F.col("total_departures"), "stop_name", "stop_id")
            ).alias("top_stop"),
        )
    )
    busiest = trips_per_route.agg(
        F.min_by(
            F.struct("route_short_name", "total_trips"),
            F.struct(-F.col("total_trips"), "route_short_name", "route_long_name"),
        )
    )
    peak = peak_hours.agg(F.min_by("hour_of_day", F.struct(-F.col("total_trips"), "hour_of_day")))
    names = routes.agg(F.countDistinct("route_short_name"))
    row = spark.range(1).select(
        stops.scalar().alias("s"),
        busiest.scalar().alias("b"),
        peak.scalar().alias("peak_hour"),
        names.scalar().alias("total_routes"),
    )
    return row.select(
        "s.total_stops",
        "s.total_departures",
        "total_routes",
        "s.top_stop",
        F.col("b.route_short_name").alias("busiest_route"),
        F.col("b.total_trips").alias("busiest_route_trips"),
        "peak_hour",
    )


def kpi_texts(kpis: DataFrame) -> DataFrame:
    """The KPI row as display texts."""
    return kpis.select(
        F.format_number("total_stops", 0).alias("total_stops"),
        F.format_number("total_departures", 0).alias("total_departures"),
        F.format_number("total_routes", 0).alias("total_routes"),
        "top_stop",
        "busiest_route",
        F.format_number("busiest_route_trips", 0).alias("busiest_route_trips"),
        times.hour_label(F.col("peak_hour")).alias("peak_hour"),
    )


def stop_points(stops_ranked: DataFrame, route_type: int | None = None) -> DataFrame:
    """Stops with coordinates; a stop without a mode counts as a bus stop."""
    located = stops_ranked.where("latitude is not null and longitude is not null")
    typed = located.withColumn(
        "route_type", F.coalesce("route_type", F.lit(labels.DEFAULT_MODE))
    )
    return with_mode(of_mode(typed, route_type))


def top_routes(net: m.Network, route_type: int | None = None, n: int = 20) -> DataFrame:
    """The n routes with the most trips. The mode filter applies after the
    limit: it hides rows of the overall list."""
    counted = m.trips_by(net, *m.ROUTE_GROUP)
    return with_mode(of_mode(top(counted, n, "total_trips", *m.ROUTE_GROUP), route_type))


def departures_by_hour(peak_hours: DataFrame) -> DataFrame:
    """Departures per hour 0-23, all modes."""
    return peak_hours.where(F.col("hour_of_day").between(0, 23)).orderBy("hour_of_day")


def departures_by_hour_of_mode(net: m.Network, route_type: int | None = None) -> DataFrame:
    """Departures per hour 0-23 of one mode; from the stored visits per route
    and hour if there are any."""
    if net.stored_route_hours is not None:
        modes = of_mode(net.route_groups("route_type"), route_type)
        return (
            net.stored_route_hours.join(modes, "route_id")
            .groupBy("hour_of_day")
            .agg(F.sum(F.col("visits") * F.col("route_copies")).alias("total_trips"))
            .orderBy("hour_of_day")
        )
    hours = net.stop_times.select(
        "trip_id", times.valid_hour(F.col("departure_time")).alias("hour_of_day")
    ).where(F.col("hour_of_day").between(0, 23))
    return (
        hours.join(of_mode(net.trip_groups("route_type"), route_type), "trip_id")
        .groupBy("hour_of_day")
        .agg(F.sum("copies").alias("total_trips"))
        .orderBy("hour_of_day")
    )


def busiest_stops(
    stops_ranked: DataFrame, route_type: int | None = None, n: int = 10
) -> DataFrame:
    """The n busiest stops, ranked from 1."""
    order = [F.desc("total_departures"), F.col("stop_name"), F.col("stop_id")]
    first = stop_points(stops_ranked, route_type).orderBy(*order).limit(n)
    # The window sees n rows only.
    return first.withColumn("rank", F.row_number().over(W.orderBy(*order))).select(
        "rank", "stop_name", "total_departures", "transport_type"
    )


def trips_by_mode(top_route_rows: DataFrame) -> DataFrame:
    """Trips per mode over the rows of ``top_routes``."""
    return top_route_rows.groupBy("transport_type").agg(F.sum("total_trips").alias("total_trips"))


def service_hours(
    route_service_hours: DataFrame, route_type: int | None = None, n: int = 20
) -> DataFrame:
    """First and last service of the n routes with the most trips."""
    first = top(of_mode(route_service_hours, route_type), n, "total_trips", *m.ROUTE_GROUP)
    return with_mode(first).select(
        "route_short_name",
        times.display_time(F.col("first_departure")).alias("first_service"),
        times.display_time(F.col("last_departure")).alias("last_service"),
        "total_trips",
        "total_stops",
        "transport_type",
    )


def hourly_frequency(
    service_frequency: DataFrame,
    route_service_hours: DataFrame,
    route_type: int | None = None,
    n: int = 10,
) -> DataFrame:
    """Trips per hour of the n routes with the most trips.

    If the frequencies are stored ``tables.by_part`` of their routes, only the parts of
    these n routes are read: they are known when the scan starts.
    """
    # Every route has trips; a comparison is what Spark wants to see before it prunes.
    counted = of_mode(route_service_hours, route_type).where("total_trips > 0")
    wanted = _top_names(counted, n)
    keys = ["route_short_name"]
    if tables.PART_OF in service_frequency.columns:
        wanted = wanted.withColumn(tables.PART_OF, tables.part_of("route_short_name"))
        keys.append(tables.PART_OF)
    return _hours_of_routes(service_frequency.join(wanted, keys, "left_semi"))


def hourly_frequency_of(
    net: m.Network, route_type: int | None = None, n: int = 10
) -> DataFrame:
    """``hourly_frequency`` straight from a network. The routes with the most trips and
    the trips of each hour come from one trip rollup: both halves use the same columns
    of it, so Spark reads and shuffles the stop times once."""
    # No trip has an hour without a departure.
    trips = net.trips_in_groups(m.ROUTE_GROUP, "first_departure", "hours").where(
        "first_departure is not null"
    )
    counted = trips.groupBy(*m.ROUTE_GROUP).agg(F.count(F.lit(1)).alias("total_trips"))
    wanted = _top_names(of_mode(counted, route_type), n)
    # A trip counts once for all long names of its route.
    named = trips.join(wanted, "route_short_name", "left_semi")
    served = named.select("trip_id", *m.FREQUENCY_GROUP, "hours").distinct()
    return _hours_of_routes(m.trips_per_hour(served, *m.FREQUENCY_GROUP))


def _top_names(counted: DataFrame, n: int) -> DataFrame:
    """The short names of the n routes with the most trips."""
    return top(counted, n, "total_trips", *m.ROUTE_GROUP).select("route_short_name").distinct()


def _hours_of_routes(frequency: DataFrame) -> DataFrame:
    return frequency.groupBy("route_short_name", "hour_of_day").agg(
        F.sum("trips_per_hour").alias("trips_per_hour")
    )


def frequency_heatmap(hourly: DataFrame) -> DataFrame:
    """Route x hour matrix with columns h00 to h23; hours without trips are 0."""
    hours = list(range(24))
    wide = (
        hourly.where("route_short_name is not null")
        .groupBy("route_short_name")
        .pivot("hour_of_day", hours)
        .agg(F.sum("trips_per_hour"))
    )
    return wide.select(
        "route_short_name",
        *[F.coalesce(F.col(str(h)), F.lit(0)).alias(f"h{h:02d}") for h in hours],
    ).orderBy("route_short_name")


def top_hubs(transfer_hubs: DataFrame, n: int = 15) -> DataFrame:
    return top(transfer_hubs, n, "route_count", "stop_name", "stop_id").select(
        "stop_name", "route_count", "transport_modes", "routes_serving"
    )


def longest(longest_routes: DataFrame, route_type: int | None = None, n: int = 15) -> DataFrame:
    """The first n of the stored longest routes, filtered by mode."""
    kept = of_mode(longest_routes, route_type)
    return with_mode(top(kept, n, "unique_stops", *m.ROUTE_GROUP))


def _early_night(early_night_routes: DataFrame, route_type: int | None) -> DataFrame:
    return with_mode(of_mode(early_night_routes, route_type))


def early_birds(early_night_routes: DataFrame, route_type: int | None = None) -> DataFrame:
    return (
        _early_night(early_night_routes, route_type)
        .where("is_early_bird")
        .orderBy("first_departure", *m.ROUTE_GROUP)
        .select(
            "route_short_name",
            times.display_time(F.col("first_departure")).alias("first_service"),
            "transport_type",
        )
    )


def night_owls(early_night_routes: DataFrame, route_type: int | None = None) -> DataFrame:
    return (
        _early_night(early_night_routes, route_type)
        .where("is_night_owl")
        .orderBy("first_departure", *m.ROUTE_GROUP)
        .select(
            "route_short_name",
            times.display_time(F.col("last_departure")).alias("last_service"),
            "transport_type",
        )
    )


def _median_departures(points: DataFrame) -> Column:
    """Exact median as a scalar subquery."""
    return medians.median(points, "total_departures").scalar()


def underserved_stops(stops_ranked: DataFrame, route_type: int | None = None) -> DataFrame:
    """Stops with fewer departures than the median stop."""
    points = stop_points(stops_ranked, route_type)
    return points.where(F.col("total_departures") < _median_departures(points))


def underserved_counts(stops_ranked: DataFrame, route_type: int | None = None) -> DataFrame:
    points = stop_points(stops_ranked, route_type)
    # The subquery may not sit inside the aggregate, so it is a column first.
    split = points.select(
        (F.col("total_departures") >= _median_departures(points)).alias("well_served")
    )
    return split.agg(
        F.count(F.lit(1)).alias("total_stops"),
        F.count_if("well_served").alias("well_served"),
        F.count_if(~F.col("well_served")).alias("low_service"),
    )


def zone_coverage(stops_ranked: DataFrame, route_type: int | None = None) -> DataFrame:
    """Stops and departures per grid cell, at the cell's centre."""
    points = stop_points(stops_ranked, route_type)
    cells = points.groupBy(
        grid.cell_index(F.col("latitude")).alias("lat_cell"),
        grid.cell_index(F.col("longitude")).alias("lon_cell"),
    ).agg(
        F.count("stop_id").alias("stop_count"),
        F.sum("total_departures").alias("total_departures"),
    )
    return cells.select(
        grid.cell_centre(F.col("lat_cell")).alias("latitude"),
        grid.cell_centre(F.col("lon_cell")).alias("longitude"),
        "stop_count",
        "total_departures",
    )


def zone_counts(zones: DataFrame) -> DataFrame:
    served = F.col("stop_count") >= WELL_SERVED_STOPS
    return zones.agg(
        F.count(F.lit(1)).alias("total_zones"),
        F.count_if(served).alias("well_served"),
        F.count_if(~served).alias("underserved"),
    )


def route_names(top_route_rows: DataFrame) -> DataFrame:
    """Sorted route names to choose from."""
    name = labels.blank_to_null(F.col("route_short_name")).alias("route_short_name")
    return (
        top_route_rows.select(name)
        .where("route_short_name is not null")
        .distinct()
        .orderBy("route_short_name")
    )


def compare_routes(route_service_hours: DataFrame, route_a: str, route_b: str) -> DataFrame:
    """One row per chosen route; the first by long name and mode where several
    share the short name. Empty if either is unknown."""
    chosen = [
        route_service_hours.where(F.col("route_short_name") == F.lit(name))
        .orderBy("route_long_name", "route_type")
        .limit(1)
        .withColumn("side", F.lit(side))
        for side, name in (("A", route_a), ("B", route_b))
    ]
    both = chosen[0].unionByName(chosen[1])
    # Two rows at most, so this window is not a bottleneck.
    complete = F.count(F.lit(1)).over(W.partitionBy(F.lit(0))) == 2
    return (
        with_mode(both)
        .withColumn("complete", complete)
        .where("complete")
        .select(
            "side",
            "route_short_name",
            "route_long_name",
            "total_trips",
            "total_stops",
            "first_departure",
            "last_departure",
            "transport_type",
        )
    )
