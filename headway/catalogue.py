"""Every operator as a named query over a directory of star-schema tables."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schemas
from headway.functions import times
from headway.operators import marts, rejects, rollups, sketches, staging
from headway.plans import build, colocated, event_reports, rail_reports, reports
from headway.session import work_path
from headway.sources import feed, payloads, samples, tables
from headway.sources.topics import RAIL_TOPIC, read_message_files
from headway.sources.snapshots import Snapshot
from headway.streaming import codec, compact, ingest, live, state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BUS, FERRY, TRAM = 3, 4, 0
HUB_ROUTES_HIGH = 500
STATE_BATCHES = 3
REPLAY_ROWS = 1_000_000
# Rows of a task that removes repeated ones, about.
DISTINCT_ROWS = 500_000


def _query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def _over_network(name: str, result: Callable[[marts.Network], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: result(samples.network(spark, sf_dir))


def _over(
    name: str,
    source: Callable[[SparkSession, str], DataFrame],
    result: Callable[[DataFrame], DataFrame],
) -> None:
    QUERIES[name] = lambda spark, sf_dir: result(source(spark, sf_dir))


# Staging, from text columns as a CSV scan gives them.
for _table, (_member, _build) in staging.BUILDERS.items():
    QUERIES[f"staging_{_member}"] = lambda spark, sf_dir, m=_member, b=_build: b(
        samples.raw_feed(spark, sf_dir)[m]
    )

# Rollups and marts.
_over_network(
    "trip_rollup",
    lambda n: rollups.trip_rollup(n.stop_times),
)
_over_network("route_stop_rollup", lambda n: rollups.route_stop_rollup(n.stop_times, n.trips))
_over_network("stops_ranked", marts.stops_ranked)
_over_network("trips_per_route", marts.trips_per_route)
_over_network("peak_hours", marts.peak_hour_analysis)
_over_network("service_hours", marts.route_service_hours)
_over_network("service_frequency", marts.service_frequency)
_over_network("transfer_hubs", marts.transfer_hubs)
_over_network("transfer_hubs_500", lambda n: marts.transfer_hubs(n, HUB_ROUTES_HIGH))
_over_network("weekday_vs_weekend", marts.weekday_vs_weekend)
_over_network("route_lengths", marts.route_lengths)
_over_network("longest_routes", marts.longest_routes)
_over_network("early_night_routes", marts.early_night_routes)
_over_network("trip_trajectories", marts.trip_trajectories)

# Network reports.


def _kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = samples.network(spark, sf_dir)
    return reports.network_kpis(
        spark,
        marts.stops_ranked(net),
        marts.trips_per_route(net),
        marts.peak_hour_analysis(net),
        net.routes,
    )


QUERIES["network_kpis"] = _kpis
QUERIES["network_kpi_texts"] = lambda spark, sf_dir: reports.kpi_texts(_kpis(spark, sf_dir))
_over_network("stop_points", lambda n: reports.stop_points(marts.stops_ranked(n)))
_over_network("stop_points_ferry", lambda n: reports.stop_points(marts.stops_ranked(n), FERRY))
_over_network("top_routes", reports.top_routes)
_over_network("top_routes_bus", lambda n: reports.top_routes(n, BUS))
_over_network("hourly", lambda n: reports.departures_by_hour(marts.peak_hour_analysis(n)))
_over_network("hourly_by_type", lambda n: reports.departures_by_hour_of_mode(n, BUS))
_over_network("busiest_stops", lambda n: reports.busiest_stops(marts.stops_ranked(n)))
_over_network("busiest_stops_tram", lambda n: reports.busiest_stops(marts.stops_ranked(n), TRAM))
_over_network("trips_by_mode", lambda n: reports.trips_by_mode(reports.top_routes(n)))
_over_network("service_hours_top", lambda n: reports.service_hours(marts.route_service_hours(n)))
_over_network(
    "service_hours_top_tram", lambda n: reports.service_hours(marts.route_service_hours(n), TRAM)
)
_over_network(
    "hourly_frequency",
    lambda n: reports.hourly_frequency(marts.service_frequency(n), marts.route_service_hours(n)),
)
_over_network(
    "frequency_heatmap",
    lambda n: reports.frequency_heatmap(reports.hourly_frequency_of(n)),
)
_over_network("hubs_top", lambda n: reports.top_hubs(marts.transfer_hubs(n)))
_over_network("longest_top", lambda n: reports.longest(marts.longest_routes(n)))
_over_network("longest_top_bus", lambda n: reports.longest(marts.longest_routes(n), BUS))
_over_network("early_birds", lambda n: reports.early_birds(marts.early_night_routes(n)))
_over_network("night_owls", lambda n: reports.night_owls(marts.early_night_routes(n)))
_over_network("night_owls_ferry", lambda n: reports.night_owls(marts.early_night_routes(n), FERRY))
_over_network("underserved_stops", lambda n: reports.underserved_stops(marts.stops_ranked(n)))
_over_network("underserved_counts", lambda n: reports.underserved_counts(marts.stops_ranked(n)))
_over_network("zone_coverage", lambda n: reports.zone_coverage(marts.stops_ranked(n)))
_over_network(
    "zone_counts", lambda n: reports.zone_counts(reports.zone_coverage(marts.stops_ranked(n)))
)
_over_network("route_names", lambda n: reports.route_names(reports.top_routes(n)))
_over_network(
    "route_compare",
    lambda n: reports.compare_routes(marts.route_service_hours(n), "R1", "R20"),
)

# Rail reports.
_over("rail_stations_per_line", samples.rail_lines, rail_reports.stations_per_line)
_over("rail_kpis", samples.rail_lines, rail_reports.heavy_rail_kpis)
_over("rail_network_size", samples.rail_lines, rail_reports.network_size)
_over("rail_mean_fares", samples.rail_fares, rail_reports.mean_fares)
_over("light_rail_kpis", samples.light_rail_stops, rail_reports.light_rail_kpis)
_over("light_rail_routes", samples.light_rail_stops, rail_reports.light_rail_routes)
_over("light_rail_points", samples.light_rail_stops, rail_reports.light_rail_points)
_over("line_picker", samples.rail_lines, rail_reports.line_picker)
_over("station_picker", samples.rail_lines, lambda d: rail_reports.station_picker(d, "KTL"))
_over("fare_origins", samples.rail_fares, rail_reports.fare_origins)
_over(
    "fare_destinations",
    samples.rail_fares,
    lambda d: rail_reports.fare_destinations(d, "Station 5"),
)
_over(
    "fare_lookup",
    samples.rail_fares,
    lambda d: rail_reports.fare_lookup(d, "Station 5", "Station 9"),
)
_over(
    "rail_raw_names",
    samples.light_rail_stops,
    lambda d: feed.rename_rail(d, "mtr_light_rail_stops"),
)

# API answers.
_over(
    "schedule_flatten",
    samples.schedule_answers,
    lambda d: payloads.flatten_schedule(d, observed_at=F.col("observed_at")),
)
_over(
    "eta_flatten",
    samples.eta_answers,
    lambda d: payloads.flatten_eta(d, observed_at=F.col("observed_at")),
)
_over(
    "broken_answers",
    samples.schedule_answers,
    lambda d: payloads.broken_payloads(d, schemas.SCHEDULE_PAYLOAD).select(
        "observed_at",
        F.regexp_extract("payload", '"curr_time":"([^"]*)"', 1).alias("curr_time"),
        F.regexp_extract("payload", r'"data":\{"([^"]*)"', 1).alias("line_station"),
    ),
)
_over(
    "next_trains", samples.schedule_answers, lambda d: rail_reports.next_trains(d, "KTL", "S2")
)
_over(
    "schedule_status",
    samples.schedule_answers,
    lambda d: rail_reports.schedule_status(d)
    .groupBy("ok", "is_delayed", "error")
    .agg(F.count(F.lit(1)).alias("answers")),
)



def _stamped(name: str, source: Callable[[SparkSession, str], DataFrame],
             flatten: Callable[[DataFrame], DataFrame]) -> None:
    """Events that the job's own clock stamps; whether the stamp lies within the run."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        started = F.lit(dt.datetime.now(dt.timezone.utc))
        events = flatten(source(spark, sf_dir).drop("observed_at"))
        own = F.col("timestamp").between(started, F.current_timestamp())
        return events.withColumn("stamped_in_run", own).drop("timestamp")

    QUERIES[name] = run


_stamped("stamped_schedule", samples.schedule_answers, payloads.flatten_schedule)
_stamped("stamped_eta", samples.eta_answers, payloads.flatten_eta)

# Event reports, batch.
_over("stream_kpis", samples.rail_events, event_reports.stream_kpis)
_over("events_per_line", samples.rail_events, event_reports.events_per_line)
_over("events_per_minute", samples.rail_events, event_reports.events_per_minute)
_over("direction_split", samples.rail_events, event_reports.direction_split)
_over("top_destinations", samples.rail_events, event_reports.top_destinations)
_over("latest_events", samples.rail_events, event_reports.latest_events)

# Messages: encode, then decode.


@_query("message_keys")
def message_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = samples.messages(spark, sf_dir)
    return keyed.groupBy("topic", F.col("key").cast("string").alias("key")).agg(
        F.count(F.lit(1)).alias("messages"), F.count("value").alias("with_value")
    )


@_query("message_decode")
def message_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.events(codec.decode(samples.messages(spark, sf_dir), RAIL_TOPIC))


@_query("message_quarantine")
def message_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = codec.bad_messages(codec.decode(samples.messages(spark, sf_dir), RAIL_TOPIC))
    return bad.groupBy(F.col("key").cast("string").alias("key")).agg(
        F.count(F.lit(1)).alias("messages"), F.count("value").alias("with_value")
    )


# Streams. Each run gets new folders under the shared folder.


def _replay_files(messages: DataFrame, path: str) -> None:
    """Adds messages to a folder as files of which a batch takes several."""
    messages.write.option("maxRecordsPerFile", REPLAY_ROWS).mode("append").parquet(path)


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    """Writes the messages as replay files and drains them into tables."""
    root = work_path(spark, "ingest")
    _replay_files(samples.messages(spark, sf_dir), f"{root}/messages")
    ingest.drain(
        lambda topic: read_message_files(spark, f"{root}/messages").where(F.col("topic") == topic),
        f"{root}/tables",
    )
    return f"{root}/tables"


@_query("stream_ingest_counts")
def stream_ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _ingested(spark, sf_dir)
    counts = None
    for table in ingest.TABLES:
        good = ingest.events_table(spark, root, table).select(F.lit("ok").alias("status"))
        bad = ingest.bad_messages(spark, root, table).select(F.lit("bad").alias("status"))
        for rows in (good, bad):
            one = rows.groupBy(F.lit(table).alias("table_name"), "status").agg(
                F.count(F.lit(1)).alias("row_count")
            )
            counts = one if counts is None else counts.unionAll(one)
    return counts


@_query("stream_ingest_rail")
def stream_ingest_rail(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _ingested(spark, sf_dir)
    return ingest.events_table(spark, root, ingest.RAIL_TABLE).drop("event_date")


@_query("stream_ingest_bus")
def stream_ingest_bus(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _ingested(spark, sf_dir)
    return ingest.events_table(spark, root, ingest.BUS_TABLE)


@_query("compacted_events")
def compacted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores the messages in several batches, with a compaction after half of them
    and one after all, then adds a last batch; all rail events there are."""
    root = work_path(spark, "compact")
    # Encoded once for all shares.
    encoded = samples.messages(spark, sf_dir)
    _replay_files(encoded, f"{root}/encoded")
    messages = spark.read.schema(encoded.schema).parquet(f"{root}/encoded")
    share_of = F.pmod(F.xxhash64("key", "value"), F.lit(4))
    for share in range(4):
        _replay_files(messages.where(share_of == share), f"{root}/messages")
        compact.drain(
            lambda topic: read_message_files(spark, f"{root}/messages").where(F.col("topic") == topic),
            f"{root}/tables",
        )
        if share in (1, 2):
            for table in ingest.TABLES:
                compact.compact(spark, f"{root}/tables", table, period="yyyy-MM")
    return compact.events_table(spark, f"{root}/tables", ingest.RAIL_TABLE)


def _live(name: str, result: Callable[[DataFrame], DataFrame]) -> None:
    """A report over a table that a stream has filled."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_path(spark, name)
        events = samples.stream_rail_events(spark, sf_dir)
        live.store(events, f"{root}/events", f"{root}/checkpoint").awaitTermination()
        return result(spark.read.schema(events.schema).parquet(f"{root}/events"))

    QUERIES[name] = run


_live("live_per_minute", live.events_per_minute)
_live("live_per_line", live.events_per_line)
_live("live_directions", live.direction_split)
_live("live_top_destinations", live.top_destinations)
_live("live_kpis", lambda events: live.kpis(live.stations(events)))



def _state(name: str, result: Callable[[Snapshot], DataFrame]) -> None:
    """A report over counts that several batches of a stream have added to."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_path(spark, name)
        events = samples.rail_events(spark, sf_dir)
        events.repartition(STATE_BATCHES).write.parquet(f"{root}/inbox")
        stream = (
            spark.readStream.schema(events.schema)
            .option("maxFilesPerTrigger", 1)
            .parquet(f"{root}/inbox")
        )
        state.keep(stream, f"{root}/counts").awaitTermination()
        return result(Snapshot(spark, f"{root}/counts"))

    QUERIES[name] = run


_state("state_per_minute", state.events_per_minute)
_state("state_per_line", state.events_per_line)
_state("state_directions", state.direction_split)
_state("state_top_destinations", state.top_destinations)
_state("state_kpis", state.kpis)

# Files and stored tables.


@_query("feed_files")
def feed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the feed as CSV members, reads it back and stages all five; each
    staged row as (table, its values as text)."""
    root = work_path(spark, "feed")
    raw = samples.raw_feed(spark, sf_dir)
    for member, df in raw.items():
        tables.save_csv(df, f"{root}/{member}.txt")
    staged = staging.stage(feed.read_feed(spark, root))
    rows = [
        df.select(
            F.lit(name).alias("table_name"),
            F.concat_ws(
                "|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in df.columns]
            ).alias("row_values"),
        )
        for name, df in staged.items()
    ]
    return functools.reduce(DataFrame.unionAll, rows)


@_query("stored_tables")
def stored_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Builds and stores all tables; the row counts of the writes."""
    rows = build.build_all(spark, samples.raw_feed(spark, sf_dir), work_path(spark, "tables"))
    return spark.createDataFrame(list(rows.items()), "table_name string, row_count bigint")


def _stored(
    name: str,
    result: Callable[[marts.Network, Callable[[str], DataFrame]], DataFrame],
    *needed: str,
):
    """A table or report of a whole build, with the marts needed, read from where it was stored."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_path(spark, name)
        raw = samples.raw_feed(spark, sf_dir)
        build.build_staging(spark, raw, root)
        build.build_rollups(spark, root)
        for mart in needed:
            tables_at = Snapshot(spark, root)
            df = marts.MARTS[mart](build.stored_network(spark, root))
            build.save_mart(tables_at, df, mart)
            tables_at.commit()
        return result(build.stored_network(spark, root), lambda t: tables.load(spark, root, t))

    QUERIES[name] = run


# Query of a stored mart -> the mart.
STORED_MARTS = {
    "stored_" + mart.removeprefix("mart_"): mart.removeprefix("mart_") for mart in marts.MARTS
}
for _name, _mart in STORED_MARTS.items():
    _stored(_name, lambda net, load, m=_mart: load(f"mart_{m}").drop(tables.PART_OF), f"mart_{_mart}")
_stored("stored_route_stop_rollup", lambda net, load: net.stored_route_stop_rollup)
_stored("stored_hourly_by_type", lambda net, load: reports.departures_by_hour_of_mode(net, BUS))
_stored(
    "stored_frequency_heatmap",
    lambda net, load: reports.frequency_heatmap(
        reports.hourly_frequency(load("mart_service_frequency"), load("mart_route_service_hours"))
    ),
    "mart_service_frequency", "mart_route_service_hours",
)


@_query("stored_twice")
def stored_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores the trips of even number, then all of them, in one table; the rows that a
    reader who came between the two still has, and those of a reader after both."""
    root = work_path(spark, "twice")
    trips = staging.trips(samples.raw_feed(spark, sf_dir)["trips"])
    tables.save(trips.where("cast(trip_id as bigint) % 2 = 0"), root, "stg_trips")
    between = Snapshot(spark, root)
    tables.save(trips, root, "stg_trips")
    seen = {"between": between.load("stg_trips"), "after": tables.load(spark, root, "stg_trips")}
    rows = [df.select(F.lit(reader).alias("reader"), "*") for reader, df in seen.items()]
    return rows[0].unionAll(rows[1])


# A feed with malformed rows: what is kept, what is rejected, and the counts.


def _rejecting(name: str, *members: str):
    def register(result: Callable[[Snapshot], DataFrame]) -> Callable[[Snapshot], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            root = work_path(spark, name)
            raw = samples.spoiled_feed(spark, sf_dir)
            used = {m: df for m, df in raw.items() if not members or m in members}
            build.build_staging(spark, used, root, reject=True)
            return result(Snapshot(spark, root))

        QUERIES[name] = run
        return result

    return register


@_rejecting("reject_counts")
def reject_counts(stored: Snapshot) -> DataFrame:
    return stored.load(rejects.COUNTS)


@_rejecting("rejected_stop_times", "stop_times")
def rejected_stop_times(stored: Snapshot) -> DataFrame:
    bad = stored.load("rejected_stop_times")
    return bad.select(
        F.array_join("problems", " ").alias("problems"),
        *[F.get_json_object("raw_row", f"$.{c}").alias(c) for c in ("trip_id", "stop_id", "stop_sequence")],
        F.get_json_object("raw_row", "$.departure_time").alias("departure_time"),
    )


_rejecting("kept_routes", "routes")(lambda stored: stored.load("stg_routes"))
_rejecting("kept_calendar", "calendar")(lambda stored: stored.load("stg_calendar"))
_rejecting("kept_peak_hours", "stop_times")(
    lambda stored: marts.peak_hour_analysis(marts.Network(stop_times=stored.load("stg_stop_times")))
)


@_query("stored_event_days")
def stored_event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores the rail events by day, twice as a rerun would, then reads one
    month of them."""
    root = work_path(spark, "events")
    for _ in range(2):
        tables.save_rail_events(samples.rail_events(spark, sf_dir), root)
    stored = tables.load(spark, root, tables.LOADED_EVENTS)
    month = tables.between(stored, "2024-01-10 06:00:00", "2024-02-10 06:00:00")
    return month.groupBy("event_date", "line").agg(F.count(F.lit(1)).alias("events"))


def _colocated(
    name: str, rollup: Callable[[SparkSession, colocated.Layout, dict[str, DataFrame]], DataFrame]
) -> None:
    """A rollup or mart over buckets by trip; trips with six stop times or more count as hot."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_path(spark, name)
        raw = samples.raw_feed(spark, sf_dir)
        layout = colocated.save(
            staging.stop_times(raw["stop_times"]), staging.trips(raw["trips"]), root,
            f"{name}_{root[-32:]}", buckets=8, hot_rows=6,
        )
        return rollup(spark, layout, raw)

    QUERIES[name] = run


_colocated("colocated_trip_rollup", lambda s, layout, raw: colocated.trip_rollup(s, layout))
_colocated("colocated_visit_rollup", lambda s, layout, raw: colocated.visit_rollup(s, layout))


def _trajectories(
    spark: SparkSession, layout: colocated.Layout, raw: dict[str, DataFrame]
) -> DataFrame:
    colocated.save_trajectories(
        spark, layout, staging.routes(raw["routes"]), staging.stops(raw["stops"])
    )
    return colocated.trajectories(spark, layout)


_colocated("colocated_trajectories", _trajectories)


def _sketched(name: str, result: Callable[[DataFrame, marts.Network, int], DataFrame]) -> None:
    """An estimate from stored sketches next to the exact value, and whether it is
    within the stated error. The result also gets the number of stop times."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_path(spark, name)
        raw = samples.raw_feed(spark, sf_dir)
        rows = build.build_staging(spark, {m: raw[m] for m in ("trips", "stop_times")}, root)
        build.build_sketches(spark, root)
        net = build.stored_network(spark, root, with_rollups=False, staged=build.ROLLUP_NEEDS)
        return result(tables.load(spark, root, build.SKETCHES), net, rows["stg_stop_times"])

    QUERIES[name] = run


def _sketched_trips(*group: str) -> Callable[[DataFrame, marts.Network, int], DataFrame]:
    def result(stored: DataFrame, net: marts.Network, rows: int) -> DataFrame:
        timed = net.stop_times.where(times.is_service_time(F.col("departure_time"))).select(
            "trip_id", "stop_id", times.valid_hour(F.col("departure_time")).alias("hour_of_day")
        )
        # Hardly any row repeats another, so a task holds about as many as it gets.
        pairs = timed.join(net.runs, "trip_id").select(*group, "trip_id")
        pairs = pairs.repartition(rows // DISTINCT_ROWS + 1, *group, "trip_id").distinct()
        exact = pairs.groupBy(*group).agg(F.count("trip_id").alias("trips"))
        off = F.abs(F.col("approx_trips") - F.col("trips"))
        return sketches.approx_trips(stored, *group).join(exact, list(group)).select(
            *group, "trips", (off <= F.greatest(F.col("trips") * sketches.DISTINCT_ERROR, F.lit(1.0))).alias("close")
        )

    return result


_sketched("sketched_trips_per_route", _sketched_trips("route_id"))
_sketched("sketched_trips_per_hour", _sketched_trips("hour_of_day"))
_sketched("sketched_trips_per_stop", _sketched_trips("stop_id"))


def _sketched_medians(stored: DataFrame, net: marts.Network, _rows: int) -> DataFrame:
    """Shares of visits before and up to the estimate must enclose a half, but for the error."""
    seconds = net.stop_times.join(net.runs.select("trip_id"), "trip_id").select(
        times.seconds_of(F.col("departure_time")).alias("second"),
        times.valid_hour(F.col("departure_time")).alias("hour_of_day"),
    ).where("second is not null")
    found = seconds.join(sketches.approx_departure(stored, "hour_of_day"), "hour_of_day")
    shares = found.groupBy("hour_of_day").agg(
        F.count(F.lit(1)).alias("visits"),
        F.avg((F.col("second") < F.col("departure_second")).cast("double")).alias("before"),
        F.avg((F.col("second") <= F.col("departure_second")).cast("double")).alias("upto"),
    )
    error = sketches.RANK_ERROR
    return shares.select(
        "hour_of_day", "visits", ((F.col("before") <= 0.5 + error) & (F.col("upto") >= 0.5 - error)).alias("close")
    )


_sketched("sketched_median_departures", _sketched_medians)


@_query("exported_stops")
def exported_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report exported as one CSV file, replaced by a second export, read back as text."""
    path = f"{work_path(spark, 'export')}/busiest"
    report = reports.busiest_stops(marts.stops_ranked(samples.network(spark, sf_dir)))
    for rows in (report.limit(3), report):
        tables.save_csv(rows, path, single_file=True)
    return feed.read_csv_text(spark, path)


@_query("loaded_preview")
def loaded_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 30 rows, in file order, of a file that lacks the columns of stops."""
    path = f"{work_path(spark, 'preview')}/routes"
    routes = samples.raw_feed(spark, sf_dir)["routes"]
    tables.save_csv(routes.orderBy(F.col("route_id").cast("bigint").desc()), path)
    return rail_reports.light_rail_routes(feed.read_csv_text(spark, path, file_order=True))


# Rail files: CSV with byte-order mark, blanks around headers and an unnamed
# column -> landed CSV, compressed -> raw table -> report.


def _rail_file(
    name: str,
    source: Callable[[SparkSession, str], DataFrame],
    table: str,
    report: Callable[[DataFrame], DataFrame],
) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_path(spark, name)
        rows = source(spark, sf_dir)
        headers = [f" {c} " for c in rows.columns]
        headers[0] = "\ufeff" + headers[0]
        tables.save_csv(rows.toDF(*headers).withColumn("_c99", F.lit(None).cast("string")),
                        f"{root}/in/{table}")
        build.load_rail(spark, {table: f"{root}/in/{table}"}, f"{root}/raw", codec="gzip")
        return report(tables.load(spark, f"{root}/raw", table))

    QUERIES[name] = run


for _name, _source, _table, _report in (
    ("loaded_stations_per_line", samples.rail_lines, rail_reports.LINES,
     rail_reports.stations_per_line),
    ("loaded_network_size", samples.rail_lines, rail_reports.LINES, rail_reports.network_size),
    ("loaded_station_picker", samples.rail_lines, rail_reports.LINES,
     lambda d: rail_reports.station_picker(d, "KTL")),
    ("loaded_mean_fares", samples.rail_fares, rail_reports.FARES, rail_reports.mean_fares),
    ("loaded_fare_lookup", samples.rail_fares, rail_reports.FARES,
     lambda d: rail_reports.fare_lookup(d.drop(feed.FILE_ORDER), "Station 5", "Station 9")),
    ("loaded_light_rail_points", samples.light_rail_stops, rail_reports.STOPS,
     rail_reports.light_rail_points),
    ("loaded_bus_stops", samples.light_rail_stops, "mtr_bus_stops",
     lambda d: d.drop(feed.FILE_ORDER)),
):
    _rail_file(_name, _source, _table, _report)
