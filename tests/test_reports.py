from __future__ import annotations

from headway.plans import event_reports, rail_reports, reports
from headway.sources import feed


def rows(df):
    return [tuple(r) for r in df.collect()]


def ranked(spark, *stops):
    return spark.createDataFrame(
        [(s, f"Stop {s}", lat, 114.11, n, mode) for s, lat, n, mode in stops],
        "stop_id string, stop_name string, latitude double, longitude double,"
        " total_departures bigint, route_type bigint",
    )


def test_stop_points_default_to_bus(spark):
    points = reports.stop_points(ranked(spark, ("a", 22.3, 5, None), ("b", None, 5, 0)))
    assert [(r.stop_id, r.route_type, r.transport_type) for r in points.collect()] == [
        ("a", 3, "Bus")
    ]
    assert reports.stop_points(ranked(spark, ("a", 22.3, 5, None)), 3).count() == 1


def test_median_split(spark):
    stops = ranked(spark, *[(f"s{n}", 22.3, n, 3) for n in (1, 2, 4, 10)])
    assert {r.stop_id for r in reports.underserved_stops(stops).collect()} == {"s1", "s2"}
    assert rows(reports.underserved_counts(stops)) == [(4, 2, 2)]
    assert rows(reports.underserved_counts(stops.where("false"))) == [(0, 0, 0)]


def test_busiest_stops_are_ranked_from_one(spark):
    stops = ranked(spark, *[(f"s{n:02d}", 22.3, n, 3) for n in range(12)], ("t", 22.3, 99, 0))
    top = rows(reports.busiest_stops(stops))
    assert top[0] == (1, "Stop t", 99, "Tram")
    assert [r[0] for r in top] == list(range(1, 11))
    assert rows(reports.busiest_stops(stops, 0)) == [(1, "Stop t", 99, "Tram")]


def test_zones(spark):
    stops = ranked(spark, *[(f"s{i}", lat, 2, 3) for i, lat in enumerate((22.301, 22.31, 22.319, 22.33))])
    zones = reports.zone_coverage(stops)
    assert sorted((round(r.latitude, 2), r.stop_count, r.total_departures) for r in zones.collect()) == [
        (22.31, 3, 6),
        (22.33, 1, 2),
    ]
    assert rows(reports.zone_counts(zones)) == [(2, 1, 1)]


def hours(spark, *values):
    return spark.createDataFrame(
        values,
        "route_short_name string, route_long_name string, route_type bigint,"
        " first_departure string, last_departure string, total_trips bigint, total_stops bigint",
    )


def test_route_comparison_needs_both_routes(spark):
    table = hours(
        spark,
        ("1", "b", 3, "05:00:00", "25:00:00", 9, 4),
        ("1", "a", 3, "06:00:00", "22:00:00", 5, 3),
        ("2", "c", 7, "07:00:00", "21:00:00", 2, 2),
    )
    both = rows(reports.compare_routes(table, "1", "2"))
    assert sorted((r[0], r[2], r[7]) for r in both) == [("A", "a", "Bus"), ("B", "c", "Unknown")]
    assert rows(reports.compare_routes(table, "1", "nine")) == []
    assert len(rows(reports.compare_routes(table, "1", "1"))) == 2
    assert rows(reports.compare_routes(table, "' or '1'='1", "2")) == []


def test_heatmap_fills_hours_and_filters_before_the_limit(spark):
    table = hours(
        spark,
        *[(f"{i:02d}", None, 3, "05:00:00", "06:00:00", 100 - i, 1) for i in range(12)],
        ("tram", None, 0, "05:00:00", "06:00:00", 1, 1),
    )
    frequency = spark.createDataFrame(
        [("00", 3, 5, 2), ("00", 0, 5, 3), ("00", 3, 23, 1), ("11", 3, 5, 9), ("tram", 0, 7, 4)],
        "route_short_name string, route_type bigint, hour_of_day bigint, trips_per_hour bigint",
    )
    wide = reports.frequency_heatmap(reports.hourly_frequency(frequency, table))
    assert wide.columns == ["route_short_name"] + [f"h{h:02d}" for h in range(24)]
    found = wide.collect()
    assert [(r.route_short_name, r.h05, r.h23, r.h00) for r in found] == [("00", 5, 1, 0)]
    trams = reports.hourly_frequency(frequency, table, route_type=0)
    assert rows(trams) == [("tram", 7, 4)]


def test_kpi_row_of_empty_and_full_tables(spark):
    stops = ranked(spark, ("b", 22.3, 5, 3), ("a", None, 5, 3))
    trips = spark.createDataFrame(
        [("9", "x", 1200), ("1", "x", 1200)],
        "route_short_name string, route_long_name string, total_trips bigint",
    )
    peak = spark.createDataFrame([(8, 3), (7, 3)], "hour_of_day bigint, total_trips bigint")
    routes = spark.createDataFrame([("1",), ("9",), (None,)], "route_short_name string")
    kpis = reports.network_kpis(spark, stops, trips, peak, routes)
    assert rows(kpis) == [(1, 10, 2, "Stop a", "1", 1200, 7)]
    assert rows(reports.kpi_texts(kpis)) == [("1", "10", "2", "Stop a", "1", "1,200", "07:00")]
    empty = reports.network_kpis(*[x.where("false") if hasattr(x, "where") else x
                                   for x in (spark, stops, trips, peak, routes)])
    assert rows(empty) == [(0, None, 0, None, None, None, None)]


def test_route_names_are_trimmed(spark):
    table = spark.createDataFrame(
        [(" 2",), ("2",), ("",), (None,), ("10",)], "route_short_name string"
    )
    assert rows(reports.route_names(table)) == [("10",), ("2",)]


LINES = "`Line Code` string, `Station Code` string, `English Name` string, `Chinese Name` string"


def lines(spark, *values):
    return spark.createDataFrame([(*v, "en", "zh") for v in values], LINES)


def test_heavy_rail(spark):
    table = lines(spark, ("ISL ", "A"), ("ISL", "B"), ("ISL", "A"), ("XX", "C"), (None, "D"),
                  ("XX", None))
    assert rows(rail_reports.stations_per_line(table)) == [
        ("ISL", "Island Line", 2),
        ("XX", "XX", 1),
    ]
    assert rows(rail_reports.heavy_rail_kpis(table)) == [(2, 3, "Island Line")]
    assert rows(rail_reports.heavy_rail_kpis(table.where("false"))) == [(0, 0, "N/A")]
    assert rows(rail_reports.network_size(table)) == [(3, 4)]
    assert rows(rail_reports.network_size(table.drop("Line Code"))) == [(10, 4)]
    assert rows(rail_reports.line_picker(table)) == [
        ("ISL", "Island Line (ISL)"),
        ("ISL ", "ISL  (ISL )"),
        ("XX", "XX (XX)"),
    ]


def test_stations_in_file_order(spark, tmp_path):
    text = "Line Code,Station Code,English Name,Chinese Name\n" + "\n".join(
        ["ISL,Z,Last,末", "ISL,A,First,首", "ISL,Z,Other,他", "TWL,Q,No,否"]
    )
    (tmp_path / "l.csv").write_text(text + "\n", encoding="utf-8")
    table = feed.read_csv_text(spark, str(tmp_path / "l.csv"), file_order=True)
    assert rows(rail_reports.station_picker(table, "ISL")) == [
        ("Z", "Last 末 (Z)"),
        ("A", "First 首 (A)"),
    ]


def test_mean_fares_round_half_to_even(spark):
    fares = spark.createDataFrame(
        [("ISL", "0.12"), ("ISL", "0.13"), ("TWL", "9"), ("NEW", None), (None, "5")],
        "LINE string, OCT_ADT_FARE string",
    )
    assert [(r.line_code, r.mean_fare) for r in rail_reports.mean_fares(fares).collect()] == [
        ("TWL", 9.0),
        ("ISL", 0.12),
        ("NEW", None),
    ]
    assert rail_reports.mean_fares(fares.drop("LINE")).count() == 0


def test_light_rail_columns():
    detect = rail_reports.LightRailColumns.detect
    found = detect(["ROUTE_NAMEE", "Route_ID", "STATION_ID", "STATION_NAMEE", "Station_Lat",
                    "STATION_LONGITUDE"])
    assert (found.route, found.name, found.station) == ("Route_ID", "ROUTE_NAMEE", "STATION_NAMEE")
    assert (found.latitude, found.longitude, found.stop_id) == (
        "Station_Lat", "STATION_LONGITUDE", "STATION_ID")
    assert detect(["a"]) == rail_reports.LightRailColumns(None, None, None, None, None, None)


def test_light_rail_fallbacks(spark):
    table = spark.createDataFrame([(str(i), "1.0") for i in range(40)], "x string, LAT string")
    assert rail_reports.light_rail_routes(table).count() == 30
    assert rail_reports.light_rail_points(table).count() == 0
    assert rows(rail_reports.light_rail_kpis(table)) == [(None, None, 40)]


FARES = ", ".join(
    f"{c} string" for c in ("SRC_STATION_NAME", "DEST_STATION_NAME", *rail_reports.FARE_COLUMNS)
)


def test_fare_lookup(spark):
    table = spark.createDataFrame(
        [("A", "B", "10", "5", "2", "2", "11.5", "6"), ("B", "A", "9", "4", "2", "2", "10", "5")],
        FARES,
    )
    assert rows(rail_reports.fare_lookup(table, "A", "B")) == [
        ("HK$ 10.0", "HK$ 5.0", "HK$ 2.0", "HK$ 2.0", "HK$ 11.5", "HK$ 6.0")
    ]
    assert rows(rail_reports.fare_lookup(table, "A", "C")) == []
    assert rows(rail_reports.fare_destinations(table, "A")) == [("B",)]


def test_event_reports_of_no_events(spark):
    none = spark.createDataFrame(
        [],
        "line string, station string, direction string, destination string, platform string,"
        " minutes_away string, is_delayed boolean, timestamp timestamp",
    )
    assert rows(event_reports.stream_kpis(none)) == [(0, 0, 0, 0, None)]
    assert rows(event_reports.latest_events(none)) == []
