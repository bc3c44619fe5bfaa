"""Marts on hand-made and random feeds, against row-by-row Python."""

from __future__ import annotations

import random

import feed_rows
import pytest
from pyspark.errors import PySparkException

from headway.operators import marts
from headway.plans import reports


def rows(df):
    return {tuple(r) for r in df.collect()}


def listed(df):
    found = [tuple(r) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def random_feed(seed: int, hot: bool):
    """Repeated trip, route and stop rows, NULLs, bad times; with ``hot`` one
    trip, route and stop each hold a third of all rows."""
    rnd = random.Random(seed)

    def pick(prefix, n):
        return f"{prefix}0" if hot and rnd.random() < 1 / 3 else f"{prefix}{rnd.randrange(n)}"

    times = ["05:10:00", "7:00:00", "10:30:00", "23:59:59", "25:00:00", "bad", "07:5:00", None]
    stop_times = [
        (pick("t", 14), pick("s", 6), rnd.choice([1, 2, 3, None]), rnd.choice(times))
        for _ in range(160)
    ]
    trips = [(pick("t", 14), pick("r", 7), "wk") for _ in range(24)]
    trips += [("t1", None, "wk"), trips[0]]
    routes = [
        (f"r{i % 6}", rnd.choice(["A", "B", None]), rnd.choice(["x", None]), rnd.choice([0, 3, None]))
        for i in range(9)
    ]
    stops = [(f"s{i % 5}", f"Stop {i % 3}", rnd.choice([22.3, None]), 114.1) for i in range(8)]
    stops.append(stops[0])
    return stop_times, trips, routes, stops


@pytest.mark.parametrize("seed,hot", [(1, False), (2, True), (3, True)])
def test_marts_equal_row_by_row_results(spark, seed, hot):
    st, tr, ro, sp = random_feed(seed, hot)
    net = feed_rows.network(spark, st, tr, ro, sp)
    assert listed(marts.stops_ranked(net)) == feed_rows.stops_ranked(st, tr, ro, sp)
    assert listed(marts.route_service_hours(net)) == feed_rows.route_service_hours(st, tr, ro)
    assert listed(marts.route_lengths(net)) == feed_rows.route_lengths(st, tr, ro)
    assert listed(marts.service_frequency(net)) == feed_rows.service_frequency(st, tr, ro)
    assert listed(marts.transfer_hubs(net, 2)) == feed_rows.transfer_hubs(st, tr, ro, sp, 2)
    for mode in (None, 3):
        assert listed(reports.departures_by_hour_of_mode(net, mode)) == (
            feed_rows.departures_by_hour(st, tr, ro, mode)
        )


def test_hubs_need_three_routes_and_show_ten_names(spark):
    routes = [(f"r{i}", f"N{i:02d}", None, 3) for i in range(12)] + [("rx", None, None, 4)]
    trips = [(f"t{r[0]}", r[0], "d") for r in routes]
    visits = [("tr0", "two", 1, None), ("tr1", "two", 1, None)]
    visits += [(f"tr{i}", "three", 1, None) for i in range(3)]
    visits += [(f"tr{i}", "many", 1, None) for i in range(11, -1, -1)] + [("trx", "many", 1, None)]
    stops = [(s, s, 22.3, 114.1) for s in ("two", "three", "many")]
    net = feed_rows.network(spark, visits, trips, routes, stops)
    hubs = {r.stop_id: r for r in marts.transfer_hubs(net).collect()}
    assert set(hubs) == {"three", "many"}
    assert hubs["three"].routes_serving == "N00,N01,N02"
    assert hubs["many"].routes_serving == ",".join(f"N{i:02d}" for i in range(10))
    assert (hubs["many"].route_count, hubs["many"].transport_modes) == (13, 2)


def test_trips_per_route_counts_repeated_rows(spark):
    net = feed_rows.network(
        spark,
        trips=[("a", "r1", "d"), ("a", "r1", "d"), ("b", "r2", "d"), ("c", "gone", "d")],
        routes=[("r1", "1", "x", 3), ("r2", "1", "x", 0), ("r2", "1", "x", 0)],
    )
    assert rows(marts.trips_per_route(net)) == {("1", "x", 4)}
    assert rows(marts.trips_by(net, "route_type")) == {(3, 2), (0, 2)}


def test_peak_hours_strict_and_lenient(spark):
    visits = [("t", "s", 1, time) for time in ("07:00:00", "7:30", "25:00:00", None)]
    net = feed_rows.network(spark, visits)
    assert rows(marts.peak_hour_analysis(net)) == {(7, 2), (25, 1)}
    broken = feed_rows.network(spark, [*visits, ("t", "s", 1, "soon")])
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        marts.peak_hour_analysis(broken).collect()
    assert rows(marts.peak_hour_analysis(broken, strict=False)) == {(7, 2), (25, 1)}


def test_weekday_vs_weekend_kinds(spark):
    calendar = [
        ("all", 5, 2),
        ("week", 5, 0),
        ("end", 0, 2),
        ("none", 0, 0),
        ("null-none", None, 0),
        ("null-end", None, 2),
    ]
    trips = [(f"t-{c[0]}", "r", c[0]) for c in calendar]
    trips += [("t-all", "r", "all"), ("t-lost", "r", "absent")]
    net = feed_rows.network(spark, trips=trips, calendar=calendar)
    assert rows(marts.weekday_vs_weekend(net)) == {
        ("Both", 1),
        ("Weekday Only", 1),
        ("Weekend Only", 2),
        ("Unknown", 2),
    }


def test_early_and_night_flags(spark):
    routes = [(r, r, None, 3) for r in ("early", "night", "both", "day")]
    trips = [(f"t{r[0]}", r[0], "d") for r in routes]
    spans = {
        "early": ("05:59:59", "10:00:00"),
        "night": ("06:00:00", "23:00:00"),
        "both": ("00:10:00", "25:10:00"),
        "day": ("06:00:00", "22:59:59"),
    }
    visits = [(f"t{r}", "s", i, time) for r, pair in spans.items() for i, time in enumerate(pair)]
    net = feed_rows.network(spark, visits, trips, routes)
    found = {
        r.route_short_name: (r.is_early_bird, r.is_night_owl, r.first_hour, r.last_hour)
        for r in marts.early_night_routes(net).collect()
    }
    assert found == {
        "early": (True, False, 5, 10),
        "night": (False, True, 6, 23),
        "both": (True, True, 0, 25),
    }


def test_longest_routes_keeps_twenty(spark):
    routes = [(f"r{i}", f"{i:02d}", None, 3) for i in range(25)]
    trips = [(f"t{i}", f"r{i}", "d") for i in range(25)]
    visits = [(f"t{i}", f"s{n}", n, None) for i in range(25) for n in range(i + 1)]
    net = feed_rows.network(spark, visits, trips, routes)
    kept = marts.longest_routes(net).collect()
    assert [r.unique_stops for r in kept] == list(range(25, 5, -1))


def test_trajectories_roll_over_midnight(spark):
    net = feed_rows.network(
        spark,
        [("t", "s", 1, "24:00:01"), ("t", "s", 2, "soon"), ("t", "nowhere", 3, "10:00:00")],
        [("t", "r", "d")],
        [("r", "1", "one", 3)],
        [("s", "Stop", 22.3, 114.1), ("nowhere", "No place", None, 114.1)],
    )
    assert rows(marts.trip_trajectories(net)) == {
        ("t", "1", "one", 1, "Stop", 22.3, 114.1, "24:00:01", 1704153601000)
    }


def test_stored_rollups_replace_computed_ones(spark):
    st, tr, ro, sp = random_feed(5, True)
    net = feed_rows.network(spark, st, tr, ro, sp)
    stored = marts.Network(
        None,
        net.trips,
        net.routes,
        net.stops,
        stored_route_trips=net.route_trips,
        stored_route_stop_rollup=net.route_stop_rollup,
    )
    for mart in (
        marts.stops_ranked,
        marts.route_service_hours,
        marts.route_lengths,
        marts.service_frequency,
        marts.early_night_routes,
        marts.transfer_hubs,
    ):
        assert listed(mart(stored)) == listed(mart(net))
