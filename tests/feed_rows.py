"""Small hand-made feeds, and the marts computed row by row in Python."""

from __future__ import annotations

import re
from collections import defaultdict

from headway.operators.marts import Network
from headway.schemas import STAGING

VALID = re.compile(r"\d+:\d{2}:\d{2}")


def network(spark, stop_times=(), trips=(), routes=(), stops=(), calendar=()) -> Network:
    def frame(table, rows):
        return spark.createDataFrame([tuple(r) for r in rows], STAGING[table])

    full_calendar = [(s, *([None] * 7), None, None, wd, we) for s, wd, we in calendar]
    return Network(
        stop_times=frame("stg_stop_times", [(t, s, n, None, d) for t, s, n, d in stop_times]),
        trips=frame("stg_trips", trips),
        routes=frame("stg_routes", routes),
        stops=frame("stg_stops", stops),
        calendar=frame("stg_calendar", full_calendar),
    )


def joined(stop_times, trips, routes):
    """(stop time, trip, route) for every match of the two inner joins."""
    for visit in stop_times:
        for trip in trips:
            if trip[0] == visit[0]:
                for route in routes:
                    if route[0] == trip[1]:
                        yield visit, trip, route


def is_valid(time):
    return time is not None and VALID.fullmatch(time) is not None


def stops_ranked(stop_times, trips, routes, stops):
    count, mode = defaultdict(int), defaultdict(set)
    for visit, _, route in joined(stop_times, trips, routes):
        for stop in stops:
            if stop[0] == visit[1]:
                count[stop] += 1
                mode[stop].add(route[3])
    return {
        (*stop, n, min((m for m in mode[stop] if m is not None), default=None))
        for stop, n in count.items()
    }


def route_service_hours(stop_times, trips, routes):
    times, ids, served = defaultdict(list), defaultdict(set), defaultdict(set)
    for visit, trip, route in joined(stop_times, trips, routes):
        if is_valid(visit[3]):
            group = route[1:]
            times[group].append(visit[3])
            ids[group].add(trip[0])
            served[group].add(visit[1])
    return {
        (*g, min(t), max(t), len(ids[g]), len(served[g])) for g, t in times.items()
    }


def route_lengths(stop_times, trips, routes):
    ids, served, last = defaultdict(set), defaultdict(set), defaultdict(list)
    for visit, trip, route in joined(stop_times, trips, routes):
        ids[route[1:]].add(trip[0])
        served[route[1:]].add(visit[1])
        last[route[1:]].append(visit[2])
    return {
        (*g, len(served[g]), len(ids[g]), max((n for n in last[g] if n is not None), default=None))
        for g in ids
    }


def service_frequency(stop_times, trips, routes):
    ids = defaultdict(set)
    for visit, trip, route in joined(stop_times, trips, routes):
        if is_valid(visit[3]) and 0 <= int(visit[3].split(":")[0]) <= 23:
            ids[(route[1], route[3], int(visit[3].split(":")[0]))].add(trip[0])
    return {(*g, len(t)) for g, t in ids.items()}


def transfer_hubs(stop_times, trips, routes, stops, least):
    ids, modes, names = defaultdict(set), defaultdict(set), defaultdict(set)
    for visit, _, route in joined(stop_times, trips, routes):
        for stop in stops:
            if stop[0] == visit[1] and stop[2] is not None and stop[3] is not None:
                ids[stop].add(route[0])
                modes[stop].add(route[3])
                names[stop].add(route[1])
    hubs = set()
    for stop in ids:
        if len(ids[stop]) >= least:
            shown = sorted(n for n in names[stop] if n is not None)[:10]
            known = modes[stop] - {None}
            hubs.add((*stop, len(ids[stop]), len(known), ",".join(shown) if shown else None))
    return hubs


def departures_by_hour(stop_times, trips, routes, mode):
    hours = defaultdict(int)
    for visit, _, route in joined(stop_times, trips, routes):
        if is_valid(visit[3]) and int(visit[3].split(":")[0]) <= 23:
            if mode is None or route[3] == mode:
                hours[int(visit[3].split(":")[0])] += 1
    return set(hours.items())
