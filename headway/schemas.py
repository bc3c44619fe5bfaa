"""Logical schemas: raw text inputs, staging tables, event tables, payloads."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B, TS = (
    T.StringType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

# Members of a timetable feed and the columns staging reads.
FEED_COLUMNS: dict[str, tuple[str, ...]] = {
    "routes": ("route_id", "route_short_name", "route_long_name", "route_type"),
    "stops": ("stop_id", "stop_name", "stop_lat", "stop_lon"),
    "trips": ("trip_id", "route_id", "service_id"),
    "stop_times": ("trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time"),
    "calendar": ("service_id", *DAYS, "start_date", "end_date"),
}

# Rail files, source header -> column name in the raw tables.
# Columns that are not listed keep their source name.
RAIL_RENAMES: dict[str, dict[str, str]] = {
    "mtr_lines_stations": {
        "Line Code": "line_code",
        "Station Code": "station_code",
        "English Name": "station_name_en",
        "Chinese Name": "station_name_zh",
    },
    "mtr_bus_stops": {
        "ROUTE_ID": "route_id",
        "ROUTE_NAMEE": "route_name_en",
        "ROUTE_NAMEC": "route_name_zh",
        "DIRECTION": "direction",
        "STATION_SEQUENCE": "station_sequence",
        "STATION_ID": "station_id",
        "STATION_NAME_ENG": "station_name_en",
        "STATION_NAME_CHI": "station_name_zh",
        "STATION_LATITUDE": "latitude",
        "STATION_LONGITUDE": "longitude",
    },
    "mtr_fares": {
        "LINE": "line_code",
        "SRC_STATION_ID": "origin_station_id",
        "DST_STATION_ID": "destination_station_id",
        "CLASS": "fare_class",
        "OCT_ADT_FARE": "oct_adult_fare",
        "OCT_STD_FARE": "oct_student_fare",
        "OCT_CON_FARE": "oct_concessionary_fare",
        "SINGLE_ADT_FARE": "single_adult_fare",
        "SINGLE_STD_FARE": "single_student_fare",
        "SINGLE_CON_FARE": "single_concessionary_fare",
    },
    "mtr_light_rail_stops": {
        "ROUTE_ID": "route_id",
        "ROUTE_NAMEE": "route_name_en",
        "ROUTE_NAMEC": "route_name_zh",
        "DIRECTION": "direction",
        "STOP_SEQUENCE": "stop_sequence",
        "STATION_ID": "station_id",
        "STATION_NAMEE": "station_name_en",
        "STATION_NAMEC": "station_name_zh",
        "STATION_LATITUDE": "latitude",
        "STATION_LONGITUDE": "longitude",
    },
}

STAGING: dict[str, T.StructType] = {
    "stg_routes": _struct(route_id=S, route_short_name=S, route_long_name=S, route_type=L),
    "stg_stops": _struct(stop_id=S, stop_name=S, latitude=D, longitude=D),
    "stg_trips": _struct(trip_id=S, route_id=S, service_id=S),
    "stg_stop_times": _struct(
        trip_id=S, stop_id=S, stop_sequence=L, arrival_time=S, departure_time=S
    ),
    "stg_calendar": _struct(
        service_id=S,
        **{day: L for day in DAYS},
        start_date=S,
        end_date=S,
        weekday_count=L,
        weekend_count=L,
    ),
}

RAIL_EVENT = _struct(
    event_type=S,
    line=S,
    station=S,
    direction=S,
    destination=S,
    platform=S,
    arrival_time=S,
    minutes_away=S,
    is_delayed=B,
    timestamp=TS,
)

BUS_EVENT = _struct(
    event_type=S,
    stop_id=S,
    route=S,
    direction=S,
    service_type=S,
    destination_en=S,
    destination_tc=S,
    eta_seq=L,
    eta=S,
    timestamp=TS,
)

_TRAINS = T.ArrayType(_struct(seq=S, dest=S, plat=S, time=S, ttnt=S, valid=S))

# A schedule answer: data maps "LINE-STATION" to the trains of both directions.
SCHEDULE_PAYLOAD = _struct(
    status=L,
    isdelay=S,
    curr_time=S,
    message=S,
    data=T.MapType(S, _struct(UP=_TRAINS, DOWN=_TRAINS)),
)

ETA_PAYLOAD = _struct(
    data=T.ArrayType(
        _struct(route=S, dir=S, service_type=S, dest_en=S, dest_tc=S, eta_seq=S, eta=S)
    )
)
