"""Raw text tables -> typed staging tables.

Casts are strict by default: malformed input fails the query. With
``strict=False`` it becomes NULL. ``operators.rejects`` sets such rows apart instead.
"""

from __future__ import annotations

from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.schemas import DAYS, STAGING


# Rows without these have no place in the table.
KEYS = {
    "stg_routes": ("route_id",),
    "stg_stops": ("stop_id",),
    "stg_trips": ("trip_id",),
    "stg_stop_times": ("trip_id", "stop_id"),
    "stg_calendar": ("service_id",),
}
# Columns that are read from a raw column of another name.
SOURCES = {"stg_stops": {"latitude": "stop_lat", "longitude": "stop_lon"}}
TOTALS = {"weekday_count": DAYS[:5], "weekend_count": DAYS[5:]}


def cast_columns(table: str) -> dict[str, tuple[str, T.DataType]]:
    """Column -> the raw column and the type it is cast to."""
    sources = SOURCES.get(table, {})
    return {
        field.name: (sources.get(field.name, field.name), field.dataType)
        for field in STAGING[table].fields
        if field.name not in TOTALS
    }


def columns(table: str, strict: bool = True) -> list[Column]:
    """The table's columns over its raw columns. Calendars also have the number of
    service days from Monday to Friday and at weekends, NULL if a flag is NULL."""

    def typed(name: str) -> Column:
        raw, kind = casts[name]
        return F.col(raw).cast(kind) if strict else F.col(raw).try_cast(kind)

    casts = cast_columns(table)
    found = [typed(name).alias(name) for name in casts]
    if table == "stg_calendar":
        found += [reduce(add, map(typed, days)).alias(name) for name, days in TOTALS.items()]
    return found


def keyed(table: str) -> Column:
    return reduce(and_, [F.col(key).isNotNull() for key in KEYS[table]])


def _stage(table: str, raw: DataFrame, strict: bool) -> DataFrame:
    return raw.where(keyed(table)).select(*columns(table, strict))


def routes(raw: DataFrame, strict: bool = True) -> DataFrame:
    return _stage("stg_routes", raw, strict)


def stops(raw: DataFrame, strict: bool = True) -> DataFrame:
    return _stage("stg_stops", raw, strict)


def trips(raw: DataFrame, strict: bool = True) -> DataFrame:
    return _stage("stg_trips", raw, strict)


def stop_times(raw: DataFrame, strict: bool = True) -> DataFrame:
    return _stage("stg_stop_times", raw, strict)


def calendar(raw: DataFrame, strict: bool = True) -> DataFrame:
    return _stage("stg_calendar", raw, strict)


BUILDERS = {
    "stg_routes": ("routes", routes),
    "stg_stops": ("stops", stops),
    "stg_trips": ("trips", trips),
    "stg_stop_times": ("stop_times", stop_times),
    "stg_calendar": ("calendar", calendar),
}


def stage(raw: dict[str, DataFrame], strict: bool = True) -> dict[str, DataFrame]:
    """Staging tables for those feed members that are there."""
    return {
        table: build(raw[member], strict)
        for table, (member, build) in BUILDERS.items()
        if member in raw
    }
