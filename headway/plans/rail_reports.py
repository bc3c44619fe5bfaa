"""Rail network reports over the rail files or the raw tables loaded from them.

Reports name columns by the source headers; raw tables get these back first.

Where a report takes the first of several rows, it means the first in file
order if the table was read with it (``feed.with_file_order``), else the
lowest values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions import labels
from headway.schemas import SCHEDULE_PAYLOAD
from headway.sources.feed import FILE_ORDER, source_headers
from headway.sources.payloads import intact_payloads, parse_payload, schedule_trains

LINE, STATION = "Line Code", "Station Code"


LINES, FARES, STOPS = "mtr_lines_stations", "mtr_fares", "mtr_light_rail_stops"


def _order(df: DataFrame, *values: str) -> Column:
    return F.col(FILE_ORDER) if FILE_ORDER in df.columns else F.struct(*values)


def stations_per_line(lines: DataFrame) -> DataFrame:
    """Heavy-rail lines by number of stations."""
    return (
        source_headers(lines, LINES)
        .na.drop(subset=[LINE, STATION])
        .groupBy(F.trim(F.col(LINE)).alias("line_code"))
        .agg(F.countDistinct(F.col(STATION)).alias("stations"))
        .select(
            "line_code", labels.line_name(F.col("line_code")).alias("line_name"), "stations"
        )
        .orderBy(F.desc("stations"), "line_code")
    )


def heavy_rail_kpis(lines: DataFrame) -> DataFrame:
    """Lines, stations and the line with the most stations ("N/A" if none)."""
    pairs = (
        source_headers(lines, LINES)
        .na.drop(subset=[LINE, STATION])
        .select(F.trim(F.col(LINE)).alias("line_code"), F.col(STATION).alias("station_code"))
        .distinct()
    )
    stations = pairs.agg(F.countDistinct("station_code").alias("stations"))
    per_line = pairs.groupBy("line_code").agg(F.count(F.lit(1)).alias("stations"))
    largest = F.min_by("line_code", F.struct(-F.col("stations"), "line_code"))
    return per_line.agg(
        F.count(F.lit(1)).alias("lines"), largest.alias("largest")
    ).select(
        "lines",
        stations.scalar().alias("stations"),
        F.coalesce(labels.line_name(F.col("largest")), F.lit("N/A")).alias("largest_line"),
    )


def network_size(lines: DataFrame) -> DataFrame:
    """Distinct line and station codes as they stand in the file; 10 lines and
    98 stations (fixed values) where the column is missing."""
    lines = source_headers(lines, LINES)

    def distinct(column: str, fallback: int) -> Column:
        if column in lines.columns:
            return F.countDistinct(F.col(column))
        return F.lit(fallback).cast("bigint")

    return lines.agg(
        distinct(LINE, 10).alias("lines"), distinct(STATION, 98).alias("stations")
    )


def mean_fares(fares: DataFrame) -> DataFrame:
    """Mean adult card fare per line, two decimals (half to even). No rows if
    the file lacks a column that is needed."""
    fares = source_headers(fares, FARES)
    if not {"LINE", "OCT_ADT_FARE"} <= set(fares.columns):
        return fares.sparkSession.createDataFrame(
            [], "line_code string, mean_fare double, line_name string"
        )
    return (
        fares.where("LINE is not null")
        .groupBy(F.col("LINE").alias("line_code"))
        .agg((F.rint(F.avg(F.col("OCT_ADT_FARE").cast("double")) * 100) / 100).alias("mean_fare"))
        .withColumn("line_name", labels.line_name(F.col("line_code")))
        .orderBy(F.desc_nulls_last("mean_fare"), "line_code")
    )


@dataclass(frozen=True)
class LightRailColumns:
    """Columns found by name patterns; None where no header fits."""

    route: str | None
    name: str | None
    station: str | None
    latitude: str | None
    longitude: str | None
    stop_id: str | None

    @classmethod
    def detect(cls, columns: list[str]) -> LightRailColumns:
        """The first fitting header of each kind, in file order."""

        def first(*patterns: tuple[str, ...], without: str = "\n") -> str | None:
            for column in columns:
                upper = column.upper()
                fits = any(all(part in upper for part in parts) for parts in patterns)
                if fits and without not in upper:
                    return column
            return None

        # A header fits if it contains all parts of one tuple.
        return cls(
            route=first(("ROUTE",), without="NAME"),
            name=first(("NAMEE",), ("NAME", "ENG")),
            station=first(("STATION", "NAME", "ENG"), ("STATION", "NAMEE")),
            latitude=first(("LAT",)),
            longitude=first(("LON",)),
            stop_id=first(("STATION_ID",), ("STOP_ID",)),
        )


def light_rail_kpis(stops: DataFrame) -> DataFrame:
    """Routes and stops; ``stop_records`` stands in where there is no stop id."""
    stops = source_headers(stops, STOPS)
    found = LightRailColumns.detect(stops.columns)
    none = F.lit(None).cast("bigint")
    routes = F.countDistinct(F.trim(F.col(found.route))) if found.route else none
    distinct_stops = F.countDistinct(F.col(found.stop_id)) if found.stop_id else none
    records = F.count(F.lit(1)) if found.latitude and not found.stop_id else none
    return stops.agg(
        routes.alias("routes"), distinct_stops.alias("stops"), records.alias("stop_records")
    )


def light_rail_routes(stops: DataFrame, preview: int = 30) -> DataFrame:
    """Stops per route; without the columns for it, the first rows as they are,
    in file order or else by their values."""
    given, stops = stops, source_headers(stops, STOPS)
    found = LightRailColumns.detect(stops.columns)
    if not (found.route and found.stop_id):
        shown = [c for c in given.columns if c != FILE_ORDER]
        order = [FILE_ORDER] if FILE_ORDER in given.columns else shown
        return given.orderBy(*[F.col(f"`{c}`") for c in order]).limit(preview).drop(FILE_ORDER)
    return (
        stops.where(F.col(found.route).isNotNull())
        .groupBy(F.col(found.route).alias("route"))
        .agg(F.countDistinct(F.col(found.stop_id)).alias("stops"))
        .orderBy(F.desc("stops"), "route")
    )


def light_rail_points(stops: DataFrame) -> DataFrame:
    """One point per stop, from its first row; no rows if the file has no
    coordinates or stop ids. A minimum per stop combines before the shuffle."""
    stops = source_headers(stops, STOPS)
    found = LightRailColumns.detect(stops.columns)
    if not (found.latitude and found.longitude and found.stop_id):
        return stops.sparkSession.createDataFrame(
            [], "stop_id string, name string, latitude double, longitude double"
        )
    name = F.col(found.station) if found.station else F.lit(None).cast("string")
    located = stops.select(
        F.col(found.stop_id).alias("stop_id"),
        name.alias("name"),
        F.col(found.latitude).cast("double").alias("latitude"),
        F.col(found.longitude).cast("double").alias("longitude"),
        *[c for c in stops.columns if c == FILE_ORDER],
    ).na.drop(subset=["latitude", "longitude"])
    values = ("name", "latitude", "longitude")
    first = located.groupBy("stop_id").agg(
        F.min_by(F.struct(*values), _order(located, *values)).alias("point")
    )
    return first.select("stop_id", "point.*")


def line_picker(lines: DataFrame) -> DataFrame:
    """Sorted line codes with their labels, "Island Line (ISL)"."""
    lines = source_headers(lines, LINES)
    codes = lines.where("`Line Code` is not null").select(F.col(LINE).alias("line_code")).distinct()
    label = F.format_string("%s (%s)", labels.line_name(F.col("line_code")), "line_code")
    return codes.select("line_code", label.alias("label")).orderBy("line_code")


def station_picker(lines: DataFrame, line: str) -> DataFrame:
    """Stations of a line in order of their first row, each once, with labels
    "English Chinese (CODE)". Rows without a station code cannot be looked up
    and are left out."""
    lines = source_headers(lines, LINES)
    values = ("English Name", "Chinese Name", STATION)
    order = _order(lines, *values)
    names = (
        lines.where((F.col(LINE) == F.lit(line)) & F.col(STATION).isNotNull())
        .groupBy(F.col(STATION).alias("station_code"))
        .agg(F.min_by(F.struct(*values), order).alias("first"), F.min(order).alias("order"))
    )
    label = F.format_string(
        "%s %s (%s)", F.col("first.English Name"), F.col("first.Chinese Name"), "station_code"
    )
    return names.orderBy("order", "station_code").select("station_code", label.alias("label"))


def next_trains(answers: DataFrame, line: str, station: str, payload: str = "payload") -> DataFrame:
    """Valid trains per direction at a station, from its newest answer: the
    one observed last (``observed_at``) where that is known, then the one with
    the newest ``curr_time``. A refused answer counts and has no trains;
    answers equal in age are all shown."""
    if {"line", "station"} <= set(answers.columns):
        asked = (F.col("line") == F.lit(line)) & (F.col("station") == F.lit(station))
    else:
        asked = F.map_contains_key("answer.data", F.lit(f"{line}-{station}"))
    observed = [c for c in answers.columns if c == "observed_at"]
    own = (
        intact_payloads(answers, SCHEDULE_PAYLOAD, payload)
        .where(asked)
        .withColumn("age", F.struct(*observed, "answer.curr_time"))
    )
    newest = own.agg(F.max("age").alias("age"))
    current = own.where(F.col("age").eqNullSafe(newest.scalar()))
    kept = current.select(*[c for c in answers.columns if c not in ("line", "station")])
    return (
        schedule_trains(kept, payload)
        .where((F.col("line") == F.lit(line)) & (F.col("station") == F.lit(station)))
        .select(
            "direction",
            F.col("seq"),
            F.col("dest").alias("destination"),
            F.col("plat").alias("platform"),
            F.col("time").alias("arrival_time"),
            F.col("ttnt").alias("minutes_away"),
        )
    )


def schedule_status(answers: DataFrame, payload: str = "payload") -> DataFrame:
    """Per answer: time, delay flag, and the error text if it failed."""
    answer = parse_payload(answers, SCHEDULE_PAYLOAD, payload)
    ok = F.coalesce(F.col("answer.status") == 1, F.lit(False))
    return answer.select(
        ok.alias("ok"),
        F.when(ok, F.coalesce("answer.curr_time", F.lit("N/A"))).alias("curr_time"),
        (ok & F.coalesce(F.col("answer.isdelay") == "Y", F.lit(False))).alias("is_delayed"),
        F.when(~ok, F.coalesce("answer.message", F.lit("Unknown error"))).alias("error"),
    )


def fare_origins(fares: DataFrame) -> DataFrame:
    return (
        source_headers(fares, FARES)
        .where("SRC_STATION_NAME is not null")
        .select(F.col("SRC_STATION_NAME").alias("station"))
        .distinct()
        .orderBy("station")
    )


def fare_destinations(fares: DataFrame, origin: str) -> DataFrame:
    """All stations but the origin."""
    return fare_origins(fares).where(F.col("station") != F.lit(origin))


# Fare columns of the file and their names in the report.
FARE_COLUMNS = {
    "OCT_ADT_FARE": "card_adult",
    "OCT_CON_CHILD_FARE": "card_child_elderly",
    "OCT_CON_PWD_FARE": "card_disabled",
    "OCT_JOYYOU_SIXTY_FARE": "card_sixty",
    "SINGLE_ADT_FARE": "single_adult",
    "SINGLE_CON_CHILD_FARE": "single_child_elderly",
}


def fare_lookup(fares: DataFrame, origin: str, destination: str) -> DataFrame:
    """Fares of one trip as text, from the first row of the pair."""
    fares = source_headers(fares, FARES)
    pair = fares.where(
        (F.col("SRC_STATION_NAME") == F.lit(origin))
        & (F.col("DEST_STATION_NAME") == F.lit(destination))
    )
    first = pair.orderBy(_order(pair, *FARE_COLUMNS)).limit(1)
    return first.select(
        *[labels.fare_text(F.col(source)).alias(name) for source, name in FARE_COLUMNS.items()]
    )

