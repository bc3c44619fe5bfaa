"""Transit tables derived from a star schema (orders, customers, ...).

Lets every operator run over ordinary warehouse tables: customers act as
routes, orders as trips, line items as stop times, suppliers as stops and
click events as rail events. All of it is projection, but for stop times, which
join line items to orders; the derived tables grow with their sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators import staging
from headway.operators.marts import Network
from headway.schemas import DAYS
from headway.sources.topics import BUS_TOPIC, RAIL_TOPIC
from headway.streaming.codec import encode

LINES = ("TML", "TCL", "KTL", "TWL", "ISL", "EAL", "AEL", "SIL", "TKL", "DRL")

# Day flags per order priority: all days, Monday to Friday, weekends, none.
_SERVICE_DAYS = {
    "1-URGENT": (1, 1, 1, 1, 1, 1, 1),
    "2-HIGH": (1, 1, 1, 1, 1, 0, 0),
    "3-MEDIUM": (0, 0, 0, 0, 0, 1, 1),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as string) route_id",
        "concat('R', cast(c_custkey % 120 as string)) route_short_name",
        "concat(c_mktsegment, ' line') route_long_name",
        "cast(case c_nationkey % 10 when 0 then 0 when 1 then 4 when 2 then 7 else 3 end"
        " as bigint) route_type",
    )


def _stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey as string) stop_id",
        "s_name stop_name",
        "case when s_suppkey % 50 = 7 then null"
        " else cast(22300 + (s_suppkey * 37) % 60 as double) / 1000.0D end latitude",
        "cast(114100 + (s_suppkey * 53) % 55 as double) / 1000.0D longitude",
    )


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) trip_id",
        "cast(o_custkey as string) route_id",
        "o_orderpriority service_id",
    )


def _stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours 00-25 that depend on the route; about 1 in 97 times is NULL."""
    owners = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey"
    )
    departure = (
        "case when l_partkey % 97 = 0 then null else concat("
        "lpad(cast((o_custkey % 12) * 2 + l_linenumber % 4 as string), 2, '0'), ':',"
        "lpad(cast(l_partkey % 60 as string), 2, '0'), ':',"
        "lpad(cast((l_partkey + l_suppkey) % 60 as string), 2, '0')) end"
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(owners, "l_orderkey")
        .selectExpr(
            "cast(l_orderkey as string) trip_id",
            "cast(l_suppkey as string) stop_id",
            "cast(l_linenumber as bigint) stop_sequence",
            f"{departure} arrival_time",
            f"{departure} departure_time",
        )
    )


def _calendar_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'5-LOW' has no calendar row; other priorities have no service day."""
    days = table(spark, sf_dir, "orders").where("o_orderpriority <> '5-LOW'")
    flags = []
    for position, day in enumerate(DAYS):
        running = [p for p, pattern in _SERVICE_DAYS.items() if pattern[position]]
        flags.append(F.col("service_id").isin(running).cast("bigint").alias(day))
    return days.select(F.col("o_orderpriority").alias("service_id")).distinct().select(
        "service_id",
        *flags,
        F.lit("20240101").alias("start_date"),
        F.lit("20241231").alias("end_date"),
    )


def raw_feed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five feed members, all columns as text as a CSV scan gives them."""
    members = {
        "routes": _routes(spark, sf_dir),
        "stops": _stops(spark, sf_dir).withColumnsRenamed(
            {"latitude": "stop_lat", "longitude": "stop_lon"}
        ),
        "trips": _trips(spark, sf_dir),
        "stop_times": _stop_times(spark, sf_dir),
        "calendar": _calendar_flags(spark, sf_dir),
    }
    return {
        name: df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
        for name, df in members.items()
    }


def spoiled_feed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The feed with some malformed values and missing keys in each member but
    the stops, which lack a key only."""

    def spoil(member: str, column: str, condition: str, text: str | None) -> None:
        bad = F.lit(text).cast("string")
        feed[member] = feed[member].withColumn(
            column, F.when(F.expr(condition), bad).otherwise(F.col(column))
        )

    feed = raw_feed(spark, sf_dir)
    spoil("routes", "route_type", "cast(route_id as bigint) % 37 = 0", "bus?")
    spoil("routes", "route_id", "cast(route_id as bigint) % 101 = 0", None)
    spoil("stops", "stop_id", "cast(stop_id as bigint) % 23 = 0", None)
    spoil("trips", "trip_id", "cast(trip_id as bigint) % 61 = 0", None)
    spoil("stop_times", "stop_sequence", "cast(trip_id as bigint) % 43 = 0", "1st")
    spoil("stop_times", "departure_time", "cast(stop_id as bigint) % 29 = 0", "noon")
    spoil("calendar", "monday", "service_id = '2-HIGH'", "yes")
    return feed


def network(spark: SparkSession, sf_dir: str) -> Network:
    """Staging tables of the derived feed."""
    calendar = _calendar_flags(spark, sf_dir)
    return Network(
        stop_times=_stop_times(spark, sf_dir),
        trips=_trips(spark, sf_dir),
        routes=_routes(spark, sf_dir),
        stops=_stops(spark, sf_dir),
        calendar=staging.calendar(calendar),
    )


def _pick_line(number: str) -> str:
    names = ", ".join(f"'{line}'" for line in LINES)
    return f"element_at(array({names}), cast({number} % 10 + 1 as int))"


def as_rail_events(events: DataFrame, *kept: str) -> DataFrame:
    """Click events as rail events; works on a stream as well."""
    return events.selectExpr(
        *kept,
        "'mtr_schedule' event_type",
        f"{_pick_line('user_id')} line",
        "concat('S', cast(user_id % 7 as string)) station",
        "case when event_id % 2 = 0 then 'UP' else 'DOWN' end direction",
        "case when event_type = 'view' then null"
        " else concat('D', cast(user_id % 13 as string)) end destination",
        "cast(user_id % 4 + 1 as string) platform",
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss') arrival_time",
        "cast(event_id % 15 as string) minutes_away",
        "event_type = 'error' is_delayed",
        "cast(ts as timestamp) timestamp",
    )


def rail_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_rail_events(table(spark, sf_dir, "events"))


def stream_rail_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as a stream over the events table, a file or a folder
    of part files; an error where there is none."""
    table(spark, sf_dir, "events")
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"
    return as_rail_events(
        spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    )


def bus_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bus arrival events."""
    return table(spark, sf_dir, "orders").selectExpr(
        "'bus_eta' event_type",
        "concat('B', cast(o_custkey % 50 as string)) stop_id",
        "cast(o_custkey % 120 as string) route",
        "case when o_orderkey % 2 = 0 then 'O' else 'I' end direction",
        "cast(o_orderkey % 3 as string) service_type",
        "o_orderpriority destination_en",
        "cast(null as string) destination_tc",
        "o_orderkey % 4 eta_seq",
        "date_format(o_orderdate, 'yyyy-MM-dd') eta",
        "cast(o_orderdate as timestamp) timestamp",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic messages of both kinds; some are cut short (not JSON any more),
    some empty, and some belong to another topic."""
    rail = encode(rail_events(spark, sf_dir), RAIL_TOPIC)
    bus = encode(bus_events(spark, sf_dir), BUS_TOPIC)
    events = table(spark, sf_dir, "events")
    spoiled = encode(as_rail_events(events.where("event_id % 50 = 0")), RAIL_TOPIC).select(
        "topic", "key", F.expr("substr(value, 1, length(value) - 5)").alias("value")
    )
    empty = encode(as_rail_events(events.where("event_id % 80 = 0")), RAIL_TOPIC).select(
        "topic", "key", F.lit(None).cast("binary").alias("value")
    )
    other = encode(as_rail_events(events.where("event_id % 70 = 0")), "other")
    return rail.unionAll(bus).unionAll(spoiled).unionAll(empty).unionAll(other)


def schedule_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One schedule answer per event, as (observed_at, payload).

    Every 11th is refused, every 101st cut short; each lists two trains in one
    direction, of which the second is not valid for every third event.
    """
    trains = (
        "array("
        "named_struct('seq', '1', 'dest', destination, 'plat', platform,"
        " 'time', arrival_time, 'ttnt', minutes_away, 'valid', 'Y'),"
        "named_struct('seq', '2', 'dest', destination, 'plat', platform,"
        " 'time', arrival_time, 'ttnt', minutes_away,"
        " 'valid', if(event_id % 3 = 0, 'N', 'Y')))"
    )
    answer = (
        "to_json(named_struct("
        "'status', if(event_id % 11 = 0, 0, 1),"
        "'isdelay', if(is_delayed, 'Y', 'N'),"
        "'curr_time', arrival_time,"
        "'message', if(event_id % 22 = 0, 'refused', null),"
        "'data', map(concat(line, '-', station), named_struct("
        f"'UP', if(direction = 'UP', {trains}, null),"
        f"'DOWN', if(direction = 'DOWN', {trains}, null)))))"
    )
    return (
        as_rail_events(table(spark, sf_dir, "events"), "event_id")
        .withColumn("text", F.expr(answer))
        .selectExpr(
            "timestamp observed_at",
            "if(event_id % 101 = 0, substr(text, 1, length(text) - 5), text) payload",
        )
    )


def eta_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One arrival answer per order, as (stop_id, observed_at, payload): one
    item with a time, one with an empty and one without."""
    def item(seq: int, eta: str) -> str:
        return (
            "named_struct('route', route, 'dir', direction, 'service_type', service_type,"
            f" 'dest_en', destination_en, 'dest_tc', destination_tc, 'eta_seq', {seq},"
            f" 'eta', {eta})"
        )

    items = f"array({item(1, 'eta')}, {item(2, repr(''))}, {item(3, 'cast(null as string)')})"
    return bus_events(spark, sf_dir).selectExpr(
        "stop_id", "timestamp observed_at", f"to_json(named_struct('data', {items})) payload"
    )


def rail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as rows of the rail lines file; some codes carry a blank or
    are missing."""
    code = _pick_line("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        F.expr(
            f"case when c_custkey % 41 = 0 then null when c_custkey % 5 = 0"
            f" then concat({code}, ' ') else {code} end"
        ).alias("Line Code"),
        F.expr(
            "case when c_custkey % 43 = 0 then null"
            " else concat('S', cast(c_custkey % 97 as string)) end"
        ).alias("Station Code"),
        F.expr("concat('Station ', cast(c_custkey % 97 as string))").alias("English Name"),
        F.expr("concat('站', cast(c_custkey % 97 as string))").alias("Chinese Name"),
    )


def rail_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as rows of the fares file, fares as text."""

    def fare(offset: int) -> str:
        return f"cast((l_partkey % 300 + {offset}) / 10.0D as string)"

    return table(spark, sf_dir, "lineitem").selectExpr(
        f"case when l_suppkey % 37 = 5 then null else {_pick_line('l_suppkey')} end LINE",
        "concat('Station ', cast(l_suppkey % 97 as string)) SRC_STATION_NAME",
        "concat('Station ', cast(l_partkey % 97 as string)) DEST_STATION_NAME",
        f"{fare(40)} OCT_ADT_FARE",
        f"{fare(20)} OCT_CON_CHILD_FARE",
        f"{fare(10)} OCT_CON_PWD_FARE",
        f"{fare(5)} OCT_JOYYOU_SIXTY_FARE",
        f"{fare(50)} SINGLE_ADT_FARE",
        f"{fare(25)} SINGLE_CON_CHILD_FARE",
    )


def light_rail_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as rows of the light-rail file; every 50th stop has no
    latitude."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "case when l_orderkey % 31 = 0 then null"
        " else cast(l_orderkey % 12 + 500 as string) end ROUTE_ID",
        "concat('Route ', cast(l_orderkey % 12 + 500 as string)) ROUTE_NAMEE",
        "case when l_linenumber % 2 = 0 then '1' else '2' end DIRECTION",
        "cast(l_linenumber as string) STOP_SEQUENCE",
        "cast(l_suppkey as string) STATION_ID",
        "concat('Stop ', cast(l_suppkey as string)) STATION_NAMEE",
        "case when l_suppkey % 50 = 7 then null"
        " else cast(cast(22300 + (l_suppkey * 37) % 60 as double) / 1000.0D as string) end"
        " STATION_LATITUDE",
        "cast(cast(114100 + (l_suppkey * 53) % 55 as double) / 1000.0D as string)"
        " STATION_LONGITUDE",
    )
