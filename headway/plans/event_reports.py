"""Reports over the stored rail events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import labels
from headway.streaming import live


def stream_kpis(events: DataFrame) -> DataFrame:
    """One row over all events. They are first counted per (line, station), a
    small table, so counting two distinct columns copies no event rows."""
    return live.kpis(live.stations(events))


def events_per_line(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("line")
        .agg(F.count(F.lit(1)).alias("events"), F.count_if("is_delayed").alias("delays"))
        .withColumn("line_name", labels.short_line_name(F.col("line")))
        .orderBy(F.desc("events"), "line")
    )


def events_per_minute(events: DataFrame) -> DataFrame:
    return (
        events.groupBy(F.date_trunc("minute", "timestamp").alias("minute"))
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy("minute")
    )


def direction_split(events: DataFrame) -> DataFrame:
    return events.groupBy("direction").agg(F.count(F.lit(1)).alias("events"))


def top_destinations(events: DataFrame, n: int = 10) -> DataFrame:
    return (
        events.where("destination is not null")
        .groupBy("destination")
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy(F.desc("events"), "destination")
        .limit(n)
    )


def latest_events(events: DataFrame, n: int = 20) -> DataFrame:
    shown = (
        "timestamp",
        "line",
        "station",
        "direction",
        "destination",
        "platform",
        "minutes_away",
        "is_delayed",
    )
    return events.select(*shown).orderBy(F.desc("timestamp"), *shown[1:]).limit(n)
