"""Aggregates over a running event stream.

``store`` appends the events to a table; reports over that table are complete
and exact at any time, late events included. The functions below are the same
counts as streaming state, for sinks that take updates; all group on few keys
or on minutes, so their state stays small. They also run on batch tables, with
equal results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.functions import labels


def store(
    events: DataFrame, path: str, checkpoint: str, every: str | None = None, files: int = 4
) -> StreamingQuery:
    """Appends a stream of events to the Parquet table at ``path``, each once, in
    at most ``files`` files a batch; options of the source bound what a batch reads.
    Without ``every`` it stores what is there and stops."""
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        events.repartition(files, F.xxhash64(*events.columns))
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def events_per_line(events: DataFrame) -> DataFrame:
    """For update or complete mode."""
    counts = events.groupBy("line").agg(
        F.count(F.lit(1)).alias("events"), F.count_if("is_delayed").alias("delays")
    )
    return counts.withColumn("line_name", labels.short_line_name(F.col("line")))


def direction_split(events: DataFrame) -> DataFrame:
    """For update or complete mode."""
    return events.groupBy("direction").agg(F.count(F.lit(1)).alias("events"))


def events_per_minute(events: DataFrame, lateness: str | None = None) -> DataFrame:
    """For update or complete mode. All minutes stay in the state, half a
    million a year, so late events count. With a ``lateness`` ("10 minutes")
    the state is dropped after it, later events are lost, and append mode,
    which then works too, holds back minutes that can still change."""
    kept = events if lateness is None else events.withWatermark("timestamp", lateness)
    return (
        kept.groupBy(F.window("timestamp", "1 minute"))
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("window.start").alias("minute"), "events")
    )


def top_destinations(events: DataFrame, n: int = 10) -> DataFrame:
    """For complete mode, the only one in which a stream may be sorted."""
    return (
        events.where("destination is not null")
        .groupBy("destination")
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy(F.desc("events"), "destination")
        .limit(n)
    )


def stations(events: DataFrame) -> DataFrame:
    """State of ``kpis``: one row per line and station. For update or complete
    mode; a stream cannot count distinct values exactly in one step."""
    return events.groupBy("line", "station").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("is_delayed").alias("delays"),
        F.max("timestamp").alias("last_updated"),
    )


def kpis(pairs: DataFrame) -> DataFrame:
    """Totals and exact distinct counts from the rows of ``stations``."""
    return pairs.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"),
        F.countDistinct("line").alias("lines_tracked"),
        F.countDistinct("station").alias("stations_tracked"),
        F.coalesce(F.sum("delays"), F.lit(0)).alias("delayed_events"),
        F.max("last_updated").alias("last_updated"),
    )
