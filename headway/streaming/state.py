"""Live reports from small stored counts that each micro-batch adds to.

A batch is reduced to counts per key, merged with the stored counts, and all of them are
committed together with the number of the batch (``sources.snapshots``). A batch that
is run again after a crash finds its number and adds nothing; one that died before
its commit has left nothing. A run reads the new events and the counts, not the
events before them, so it costs the same however long the stream has run.

Counts per line and station, direction and destination have a row for each key. Those
per minute grow with time, so each day of them is a part of its own: a batch
reads and writes only the days it has events of, and days that are over rest in their
files. A late event, however late, changes its minute by rewriting its one day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.functions import labels
from headway.sources import snapshots
from headway.sources.snapshots import PART, Snapshot
from headway.streaming import live

PAIRS, DIRECTIONS, DESTINATIONS = "live_pairs", "live_directions", "live_destinations"
MINUTES = "live_minutes"
KEYS = {PAIRS: ("line", "station"), DIRECTIONS: ("direction",), DESTINATIONS: ("destination",)}
#: The last batch that the counts hold.
LAST_BATCH = "live batch"

def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("events").alias("events"),
        F.sum("delays").alias("delays"),
        F.max("last_updated").alias("last_updated"),
    )


def _day(minute: Column) -> Column:
    return F.date_format(minute, "yyyy-MM-dd")


def _reduced(events: DataFrame) -> DataFrame:
    """One row for each key and minute of a batch; everything else is sums of these."""
    minute = F.date_trunc("minute", "timestamp").alias("minute")
    return events.groupBy("line", "station", "direction", "destination", minute).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("is_delayed").alias("delays"),
        F.max("timestamp").alias("last_updated"),
    )


def _add_minutes(counts: Snapshot, fresh: DataFrame) -> None:
    fresh = fresh.groupBy("minute").agg(F.sum("events").alias("events"))
    fresh = fresh.withColumn(PART, F.coalesce(_day(F.col("minute")), F.lit("none")))
    # The days of one batch.
    days = sorted(r[0] for r in fresh.select(PART).distinct().collect())
    if not days:
        return
    names = {day: f"{MINUTES}/day={day}" for day in days}
    known = [name for name in names.values() if counts.exists(name)]
    if known:
        fresh = fresh.unionByName(counts.load_split(MINUTES, known))
    merged = fresh.groupBy("minute", PART).agg(F.sum("events").alias("events"))
    counts.save_split(merged.repartition(PART), MINUTES, names, rows={})


def add(events: DataFrame, batch: int, root: str) -> None:
    """Adds a batch to the counts under ``root``, unless they hold it already."""
    counts = Snapshot(events.sparkSession, root)
    last = counts.marked(LAST_BATCH)
    if last is not None and batch <= last:
        return
    reduced = _reduced(events).persist()
    try:
        for name, keys in KEYS.items():
            rows = _summed(reduced, *keys)
            if counts.exists(name):
                rows = _summed(rows.unionByName(counts.load(name)), *keys)
            counts.save(rows, name)
        _add_minutes(counts, reduced)
        counts.mark(LAST_BATCH, batch)
        counts.commit()
    finally:
        reduced.unpersist()


def keep(events: DataFrame, root: str, every: str | None = None) -> StreamingQuery:
    """Keeps the counts of a stream of rail events under ``root``, with the stream's
    checkpoint, which belongs to them. Without ``every`` it adds what is there and stops."""
    root = root.rstrip("/")
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        events.writeStream.foreachBatch(lambda rows, batch: add(rows, batch, root))
        .option("checkpointLocation", f"{root}/_checkpoint")
        .trigger(**trigger)
        .start()
    )


def tidy(spark: SparkSession, root: str, keep_seconds: float = 3600) -> int:
    """Removes replaced counts; to be run now and then. Readers of a report have
    ``keep_seconds`` to end."""
    return snapshots.expire(spark, root, keep_seconds)


# Reports. All read one state of the counts.


def events_per_line(counts: Snapshot) -> DataFrame:
    lines = counts.load(PAIRS).groupBy("line").agg(
        F.sum("events").alias("events"), F.sum("delays").alias("delays")
    )
    return lines.withColumn("line_name", labels.short_line_name(F.col("line")))


def kpis(counts: Snapshot) -> DataFrame:
    return live.kpis(counts.load(PAIRS))


def direction_split(counts: Snapshot) -> DataFrame:
    return counts.load(DIRECTIONS).select("direction", "events")


def top_destinations(counts: Snapshot, n: int = 10) -> DataFrame:
    return (
        counts.load(DESTINATIONS)
        .where("destination is not null")
        .orderBy(F.desc("events"), "destination")
        .limit(n)
        .select("destination", "events")
    )


def events_per_minute(counts: Snapshot) -> DataFrame:
    return counts.load(MINUTES).select("minute", "events")
