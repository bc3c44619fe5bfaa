"""Stored tables: load, truncate-and-reload, layouts, CSV export."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.sources.snapshots import Snapshot


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    return Snapshot(spark, root).load(name)


def exists(spark: SparkSession, root: str, name: str) -> bool:
    return Snapshot(spark, root).exists(name)


def _replace(spark: SparkSession, fresh: str, target: str) -> None:
    """Puts a finished folder in the place of another."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    new, now, old = path(fresh), path(target), path(f"{fresh}.old")
    files = now.getFileSystem(spark._jsc.hadoopConfiguration())
    had = files.exists(now)
    if had and not files.rename(now, old):
        raise OSError(f"{target} can't be moved")
    if not files.rename(new, now):
        if had:
            files.rename(old, now)
        raise OSError(f"{fresh} can't be moved to {target}")
    if had:
        files.delete(old, True)


def save(df: DataFrame, root: str, name: str) -> int:
    """Replaces the table at once and returns its row count, counted during the
    write. A write that fails leaves the old table as it was, and readers
    of the old rows go on reading them."""
    snapshot = Snapshot(df.sparkSession, root)
    rows = snapshot.save(df, name)
    snapshot.commit()
    return rows


def clustered(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows range-partitioned and sorted by the keys, so Parquet min/max
    statistics skip files and row groups. Ranges come from a sample of the
    whole key list, so a hot first key is split by the later ones."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


# A table in folders by the hash of a key: a filter or a join on both reads only some.
PART_OF = "key_part"
PARTS = 256


def part_of(key: str) -> Column:
    """The part of a key; NULL and empty keys have one, too."""
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")


def by_part(df: DataFrame, key: str) -> DataFrame:
    """Adds the part of a key, by which the table is to be saved, one file a part. For tables
    that are small next to ``PARTS`` files: all rows of a key are one task."""
    parted = df.withColumn(PART_OF, part_of(key))
    return parted.repartition(PART_OF).sortWithinPartitions(PART_OF, key)


def save_bucketed(
    df: DataFrame,
    table: str,
    buckets: int,
    *keys: str,
    path: str | None = None,
    order: tuple[str, ...] = (),
) -> None:
    """A catalog table bucketed by the keys: joins and aggregations on them
    need no shuffle. Choose ``buckets`` for about 200 MB each. Rows that lie in such
    buckets already are not moved. ``order`` sorts them, else the keys do."""
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .format("parquet")
        .options(**({} if path is None else {"path": path}))
        .bucketBy(buckets, *keys)
        .sortBy(*(order or keys))
        .saveAsTable(table)
    )


def save_csv(
    df: DataFrame,
    path: str,
    single_file: bool = False,
    rows_per_file: int = 0,
    codec: str | None = None,
) -> None:
    """CSV with a header; the old files stay until the new ones are complete.
    ``single_file`` is for bounded (top-k) results only; ``rows_per_file`` (0: no bound)
    is for files that are read as one split each, as those of most ``codec``s are."""
    out = df.coalesce(1) if single_file else df
    folder, _, name = path.rstrip("/").rpartition("/")
    fresh = f"{folder}/_new-{name}-{uuid.uuid4().hex}"
    (
        out.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_per_file)
        .options(**({} if codec is None else {"compression": codec}))
        .csv(fresh)
    )
    _replace(df.sparkSession, fresh, path)


# Events loaded in batches; the stream's own table has a file log that would
# hide them (``ingest.rail_events`` reads both).
LOADED_EVENTS = "mtr_schedule_loaded"


def save_rail_events(
    df: DataFrame, root: str, load: str = "all", name: str = LOADED_EVENTS
) -> None:
    """Event table partitioned by load and day, clustered by line and station.

    Storing a load again replaces its rows, other loads stay. Range
    partitioning on day, line, station and time spreads a hot line (or a single
    day) over many tasks; files still hold one day each.
    """
    days = df.withColumn("event_date", F.to_date("timestamp"))
    keys = ("event_date", "line", "station", "timestamp")
    snapshot = Snapshot(df.sparkSession, root)
    snapshot.save(clustered(days, *keys), f"{name}/load={load}", by=("event_date",))
    snapshot.commit()


def between(events: DataFrame, start: str, end: str) -> DataFrame:
    """Events with start <= timestamp < end. The day column is filtered too,
    because a filter on the time alone does not prune day partitions."""
    lower, upper = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    kept = events.where((F.col("timestamp") >= lower) & (F.col("timestamp") < upper))
    if "event_date" in events.columns:
        kept = kept.where(F.col("event_date").between(F.to_date(lower), F.to_date(upper)))
    return kept
