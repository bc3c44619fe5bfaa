"""Event tables whose files stay few however long the stream runs.

A file sink adds files, and lines to its log, for ever. Here every batch is a part of its
own in a snapshot table (``sources.snapshots``), committed with its number, so a batch
that runs again adds nothing. ``compact`` rewrites the batches
there are into one part for each status and day, merging days stored before, and
drops the batches in the same commit: a reader sees either the batches or the days
that hold them. Expiry then removes replaced folders, and the manifest is one file again.

A compaction reads the batches since the last one and the days they have events of,
so its cost follows new events, not the history. Files of a part hold about
``rows_per_file`` rows, and one hot day is as many files as it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.sources import snapshots
from headway.sources.snapshots import PART, Snapshot
from headway.streaming import codec
from headway.streaming.ingest import TABLES, Source

#: Parts by batch, and by status and day.
BATCHES, DAYS = "batches", "days"
ROWS_PER_FILE = 1_000_000
#: Tasks of one compaction at most; a task may write several parts.
MOST_TASKS = 10_000


def _names(table: str) -> tuple[str, str]:
    return f"{table}_{BATCHES}", f"{table}_{DAYS}"


def add(messages: DataFrame, batch: int, root: str, table: str) -> None:
    """Stores a batch of messages as a part, unless it is stored."""
    stored = Snapshot(messages.sparkSession, root)
    last = stored.marked(table)
    if last is not None and batch <= last:
        return
    rows = codec.decode(messages, TABLES[table])
    stored.save(rows, f"{_names(table)[0]}/batch={batch:012d}")
    stored.mark(table, batch)
    stored.commit()


def keep(source: Source, root: str, every: str | None = None) -> list[StreamingQuery]:
    """One query per event table, each with its root and checkpoint below ``root``. Without
    ``every`` they store what is there and stop."""
    root = root.rstrip("/")
    trigger = {"availableNow": True} if every is None else {"processingTime": every}

    def started(table: str) -> StreamingQuery:
        of = f"{root}/{table}"
        return (
            source(TABLES[table])
            .writeStream.foreachBatch(lambda rows, batch: add(rows, batch, of, table))
            .option("checkpointLocation", f"{of}/_checkpoint")
            .trigger(**trigger)
            .start()
        )

    return [started(table) for table in TABLES]


def drain(source: Source, root: str) -> None:
    """One bounded run; a failed query raises, and the next run goes on."""
    queries = keep(source, root)
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def compact(
    spark: SparkSession, root: str, table: str, rows_per_file: int = ROWS_PER_FILE,
    period: str = "yyyy-MM-dd", keep_seconds: float = 86_400,
) -> int:
    """Rewrites the stored batches into parts by status and day, or another ``period`` (a
    date pattern; always the same for a table). Returns how many batches there were. Only
    one compaction of a table may run at a time; batches may be added meanwhile."""
    of = f"{root.rstrip('/')}/{table}"
    stored = Snapshot(spark, of)
    batches, days = _names(table)
    found = stored.parts(batches)
    if found:
        day = F.coalesce(F.date_format("timestamp", period), F.lit("none"))
        fresh = stored.load(batches).drop("batch").withColumn(PART, F.concat_ws("_", "status", day))
        # As many as there are days with new events.
        sizes = {r[PART]: r["n"] for r in fresh.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect()}
        names = {part: f"{days}/part={part}" for part in sorted(sizes)}
        known = [name for name in names.values() if stored.exists(name)]
        if known:
            fresh = fresh.unionByName(stored.load_split(days, known))
        for name in known:
            sizes[name.rpartition("=")[2]] += stored.rows(name)
        if names:
            parts = {p: -(-n // rows_per_file) for p, n in sizes.items()}
            # Only parts of several files need a salt.
            several = [F.lit(x) for p, n in parts.items() if n > 1 for x in (p, n)]
            files = F.coalesce(F.element_at(F.create_map(*several), F.col(PART)), F.lit(1)) if several else F.lit(1)
            salt = F.pmod(F.xxhash64(*fresh.columns), files)
            stored.save_split(
                fresh.repartition(min(sum(parts.values()), MOST_TASKS), PART, salt), days, names,
                rows={names[p]: n for p, n in sizes.items()},
            )
        for name in found:
            stored.drop(name)
        stored.commit()
    snapshots.expire(spark, of, keep_seconds)
    return len(found)


def _stored(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Batches and days of one state of the table."""
    stored = Snapshot(spark, f"{root.rstrip('/')}/{table}")
    batches, days = _names(table)
    rows = [stored.load(name) for name in (batches, days) if stored.exists(name)]
    if not rows:
        raise ValueError(f"nothing is stored of {table}")
    return rows[0] if len(rows) == 1 else rows[0].drop("batch").unionByName(rows[1])


def events_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return codec.events(_stored(spark, root, table)).drop("batch")


def bad_messages(spark: SparkSession, root: str, table: str) -> DataFrame:
    return codec.bad_messages(_stored(spark, root, table))
