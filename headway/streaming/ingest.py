"""Topics -> event tables, with Structured Streaming.

One query per table. Each keeps its offsets in a checkpoint and writes through
the file sink, whose log makes a retried batch replace itself: events are
stored exactly once, also when executors or the driver are lost. Repeated
events are separate observations and are all kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from headway.sources import tables
from headway.sources.topics import BUS_TOPIC, RAIL_TOPIC
from headway.streaming import codec

RAIL_TABLE, BUS_TABLE = "mtr_schedule_raw", "bus_eta_raw"
TABLES = {RAIL_TABLE: RAIL_TOPIC, BUS_TABLE: BUS_TOPIC}
# Good and bad rows share a read and a parse; the status partition keeps them
# apart. Rail events are also partitioned by day.
PARTITIONS = {RAIL_TABLE: ("status", "event_date"), BUS_TABLE: ("status",)}

# A function of the topic, so that with a broker each query subscribes to its
# topic only and does not read the other.
Source = Callable[[str], DataFrame]


# The partitions of a table (days) are dealt to so many groups of tasks.
TASK_GROUPS = 8


def _rows(source: Source, table: str, files: int) -> DataFrame:
    """Decoded messages, shuffled so that a batch writes at most ``files``
    files into each partition of the table, however many tasks read it. Good
    rows have no key and value left, so all columns deal them out.

    The tasks are numbered rather than hashed: the writer sorts all rows of a task,
    and parts of one partition that met in a task would be sorted together."""
    decoded = codec.decode(source(TABLES[table]), TABLES[table])
    if "event_date" in PARTITIONS[table]:
        decoded = decoded.withColumn("event_date", F.to_date("timestamp"))
    part = F.pmod(F.xxhash64(*decoded.columns), F.lit(files))
    group = F.pmod(F.xxhash64(*PARTITIONS[table]), F.lit(TASK_GROUPS))
    return decoded.repartitionById(TASK_GROUPS * files, (group * files + part).cast("int"))


def start(
    source: Source, root: str, every: str | None = None, files: int = 4
) -> list[StreamingQuery]:
    """Starts one query per event table.

    Without ``every`` the queries store what is there and stop by themselves;
    with it ("1 minute") they run on. ``root`` must be a shared folder.
    ``files`` bounds the files of a batch in each partition; raise it with the
    size of batches, which the source options of ``topics`` bound.
    """
    root = root.rstrip("/")
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return [
        _rows(source, table, files)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*PARTITIONS[table])
        .option("path", f"{root}/{table}")
        .option("checkpointLocation", f"{root}/_checkpoints/{table}")
        .trigger(**trigger)
        .start()
        for table in TABLES
    ]


def drain(source: Source, root: str) -> None:
    """One bounded run: stores everything that is there now, then returns. A
    failed query raises; the next run goes on from its checkpoint."""
    queries = start(source, root)
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def _stored(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the sink. Spark reads the sink's log, so files of an
    unfinished batch are not seen."""
    fields = [
        *codec.EVENT_SCHEMAS[TABLES[table]].fields,
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("status", T.StringType()),
    ]
    if "event_date" in PARTITIONS[table]:
        fields.append(T.StructField("event_date", T.DateType()))
    return spark.read.schema(T.StructType(fields)).parquet(f"{root.rstrip('/')}/{table}")


def events_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return codec.events(_stored(spark, root, table))


def rail_events(spark: SparkSession, root: str) -> DataFrame:
    """All rail events under a root: streamed ones and those that
    ``tables.save_rail_events`` loaded. The two are separate tables, as the
    file log of the stream hides files it did not write."""
    streamed = events_table(spark, root, RAIL_TABLE).drop("event_date")
    if not tables.exists(spark, root, tables.LOADED_EVENTS):
        return streamed
    loaded = tables.load(spark, root, tables.LOADED_EVENTS)
    return streamed.unionByName(loaded.select(*streamed.columns))


def bad_messages(spark: SparkSession, root: str, table: str) -> DataFrame:
    return codec.bad_messages(_stored(spark, root, table))


def publish(messages: DataFrame, options: dict[str, str]) -> None:
    """Writes (topic, key, value) rows to a broker. Needs Spark's Kafka
    package."""
    messages.write.format("kafka").options(**options).save()


def publish_stream(
    messages: DataFrame, options: dict[str, str], checkpoint: str
) -> StreamingQuery:
    return (
        messages.writeStream.format("kafka")
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
