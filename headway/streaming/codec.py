"""Events <-> topic messages (JSON values)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.functions.jsontext import BROKEN, with_parsed
from headway.schemas import BUS_EVENT, RAIL_EVENT
from headway.sources.topics import BUS_TOPIC, RAIL_TOPIC

# ISO-8601 with microseconds; Spark's own default would cut to milliseconds.
JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"}
OK, BAD = "ok", "bad"
EVENT_SCHEMAS: dict[str, T.StructType] = {BUS_TOPIC: BUS_EVENT, RAIL_TOPIC: RAIL_EVENT}


def encode(events: DataFrame, topic: str) -> DataFrame:
    """(topic, key, value): the key is the stop id, else "line-station"; a
    broker keeps the order of events with the same key."""
    names = events.columns
    stop = F.nullif(F.col("stop_id"), F.lit("")) if "stop_id" in names else F.lit(None)
    place = F.concat_ws("-", "line", "station") if "line" in names else F.lit(None)
    return events.select(
        F.lit(topic).alias("topic"),
        F.coalesce(stop.cast("string"), place.cast("string")).cast("binary").alias("key"),
        F.to_json(F.struct(*names), JSON_TIME).cast("binary").alias("value"),
    )


def decode(messages: DataFrame, topic: str) -> DataFrame:
    """Messages of one topic as event rows, each parsed once.

    ``status`` is "ok", or "bad" for values that are missing, not UTF-8 or not
    JSON of the topic's schema; these keep their ``key`` and ``value`` and
    have no event columns.
    """
    schema = EVENT_SCHEMAS[topic]
    text = F.when(F.is_valid_utf8(F.col("value")), F.col("value").cast("string"))
    parsed = with_parsed(messages.where(F.col("topic") == topic), text, schema, "event")
    bad = F.col("event").isNull() | F.col(f"event.{BROKEN}").isNotNull()
    return parsed.withColumn("status", F.when(bad, BAD).otherwise(OK)).select(
        *[F.when(F.col("status") == OK, F.col(f"event.{n}")).alias(n) for n in schema.names],
        *[F.when(F.col("status") == BAD, F.col(n)).alias(n) for n in ("key", "value")],
        "status",
    )


def events(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("status") == OK).drop("key", "value", "status")


def bad_messages(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("status") == BAD).select("key", "value")
