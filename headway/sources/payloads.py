"""Nested API answers -> flat event rows.

Each input row holds one answer as JSON text. A broken answer gives no rows;
``broken_payloads`` returns those inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.functions.jsontext import BROKEN, with_parsed
from headway.schemas import BUS_EVENT, ETA_PAYLOAD, RAIL_EVENT, SCHEDULE_PAYLOAD

DIRECTIONS = ("UP", "DOWN")


def parse_payload(df: DataFrame, schema: T.StructType, payload: str = "payload") -> DataFrame:
    return with_parsed(df, F.col(payload), schema, "answer")


def intact_payloads(df: DataFrame, schema: T.StructType, payload: str = "payload") -> DataFrame:
    return parse_payload(df, schema, payload).where(F.col(f"answer.{BROKEN}").isNull())


def broken_payloads(df: DataFrame, schema: T.StructType, payload: str = "payload") -> DataFrame:
    parsed = parse_payload(df, schema, payload)
    broken = F.col(payload).isNull() | F.col(f"answer.{BROKEN}").isNotNull()
    return parsed.where(broken).drop("answer")


def schedule_trains(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per valid train: the answer's columns, line, station, direction
    and the train's seq, dest, plat, time, ttnt.

    Where the input has ``line`` and ``station`` (the request), only that
    station's trains are kept.
    """
    asked = {"line", "station"} <= set(df.columns)
    answers = intact_payloads(df, SCHEDULE_PAYLOAD, payload).where("answer.status = 1")
    stations = answers.select(
        *[c for c in df.columns if c != payload],
        F.col("answer.curr_time").alias("curr_time"),
        F.coalesce(F.col("answer.isdelay") == "Y", F.lit(False)).alias("is_delayed"),
        F.explode("answer.data").alias("line_station", "trains"),
    )
    if asked:
        stations = stations.where(
            F.col("line_station") == F.concat_ws("-", F.col("line"), F.col("station"))
        )
    else:
        stations = stations.withColumns(
            {
                "line": F.substring_index("line_station", "-", 1),
                "station": F.expr("substr(line_station, instr(line_station, '-') + 1)"),
            }
        )
    directed = F.create_map(
        *[part for d in DIRECTIONS for part in (F.lit(d), F.col(f"trains.{d}"))]
    )
    kept = [c for c in stations.columns if c not in ("line_station", "trains")]
    per_direction = stations.select(*kept, F.explode(directed).alias("direction", "list"))
    return (
        per_direction.select(*kept, "direction", F.inline("list"))
        .where(F.col("valid") == "Y")
        .drop("valid")
    )


def flatten_schedule(
    df: DataFrame, payload: str = "payload", observed_at: Column | None = None
) -> DataFrame:
    """Schedule answers -> rail events. ``observed_at`` defaults to now."""
    clock = F.current_timestamp() if observed_at is None else observed_at
    trains = schedule_trains(df, payload)
    return trains.select(
        F.lit("mtr_schedule").alias("event_type"),
        "line",
        "station",
        "direction",
        F.col("dest").alias("destination"),
        F.col("plat").alias("platform"),
        F.col("time").alias("arrival_time"),
        F.col("ttnt").alias("minutes_away"),
        "is_delayed",
        clock.alias("timestamp"),
    ).select(*RAIL_EVENT.names)


def flatten_eta(
    df: DataFrame, payload: str = "payload", observed_at: Column | None = None
) -> DataFrame:
    """Arrival answers (with the request's ``stop_id``) -> bus events; items
    without an arrival time are dropped."""
    clock = F.current_timestamp() if observed_at is None else observed_at
    items = intact_payloads(df, ETA_PAYLOAD, payload).select(
        *[c for c in df.columns if c != payload], F.inline("answer.data")
    )
    return (
        items.where(F.col("eta") != "")
        .select(
            F.lit("bus_eta").alias("event_type"),
            "stop_id",
            "route",
            F.col("dir").alias("direction"),
            "service_type",
            F.col("dest_en").alias("destination_en"),
            F.col("dest_tc").alias("destination_tc"),
            F.col("eta_seq").try_cast("bigint").alias("eta_seq"),
            "eta",
            clock.alias("timestamp"),
        )
        .select(*BUS_EVENT.names)
    )
