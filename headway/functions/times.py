"""Service times: "HH:MM:SS" text whose hour may be 24 or more."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. \z and not $, which in Java also accepts a trailing newline.
SERVICE_TIME = r"^\d+:\d{2}:\d{2}\z"
BASE_EPOCH_SECONDS = 1704067200  # 2024-01-01 00:00:00 UTC


def is_service_time(text: Column) -> Column:
    return text.rlike(SERVICE_TIME)


def _part(text: Column, index: int, strict: bool) -> Column:
    piece = F.split_part(text, F.lit(":"), F.lit(index))
    return piece.cast("bigint") if strict else piece.try_cast("bigint")


def hour_of(text: Column, strict: bool = True) -> Column:
    """Hour before the first colon. Malformed text fails the query, or gives
    NULL with ``strict=False``."""
    head = F.substring_index(text, ":", 1)
    return head.cast("bigint") if strict else head.try_cast("bigint")


def valid_hour(text: Column) -> Column:
    """Hour of a valid service time, else NULL.

    The check sits inside the expression: Spark may evaluate the conjuncts of
    a filter in any order, and the cast fails on malformed text.
    """
    return F.when(is_service_time(text), hour_of(text))


def seconds_of(text: Column) -> Column:
    """Seconds since the start of the service day; NULL if not valid. Minutes and
    seconds of a valid time stand at its end, which is quicker to take than to split."""
    minutes, seconds = (F.substring(text, at, 2).cast("bigint") for at in (-5, -2))
    return F.when(is_service_time(text), hour_of(text) * 3600 + minutes * 60 + seconds)


def epoch_ms(text: Column) -> Column:
    """Milliseconds on the animation's base day; hours from 24 on roll over."""
    return (F.lit(BASE_EPOCH_SECONDS).cast("bigint") + seconds_of(text)) * 1000


def display_time(text: Column) -> Column:
    """"25:30:00" -> "01:30 (+1day)", "07:05:00" -> "07:05".

    Empty text and text without a colon stay as they are, and 24 hours are
    taken off once only.
    """
    hour, minute = hour_of(text), _part(text, 2, True)
    shown = F.when(
        hour >= 24, F.format_string("%02d:%02d (+1day)", hour - 24, minute)
    ).otherwise(F.format_string("%02d:%02d", hour, minute))
    return F.when(text.contains(":"), shown).otherwise(text)


def hour_label(hour: Column) -> Column:
    return F.format_string("%02d:00", hour)
