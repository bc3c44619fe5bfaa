"""Code -> label lookups and display texts."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MODE_LABELS = {0: "Tram", 1: "MTR", 3: "Bus", 4: "Ferry"}
UNKNOWN_MODE = "Unknown"
DEFAULT_MODE = 3  # a stop without a mode counts as a bus stop

# Line codes and the names shown for them.
LINE_NAMES = {
    "AEL": "Airport Express",
    "TCL": "Tung Chung Line",
    "TML": "Tuen Ma Line",
    "KTL": "Kwun Tong Line",
    "TWL": "Tsuen Wan Line",
    "ISL": "Island Line",
    "EAL": "East Rail Line",
    "SIL": "South Island Line",
    "TKL": "Tseung Kwan O Line",
    "DRL": "Disneyland Resort Line",
}

# The same lines' short names.
SHORT_LINE_NAMES = {
    "AEL": "Airport Express",
    "TCL": "Tung Chung",
    "TML": "Tuen Ma",
    "TKL": "Tseung Kwan O",
    "EAL": "East Rail",
    "SIL": "South Island",
    "TWL": "Tsuen Wan",
    "ISL": "Island",
    "KTL": "Kwun Tong",
    "DRL": "Disneyland",
}


def _lookup(names: dict, key: Column, fallback: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())])
    return F.coalesce(pairs[key], fallback)


def mode_label(route_type: Column) -> Column:
    return _lookup(MODE_LABELS, route_type.cast("int"), F.lit(UNKNOWN_MODE))


def line_name(code: Column) -> Column:
    return _lookup(LINE_NAMES, code, code)


def short_line_name(code: Column) -> Column:
    return _lookup(SHORT_LINE_NAMES, code, code)


def fare_text(fare: Column) -> Column:
    """Fare with one decimal, "HK$ 12.5"."""
    return F.format_string("HK$ %.1f", fare.cast("double"))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))
