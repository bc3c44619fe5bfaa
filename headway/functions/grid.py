"""Square grid cells over coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CELL_DEGREES = 0.02  # fixed value


def cell_index(coordinate: Column, size: float = CELL_DEGREES) -> Column:
    """Cell number; the cast truncates toward zero."""
    return (coordinate / F.lit(size)).cast("bigint")


def cell_centre(index: Column, size: float = CELL_DEGREES) -> Column:
    return index * F.lit(size) + F.lit(size / 2)
