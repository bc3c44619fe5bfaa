"""Text sources: timetable feed members and rail CSV files.

Everything is read as text. Type inference would drop the leading zeros of
ids and turn service times into timestamps; staging casts instead.
"""

from __future__ import annotations

import logging
import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.schemas import FEED_COLUMNS, RAIL_RENAMES

log = logging.getLogger(__name__)

# Spark names a blank header "_c<position>"; other writers store "Unnamed: n".
FILE_ORDER = "file_order"
_UNNAMED = re.compile(r"^(_c\d+|Unnamed.*|)$")


def read_csv_text(
    spark: SparkSession, path: str, multiline: bool = False, file_order: bool = False
) -> DataFrame:
    """A CSV file or folder with one header row, all columns as text.

    A byte-order mark is dropped, headers are trimmed and columns without a
    header are left out. Files stay splittable unless ``multiline`` is set
    (needed only for line breaks inside quoted fields).
    """
    raw = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("multiLine", multiline)
        .csv(path)
    )
    return clean_headers(with_file_order(raw) if file_order else raw)


def _telling_apart(paths: list[str]) -> tuple[int, int]:
    """From and to which character paths must be read so that they differ, in the same order."""
    ordered = sorted({f"{path}|" for path in paths})
    shared = [len(os.path.commonprefix(pair)) for pair in zip(ordered, ordered[1:])]
    return (min(shared), max(shared) + 1) if shared else (0, 0)


def _ordered_text(number: Column) -> Column:
    """Hex digits behind a letter for how many they are: text in the order of the numbers."""
    digits = F.hex(number)
    return F.concat(F.char(F.length(digits) + 64), digits)


def with_file_order(scan: DataFrame) -> DataFrame:
    """Adds each row's place in its input: file, block, row, as text whose
    order is theirs, so that it survives a CSV file. Apply it to a file scan
    directly. As the text is stored with every row, it has no more of the
    paths than tells the scanned files apart."""
    start, end = _telling_apart(scan.inputFiles())
    # A path has no bar of its own, so none is the beginning of another.
    path = F.concat(F.input_file_name(), F.lit("|"))
    return scan.withColumn(
        FILE_ORDER,
        F.concat(
            F.substring(path, start + 1, end - start),
            _ordered_text(F.col("_metadata.file_block_start")),
            _ordered_text(F.monotonically_increasing_id()),
        ),
    )


def clean_headers(df: DataFrame) -> DataFrame:
    trimmed = df.toDF(*[name.lstrip("\ufeff").strip() for name in df.columns])
    return trimmed.drop(*[name for name in trimmed.columns if _UNNAMED.match(name)])


def with_columns_of(df: DataFrame, wanted: tuple[str, ...], source: str = "the file") -> DataFrame:
    """Exactly the wanted columns, found without regard to case. A missing one
    is an error: as NULL, a key would silently drop every row later."""
    found = {name.lower(): name for name in df.columns}
    if missing := [name for name in wanted if name.lower() not in found]:
        raise ValueError(f"{source} lacks the columns {', '.join(missing)}")
    return df.select(*[F.col(f"`{found[name.lower()]}`").alias(name) for name in wanted])


def read_feed(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The five feed members as text tables. A missing member is skipped with
    a warning."""
    members: dict[str, DataFrame] = {}
    for member, columns in FEED_COLUMNS.items():
        path = f"{directory.rstrip('/')}/{member}.txt"
        try:
            members[member] = with_columns_of(read_csv_text(spark, path), columns, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("%s is not in the feed, skipped", path)
    return members


def rename_rail(df: DataFrame, table: str) -> DataFrame:
    """Source headers -> raw column names; unlisted columns pass unchanged."""
    return df.withColumnsRenamed(RAIL_RENAMES[table])


def source_headers(df: DataFrame, table: str) -> DataFrame:
    """The other way round: reports name columns as the source files do and
    accept a raw table as well. Headers that are there already stay."""
    back = {raw: header for header, raw in RAIL_RENAMES[table].items() if header not in df.columns}
    return df.withColumnsRenamed({raw: back[raw] for raw in df.columns if raw in back})


def read_rail(
    spark: SparkSession,
    path: str,
    table: str,
    multiline: bool = False,
    file_order: bool = False,
) -> DataFrame:
    """A rail file with the raw table's column names."""
    return rename_rail(read_csv_text(spark, path, multiline, file_order), table)
