"""Good and bad rows of raw tables, told apart in one pass and counted.

Strict staging fails on the first malformed value, lenient staging makes it
NULL. Here a row with a malformed value goes to a table of rejected rows, with its
raw text and what was wrong with it, and the rest becomes the staging table. Both
are written in one pass (``Snapshot.save_split``), counted on the way, and committed
together, and every row read is in one of the two. All strict reports run on what is kept.

A row is rejected for each of these:

* a key of its table is missing;
* a value can't be cast to its column's type;
* a departure of the stop times has text before its first colon that is no hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions import times
from headway.operators import staging
from headway.schemas import STAGING
from headway.sources import tables
from headway.sources.snapshots import PART, Snapshot

KEPT, REJECTED = "kept", "rejected"
RAW, PROBLEMS = "raw_row", "problems"
COUNTS = "reject_counts"
COUNTS_SCHEMA = "table_name string, problem string, row_count bigint"
#: Problem under which all rows read, and all rejected ones, are counted.
ALL_READ, ALL_REJECTED = "(read)", "(rejected)"


def rejected_name(table: str) -> str:
    return table.replace("stg_", "rejected_", 1)


def problems(table: str) -> dict[str, Column]:
    """Raw column -> whether its value gets the row rejected. A key that is missing and
    a cast that fails are told apart by the raw value."""
    found = {}
    for raw, kind in staging.cast_columns(table).values():
        value = F.col(raw)
        wrong = value.isNotNull() & value.try_cast(kind).isNull()
        found[raw] = wrong | value.isNull() if raw in staging.KEYS[table] else wrong
    if table == "stg_stop_times":
        departure = F.col("departure_time")
        found["departure_time"] = departure.isNotNull() & times.hour_of(departure, strict=False).isNull()
    return found


def marked(raw: DataFrame, table: str) -> DataFrame:
    """The typed columns, the list of problems, the raw row as JSON where there are
    any, and which table the row belongs to."""
    wrong = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in problems(table).items()]))
    # Found once a row; the columns below only read it.
    found = raw.withColumn(PROBLEMS, wrong)
    bad = F.size(PROBLEMS) > 0
    return found.select(
        *staging.columns(table, strict=False),
        PROBLEMS,
        F.when(bad, F.to_json(F.struct(*raw.columns))).alias(RAW),
        F.when(bad, REJECTED).otherwise(KEPT).alias(PART),
    )


def save(tables_at: Snapshot, raw: DataFrame, table: str, keys: tuple[str, ...] = ()) -> dict[str, int]:
    """Saves the kept and the rejected rows; returns rows by problem, of all rows read
    and of all rejected ones. A row with two problems counts under both."""
    rows = marked(raw, table)
    by_problem = {f"problem_{n}": name for n, name in enumerate(problems(table))}
    found = tables_at.save_split(
        tables.clustered(rows, *keys) if keys else rows,
        table,
        {KEPT: table, REJECTED: rejected_name(table)},
        {table: STAGING[table].names, rejected_name(table): [PROBLEMS, RAW]},
        **{n: F.count_if(F.array_contains(PROBLEMS, name)) for n, name in by_problem.items()},
    )
    rejected = found[rejected_name(table)]
    return {
        ALL_READ: found[table] + rejected,
        ALL_REJECTED: rejected,
        **{name: found[n] for n, name in by_problem.items()},
    }


def stage(
    tables_at: Snapshot, raw: dict[str, DataFrame], keys: dict[str, tuple[str, ...]]
) -> dict[str, int]:
    """Saves the staging tables of the members there are, their rejected rows, and the
    counts; returns the rows kept."""
    kept, counts = {}, []
    for table, (member, _) in staging.BUILDERS.items():
        if member in raw:
            found = save(tables_at, raw[member], table, keys.get(table, ()))
            kept[table] = found[ALL_READ] - found[ALL_REJECTED]
            counts += [(table, problem, n) for problem, n in found.items()]
    # A few rows for each table.
    tables_at.save(tables_at.spark.createDataFrame(counts, COUNTS_SCHEMA).coalesce(1), COUNTS)
    return kept
