"""The daily batch: raw feed -> staging -> rollups -> marts, as stored tables.

Marts read the stored staging tables and rollups. Stop times are stored in
trip order, so the trip rollup shrinks them before its shuffle; they are
scanned four times in all: for two rollups, the hour counts and the
trajectories.

All tables of a build are committed together (``sources.snapshots``): readers
see them as the last build left them until the whole new build is there.

A feed may lack a member. Its staging table, and the rollups and marts that
need it, are then left as the last complete run stored them, rather than built
from tables of different runs; ``build_log`` tells which run wrote a table.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators import marts, rejects, rollups, sketches, staging
from headway.operators.marts import Network
from headway.sources import feed, tables
from headway.sources.snapshots import Snapshot

log = logging.getLogger(__name__)

# Stored layouts: lookups by these keys skip files by their statistics. Trip
# and sequence are not a key, so the time breaks ties; a hot trip spans several
# ranges.
TRIP_ORDER = ("trip_id", "stop_sequence", "departure_time")
STAGING_CLUSTERS = {"stg_trips": ("route_id", "trip_id"), "stg_stop_times": TRIP_ORDER}
# Marts read by a few keys at a time -> the key.
MARTS_BY_PART = {"mart_service_frequency": "route_short_name"}
ROLLUP_NEEDS = ("stg_stop_times", "stg_trips")
ROLLUPS = ("route_trips", "visit_rollup", "route_stop_rollup", "route_hours")
SKETCHES = "visit_sketches"
BUILD_LOG = "build_log"
BUILD_LOG_SCHEMA = "table_name string, run string, row_count bigint"
# A landed file is one split, so it must stay small however large its source is.
LANDED_ROWS = 200_000


def _staging(
    tables_at: Snapshot, raw: dict[str, DataFrame], strict: bool, reject: bool
) -> dict[str, int]:
    if reject:
        return rejects.stage(tables_at, raw, STAGING_CLUSTERS)
    rows = {}
    for name, df in staging.stage(raw, strict).items():
        keys = STAGING_CLUSTERS.get(name)
        rows[name] = tables_at.save(tables.clustered(df, *keys) if keys else df, name)
    return rows


def build_staging(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    root: str,
    strict: bool = True,
    reject: bool = False,
) -> dict[str, int]:
    """Replaces the staging tables; returns row counts. With ``reject``, malformed
    rows go to tables of their own and are counted (``operators.rejects``)."""
    tables_at = Snapshot(spark, root)
    rows = _staging(tables_at, raw, strict, reject)
    tables_at.commit()
    return rows


def _network(
    tables_at: Snapshot,
    with_rollups: bool = True,
    staged: tuple[str, ...] = tuple(staging.BUILDERS),
) -> Network:
    def stored(name: str, there: bool) -> DataFrame | None:
        return tables_at.load(name) if there else None

    with_rollups = with_rollups and set(ROLLUP_NEEDS) <= set(staged)
    return Network(
        **{name.removeprefix("stg_"): stored(name, name in staged) for name in staging.BUILDERS},
        stored_route_trips=stored("route_trips", with_rollups),
        stored_route_stop_rollup=stored("route_stop_rollup", with_rollups),
        stored_route_hours=stored("route_hours", with_rollups),
    )


def stored_network(
    spark: SparkSession,
    root: str,
    with_rollups: bool = True,
    staged: tuple[str, ...] = tuple(staging.BUILDERS),
) -> Network:
    """The stored tables as inputs of marts, all of one state; ``staged`` names
    the staging tables to use, by default all."""
    return _network(Snapshot(spark, root), with_rollups, staged)


def _rollups(tables_at: Snapshot) -> dict[str, int]:
    net = _network(tables_at, with_rollups=False, staged=ROLLUP_NEEDS)
    rows = {"route_trips": tables_at.save(net.route_trips, "route_trips")}
    visits = rollups.visit_rollup(net.stop_times, net.trips)
    rows["visit_rollup"] = tables_at.save(visits, "visit_rollup")
    visits = tables_at.load("visit_rollup")
    for name, of in (
        ("route_stop_rollup", rollups.route_stops_of),
        ("route_hours", rollups.route_hours_of),
    ):
        rows[name] = tables_at.save(of(visits), name)
    return rows


def build_rollups(spark: SparkSession, root: str) -> dict[str, int]:
    """One shuffle of the stop times for the visits; the tables per route and
    stop, and per route and hour, come from these."""
    tables_at = Snapshot(spark, root)
    rows = _rollups(tables_at)
    tables_at.commit()
    return rows


def build_sketches(spark: SparkSession, root: str) -> int:
    """Stores the sketches of all visits, for approximate reports (``operators.sketches``);
    no build does so unasked."""
    tables_at = Snapshot(spark, root)
    net = _network(tables_at, with_rollups=False, staged=ROLLUP_NEEDS)
    rows = tables_at.save(sketches.visit_sketches(net.stop_times, net.trips), SKETCHES)
    tables_at.commit()
    return rows


def _marts(tables_at: Snapshot, staged: tuple[str, ...]) -> dict[str, int]:
    net = _network(tables_at, staged=staged)
    rows = {}
    for name, mart in marts.MARTS.items():
        if missing := set(marts.NEEDS[name]) - set(staged):
            log.warning("%s is not built, %s missing", name, ", ".join(sorted(missing)))
            continue
        df = mart(net)
        rows[name] = save_mart(tables_at, df, name)
    return rows


def save_mart(tables_at: Snapshot, df: DataFrame, name: str) -> int:
    """Writes a mart in its layout; returns its rows."""
    if name == "mart_trip_trajectories":
        # Ranges are sampled from all rows, so times are read after that, once a row.
        ordered = tables.clustered(df.drop("departure_timestamp_ms"), *TRIP_ORDER)
        df = marts.timestamped(ordered)
    if name in MARTS_BY_PART:
        return tables_at.save(tables.by_part(df, MARTS_BY_PART[name]), name, (tables.PART_OF,))
    return tables_at.save(df, name)


def build_marts(
    spark: SparkSession, root: str, staged: tuple[str, ...] = tuple(staging.BUILDERS)
) -> dict[str, int]:
    """Replaces the marts that need no other staging tables than these."""
    tables_at = Snapshot(spark, root)
    rows = _marts(tables_at, staged)
    tables_at.commit()
    return rows


def _log_run(tables_at: Snapshot, rows: dict[str, int]) -> None:
    """Notes which run wrote which table; a row per table, so it stays small."""
    run = uuid.uuid4().hex
    entries = tables_at.spark.createDataFrame(
        [(name, run, n) for name, n in rows.items()], BUILD_LOG_SCHEMA
    )
    if tables_at.exists(BUILD_LOG):
        older = tables_at.load(BUILD_LOG).where(~F.col("table_name").isin(list(rows)))
        entries = older.unionByName(entries)
    tables_at.save(entries.coalesce(1), BUILD_LOG)


def build_all(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    root: str,
    strict: bool = True,
    reject: bool = False,
) -> dict[str, int]:
    """All tables of a feed under ``root``, as far as its members allow, shown
    at once when the last is written; returns row counts per table written."""
    tables_at = Snapshot(spark, root)
    rows = _staging(tables_at, raw, strict, reject)
    staged = tuple(rows)
    if set(ROLLUP_NEEDS) <= set(staged):
        rows |= _rollups(tables_at)
    rows |= _marts(tables_at, staged)
    _log_run(tables_at, rows)
    tables_at.commit()
    return rows


def load_rail(
    spark: SparkSession,
    files: dict[str, str],
    root: str,
    multiline: bool = False,
    file_order: bool = True,
    codec: str | None = None,
) -> dict[str, int]:
    """Lands each rail file as normalised CSV and replaces its raw table from
    there; returns row counts. ``files`` maps raw table names to paths.

    Raw tables keep each row's place in the source file, which reports need to
    find first rows. A landed part file is read as one split, as a quoted line
    break must not end a row; it holds ``LANDED_ROWS`` rows at most, so a ``codec``
    ("gzip") saves disk and costs no parallel reading.
    """
    rows = {}
    for name, path in files.items():
        landed = f"{root.rstrip('/')}/landed/{name}"
        source = feed.read_rail(spark, path, name, multiline, file_order)
        tables.save_csv(source, landed, rows_per_file=LANDED_ROWS, codec=codec)
        rows[name] = tables.save(feed.read_csv_text(spark, landed, multiline=True), root, name)
    return rows


def build_from_files(spark: SparkSession, feed_dir: str, root: str) -> dict[str, int]:
    """``build_all`` over the extracted members of a feed."""
    return build_all(spark, feed.read_feed(spark, feed_dir), root)
