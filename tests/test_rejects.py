from __future__ import annotations

import json

from pyspark.sql import functions as F

from headway.operators import marts, rejects, staging
from headway.plans import build
from headway.sources import samples, tables
from headway.sources.snapshots import Snapshot

STOP_TIMES = [
    ("t1", "s1", "1", "07:00:00", "07:00:00"), ("t1", "s2", "2", "", "25:10:00"), ("t1", "s3", "x", "a", "7:5"),
    (None, "s1", "1", None, None), ("t2", None, "y", None, "noon"), ("t2", "s1", None, None, None),
    ("t3", "s1", "1", "07:00:00", ""), ("t1", "s1", "1", "07:00:00", "07:00:00"),
]
COLUMNS = "trip_id string, stop_id string, stop_sequence string, arrival_time string, departure_time string"


def rejected(spark, root, rows=STOP_TIMES):
    raw = {"stop_times": spark.createDataFrame(rows, COLUMNS)}
    return build.build_staging(spark, raw, root, reject=True)


def test_every_row_is_kept_or_rejected(spark, tmp_path):
    root = str(tmp_path)
    assert rejected(spark, root) == {"stg_stop_times": 4}
    state = Snapshot(spark, root)
    kept = state.load("stg_stop_times")
    assert kept.schema.names == ["trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time"]
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted(
        [("t1", "s1", 1, "07:00:00", "07:00:00")] * 2 + [("t1", "s2", 2, "", "25:10:00"), ("t2", "s1", None, None, None)],
        key=str,
    )
    bad = {(tuple(r.problems), r.raw_row) for r in state.load("rejected_stop_times").collect()}
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def as_read(n):
        return json.dumps({k: v for k, v in zip(names, STOP_TIMES[n]) if v is not None}, separators=(",", ":"))

    assert bad == {
        (("stop_sequence",), as_read(2)), (("trip_id",), as_read(3)),
        (("stop_id", "stop_sequence", "departure_time"), as_read(4)), (("departure_time",), as_read(6)),
    }
    counts = {r.problem: r.row_count for r in state.load(rejects.COUNTS).collect()}
    assert counts == {
        rejects.ALL_READ: 8, rejects.ALL_REJECTED: 4, "trip_id": 1, "stop_id": 1, "stop_sequence": 2,
        "arrival_time": 0, "departure_time": 2,
    }


def test_strict_reports_run_on_what_is_kept(spark, tmp_path):
    rejected(spark, str(tmp_path))
    kept = tables.load(spark, str(tmp_path), "stg_stop_times")
    hours = marts.peak_hour_analysis(marts.Network(stop_times=kept))
    assert {tuple(r) for r in hours.collect()} == {(7, 2), (25, 1)}


def test_rejects_of_nothing_and_of_everything(spark, tmp_path):
    root = str(tmp_path)
    for rows, kept, bad in (([], 0, 0), (STOP_TIMES[2:5], 0, 3), (STOP_TIMES[:2], 2, 0)):
        assert rejected(spark, root, rows) == {"stg_stop_times": kept}
        state = Snapshot(spark, root)
        assert state.load("stg_stop_times").count() == kept
        assert state.load("rejected_stop_times").count() == bad


def test_a_clean_feed_is_staged_as_ever(spark, sf_dir, tmp_path):
    raw = samples.raw_feed(spark, sf_dir)
    build.build_all(spark, raw, str(tmp_path), reject=True)
    state = Snapshot(spark, str(tmp_path))
    for table, df in staging.stage(raw).items():
        stored = state.load(table)
        assert stored.schema.names == df.schema.names
        assert stored.exceptAll(df).isEmpty() and df.exceptAll(stored).isEmpty()
        assert state.load(rejects.rejected_name(table)).isEmpty()


def test_one_pass_over_the_raw_rows(spark, tmp_path):
    raw = spark.createDataFrame(STOP_TIMES, COLUMNS)
    raw.write.parquet(str(tmp_path / "raw"))
    rows = rejects.marked(spark.read.parquet(str(tmp_path / "raw")), "stg_stop_times")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert rows.where(F.col("table_part") == rejects.KEPT).count() == 4
