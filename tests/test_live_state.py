"""Counts that batches add to: equal to batch reports after every run, whatever dies."""

from __future__ import annotations

import datetime as dt

import pytest

from headway.plans import event_reports
from headway.schemas import RAIL_EVENT
from headway.sources.snapshots import Snapshot
from headway.streaming import state

START = dt.datetime(2024, 1, 2, 23, 58, 30)
REPORTS = {
    state.events_per_line: event_reports.events_per_line,
    state.direction_split: event_reports.direction_split,
    state.events_per_minute: event_reports.events_per_minute,
    state.top_destinations: event_reports.top_destinations,
    state.kpis: event_reports.stream_kpis,
}


def event(n, at, line="ISL"):
    return ("mtr_schedule", line, f"S{n % 3}", ["UP", "DOWN", None][n % 3], [None, "D1", "D2"][n % 3], "1", "t", "3",
            n % 4 == 0, at)


def put(spark, inbox, *events):
    spark.createDataFrame(list(events), RAIL_EVENT).coalesce(1).write.mode("append").parquet(inbox)


def run(spark, inbox, root):
    stream = spark.readStream.schema(RAIL_EVENT).option("maxFilesPerTrigger", 1).parquet(inbox)
    query = state.keep(stream, root)
    query.awaitTermination()
    return query


def same(spark, inbox, root):
    events, counts = spark.read.schema(RAIL_EVENT).parquet(inbox), Snapshot(spark, root)
    for kept, batch in REPORTS.items():
        assert sorted(map(repr, kept(counts).collect())) == sorted(map(repr, batch(events).collect()))


def test_counts_equal_batch_after_every_run(spark, tmp_path):
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "counts")
    minute = dt.timedelta(seconds=40)
    put(spark, inbox, *[event(n, START + n * minute) for n in range(9)])
    run(spark, inbox, root)
    same(spark, inbox, root)
    run(spark, inbox, root)  # nothing new
    same(spark, inbox, root)
    put(spark, inbox, event(1, START + dt.timedelta(days=2), "KTL"), event(2, None), event(3, START, None))
    put(spark, inbox, event(4, START - dt.timedelta(days=40)), event(4, START))  # very late
    query = run(spark, inbox, root)
    same(spark, inbox, root)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 5


def test_days_without_new_events_are_left_alone(spark, tmp_path):
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "counts")
    put(spark, inbox, *[event(n, START + dt.timedelta(days=n)) for n in range(6)])
    run(spark, inbox, root)
    before = Snapshot(spark, root).entries
    put(spark, inbox, event(1, START + dt.timedelta(days=3)), event(1, START + dt.timedelta(days=6)))
    run(spark, inbox, root)
    after = Snapshot(spark, root).entries
    changed = {n for n in after if n.startswith(state.MINUTES) and after[n] != before.get(n)}
    assert changed == {f"{state.MINUTES}/day=2024-01-05", f"{state.MINUTES}/day=2024-01-08"}
    assert state.tidy(spark, root, keep_seconds=-1) > 0
    same(spark, inbox, root)


@pytest.mark.parametrize("dies", ["before", "after"])
def test_a_batch_that_dies_counts_once(spark, tmp_path, monkeypatch, dies):
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "counts")
    put(spark, inbox, event(1, START), event(2, START))
    run(spark, inbox, root)
    put(spark, inbox, event(3, START), event(5, START + dt.timedelta(days=1)))
    commit = Snapshot.commit

    def lost(self):
        if dies == "after":
            commit(self)
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(Snapshot, "commit", lost)
        with pytest.raises(Exception, match="driver lost"):
            run(spark, inbox, root)
    run(spark, inbox, root)
    same(spark, inbox, root)


def test_a_batch_seen_before_adds_nothing(spark, tmp_path):
    root = str(tmp_path)
    events = spark.createDataFrame([event(1, START)], RAIL_EVENT)
    for batch in (0, 1, 1, 0):
        state.add(events, batch, root)
    assert state.kpis(Snapshot(spark, root)).first().total_events == 2
    state.add(events.limit(0), 2, root)
    assert state.events_per_minute(Snapshot(spark, root)).first().events == 2
