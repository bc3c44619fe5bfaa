from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from headway.schemas import RAIL_EVENT
from headway.sources import snapshots
from headway.sources.snapshots import Snapshot
from headway.sources.topics import RAIL_TOPIC
from headway.streaming import codec, compact, ingest

START = dt.datetime(2024, 1, 2, 3, 4, 5)
TABLE = ingest.RAIL_TABLE


def messages(spark, days, bad=0):
    events = [
        ("mtr_schedule", "ISL", f"S{n}", "UP", None, "1", "t", "3", True, START + dt.timedelta(days=d))
        for n, d in enumerate(days)
    ]
    good = codec.encode(spark.createDataFrame(events, RAIL_EVENT), RAIL_TOPIC)
    broken = spark.range(bad).selectExpr(f"'{RAIL_TOPIC}' topic", "cast('k' as binary) key", "cast('{' as binary) value")
    return good.unionByName(broken)


def state(spark, root):
    events = compact.events_table(spark, root, TABLE)
    days = sorted((r.timestamp - START).days for r in events.collect())
    return days, compact.bad_messages(spark, root, TABLE).count()


def add(spark, root, batch, days, bad=0):
    compact.add(messages(spark, days, bad), batch, f"{root}/{TABLE}", TABLE)


def test_compaction_keeps_every_row_once(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError, match="nothing is stored"):
        compact.events_table(spark, root, TABLE)
    add(spark, root, 0, [0, 0, 1], bad=2)
    add(spark, root, 1, [1, 2])
    assert state(spark, root) == ([0, 0, 1, 1, 2], 2)
    assert compact.compact(spark, root, TABLE) == 2
    assert state(spark, root) == ([0, 0, 1, 1, 2], 2)
    add(spark, root, 1, [1, 2])  # the same batch again
    add(spark, root, 2, [0, 3], bad=1)  # one late event
    assert state(spark, root) == ([0, 0, 0, 1, 1, 2, 3], 3)
    assert compact.compact(spark, root, TABLE) == 1
    assert compact.compact(spark, root, TABLE) == 0
    assert state(spark, root) == ([0, 0, 0, 1, 1, 2, 3], 3)


def test_files_and_log_stay_few(spark, tmp_path):
    root = str(tmp_path)
    for batch in range(12):
        add(spark, root, batch, [0, batch % 2])
        if batch % 4 == 3:
            compact.compact(spark, root, TABLE, keep_seconds=-1)
    assert len(state(spark, root)[0]) == 24
    files = list((tmp_path / TABLE).rglob("part-*.parquet"))
    manifest = list((tmp_path / TABLE / snapshots.MANIFEST).glob("part-*"))
    assert len(files) == 2 and len(manifest) == 1
    assert "batches" not in (manifest[0].read_text())


def test_a_hot_day_is_several_files(spark, tmp_path):
    root = str(tmp_path)
    add(spark, root, 0, [0] * 1000)
    compact.compact(spark, root, TABLE, rows_per_file=100)
    folders = (tmp_path / TABLE / f"{TABLE}_days").rglob("part-*.parquet")
    assert len(list(folders)) >= 5
    assert state(spark, root) == ([0] * 1000, 0)


def test_a_compaction_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    add(spark, root, 0, [0, 1])
    add(spark, root, 1, [1])

    def dies(self):
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(Snapshot, "commit", dies)
        with pytest.raises(OSError, match="driver lost"):
            compact.compact(spark, root, TABLE)
    assert state(spark, root) == ([0, 1, 1], 0)
    assert compact.compact(spark, root, TABLE) == 2
    assert state(spark, root) == ([0, 1, 1], 0)


def test_a_reader_goes_on_while_days_are_rewritten(spark, tmp_path):
    root = str(tmp_path)
    add(spark, root, 0, [0, 1])
    events = compact.events_table(spark, root, TABLE)
    add(spark, root, 1, [2])
    compact.compact(spark, root, TABLE)
    assert events.count() == 2
    assert events.where(F.col("timestamp") < F.lit(START + dt.timedelta(hours=1))).count() == 1
