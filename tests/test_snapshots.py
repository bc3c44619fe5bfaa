"""Tables replaced at once: readers across a replace, writers that die, expiry."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from headway.plans import build
from headway.sources import samples, snapshots, tables
from headway.sources.snapshots import Snapshot


def numbers(df):
    return sorted(r[0] for r in df.collect())


def folders(tmp_path, name):
    return sorted((tmp_path / name).glob("version=*"))


def test_a_reader_goes_on_across_a_replace(spark, tmp_path):
    root = str(tmp_path)
    tables.save(spark.range(5), root, "t")
    before = Snapshot(spark, root)
    rows = before.load("t")
    tables.save(spark.range(5, 9), root, "t")
    assert numbers(rows) == numbers(before.load("t")) == [0, 1, 2, 3, 4]
    assert numbers(tables.load(spark, root, "t")) == [5, 6, 7, 8]


def test_tables_are_shown_together(spark, tmp_path):
    root = str(tmp_path)
    writer = Snapshot(spark, root)
    writer.save(spark.range(2), "a")
    assert numbers(writer.load("a")) == [0, 1]
    assert not tables.exists(spark, root, "a")
    writer.save(spark.range(3), "b")
    writer.mark("run", 7)
    writer.commit()
    state = Snapshot(spark, root)
    assert (state.load("a").count(), state.load("b").count(), state.marked("run")) == (2, 3, 7)
    with pytest.raises(ValueError, match="no table c"):
        state.load("c")
    assert state.marked("other") is None


@pytest.mark.parametrize("dies_in", ["write", "manifest"])
def test_a_writer_that_dies_changes_nothing(spark, tmp_path, monkeypatch, dies_in):
    root = str(tmp_path)
    tables.save(spark.range(5), root, "t")
    writer = Snapshot(spark, root)
    if dies_in == "write":
        broken = spark.range(3).withColumn("id", F.raise_error(F.lit("gone")).cast("bigint"))
        with pytest.raises(Exception, match="gone"):
            writer.save(broken, "t")
    else:
        writer.save(spark.range(3), "t")  # and no commit
    assert numbers(tables.load(spark, root, "t")) == [0, 1, 2, 3, 4]
    assert len(folders(tmp_path, "t")) == 2
    assert snapshots.expire(spark, root, keep_seconds=3600) == 0
    assert snapshots.expire(spark, root, keep_seconds=-1) == 1
    assert numbers(tables.load(spark, root, "t")) == [0, 1, 2, 3, 4]
    tables.save(spark.range(3), root, "t")
    assert numbers(tables.load(spark, root, "t")) == [0, 1, 2]


def test_expiry_keeps_what_readers_may_use(spark, tmp_path):
    root = str(tmp_path)
    for n in (1, 2, 3):
        tables.save(spark.range(n), root, "t")
    tables.save(spark.range(7), root, "u")
    old = Snapshot(spark, root).load("t")
    tables.save(spark.range(4), root, "t")
    assert snapshots.expire(spark, root) == 0
    assert numbers(old) == [0, 1, 2]
    manifest = list((tmp_path / snapshots.MANIFEST).glob("part-*"))
    assert len(manifest) == 1
    assert snapshots.expire(spark, root, keep_seconds=-1) == 3
    assert len(folders(tmp_path, "t")) == 1
    state = Snapshot(spark, root)
    assert (state.load("t").count(), state.load("u").count()) == (4, 7)
    assert snapshots.expire(spark, str(tmp_path / "nothing")) == 0


@pytest.mark.parametrize("step", ["write manifest", "delete manifest", "delete folders"])
def test_expiry_that_dies_loses_nothing(spark, tmp_path, step):
    """The states that a crash between the steps of ``expire`` leaves."""
    root = str(tmp_path)
    for n in (1, 2):
        tables.save(spark.range(n), root, "t")
    manifest = tmp_path / snapshots.MANIFEST
    entries = spark.read.schema(snapshots.ENTRY).json(str(manifest))
    newest = entries.orderBy(F.desc("number")).limit(1).collect()
    earlier = list(manifest.glob("part-*"))
    again = spark.createDataFrame(newest, snapshots.ENTRY).coalesce(1)
    again.write.mode("append").json(str(manifest))
    if step != "write manifest":
        for file in earlier[: 1 if step == "delete manifest" else None]:
            file.unlink()
    assert numbers(tables.load(spark, root, "t")) == [0, 1]
    assert snapshots.expire(spark, root, keep_seconds=-1) == 1
    assert numbers(tables.load(spark, root, "t")) == [0, 1]
    assert len(folders(tmp_path, "t")) == 1


def test_a_build_is_shown_as_a_whole(spark, sf_dir, tmp_path, monkeypatch):
    root, raw = str(tmp_path), samples.raw_feed(spark, sf_dir)
    less = raw | {"trips": raw["trips"].where("cast(trip_id as bigint) % 2 = 0")}
    build.build_all(spark, less, root)

    def counts():
        state = Snapshot(spark, root)
        return [state.load(n).count() for n in ("stg_trips", "route_trips", "mart_trips_per_route")]

    first = counts()

    def dies(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(build, "_log_run", dies)
        with pytest.raises(OSError, match="driver lost"):
            build.build_all(spark, raw, root)
    assert counts() == first
    build.build_all(spark, raw, root)
    assert counts()[0] > first[0]


def test_split_tables_share_a_write(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(10).withColumn(
        snapshots.PART, F.when(F.col("id") < 3, "low").otherwise("high")
    )
    writer = Snapshot(spark, root)
    names = {"low": "small", "high": "large", "none": "empty"}
    assert writer.save_split(rows, "small", names, even=F.count_if(F.col("id") % 2 == 0)) == {
        "small": 3, "large": 7, "empty": 0, "even": 5
    }
    writer.save_split(rows.limit(0), "nothing", {"a": "nothing"})
    writer.commit()
    state = Snapshot(spark, root)
    assert numbers(state.load("small")) == [0, 1, 2]
    assert state.load("large").columns == ["id"]
    assert numbers(state.load("empty")) == numbers(state.load("nothing")) == []
    plan = state.load("small")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(table_part" in plan


def test_parts_are_replaced_one_by_one(spark, tmp_path):
    root = str(tmp_path)

    def put(days, extra):
        rows = spark.createDataFrame([(d, d + extra) for d in days], f"{snapshots.PART} string, value string")
        writer = Snapshot(spark, root)
        writer.save_split(rows, "t", {d: f"t/day={d}" for d in days})
        writer.commit()

    put(["a", "b", "c"], "1")
    put(["b"], "2")
    put(["d", "c"], "3")
    rows = Snapshot(spark, root).load("t")
    assert rows.columns == ["value"] and numbers(rows) == ["a1", "b2", "c3", "d3"]
    assert snapshots.expire(spark, root, keep_seconds=-1) == 0  # each folder still has a part in use
    assert numbers(Snapshot(spark, root).load("t")) == ["a1", "b2", "c3", "d3"]
    put(["a"], "4")
    assert snapshots.expire(spark, root, keep_seconds=-1) == 1
    assert numbers(Snapshot(spark, root).load("t")) == ["a4", "b2", "c3", "d3"]
