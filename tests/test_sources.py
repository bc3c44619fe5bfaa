from __future__ import annotations

import logging
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from headway import catalogue, schemas
from headway.operators import staging
from headway.plans import build, rail_reports
from headway.sources import feed, tables, topics
from headway.session import shared_dir, work_path


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


@pytest.fixture()
def feed_dir(tmp_path):
    write(
        tmp_path / "routes.txt",
        "route_id,agency_id,route_short_name,route_long_name,route_type\n"
        '001,A,1,"Ferry Pier, ""North"" side",3\n0012,A,,Peak,7\n,A,x,no id,3\n',
    )
    write(
        tmp_path / "stops.txt",
        "stop_id,stop_name,stop_lat,stop_lon\n001,First,22.3,114.1\n002,No place,,\n",
    )
    # Another column order than staging's.
    write(tmp_path / "trips.txt", "route_id,service_id,trip_id\n001,wk,0007\n0012,wk,0008\n")
    write(
        tmp_path / "stop_times.txt",
        "trip_id,arrival_time,departure_time,stop_id,stop_sequence\n"
        "0007,06:00:00,06:00:00,001,1\n0008,25:10:00,25:10:00,001,2\n0008,,,,3\n",
    )
    write(
        tmp_path / "calendar.txt",
        "service_id," + ",".join(schemas.DAYS) + ",start_date,end_date\n"
        "wk,1,1,1,1,1,0,0,20240101,20241231\nnull,,1,1,1,1,1,1,20240101,20241231\n",
    )
    return tmp_path


def test_feed_is_read_as_text_by_header(spark, feed_dir):
    raw = feed.read_feed(spark, str(feed_dir))
    assert {f.dataType.simpleString() for df in raw.values() for f in df.schema} == {"string"}
    staged = staging.stage(raw)
    for name, df in staged.items():
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in schemas.STAGING[name].fields
        ]
    assert {tuple(r) for r in staged["stg_routes"].collect()} == {
        ("001", "1", 'Ferry Pier, "North" side', 3),
        ("0012", None, "Peak", 7),
    }
    assert {tuple(r) for r in staged["stg_trips"].collect()} == {
        ("0007", "001", "wk"),
        ("0008", "0012", "wk"),
    }
    assert {tuple(r) for r in staged["stg_stop_times"].collect()} == {
        ("0007", "001", 1, "06:00:00", "06:00:00"),
        ("0008", "001", 2, "25:10:00", "25:10:00"),
    }
    assert {tuple(r) for r in staged["stg_stops"].collect()} == {
        ("001", "First", 22.3, 114.1),
        ("002", "No place", None, None),
    }
    counts = {r.service_id: (r.weekday_count, r.weekend_count)
              for r in staged["stg_calendar"].collect()}
    assert counts == {"wk": (5, 0), "null": (None, 2)}


def test_missing_member_is_skipped_with_a_warning(spark, tmp_path, caplog):
    write(tmp_path / "trips.txt", "trip_id,route_id,service_id\na,b,c\n")
    with caplog.at_level(logging.WARNING):
        raw = feed.read_feed(spark, str(tmp_path))
    assert set(raw) == {"trips"}
    assert "calendar.txt" in caplog.text
    assert set(staging.stage(raw)) == {"stg_trips"}


def test_staging_strict_and_lenient(spark):
    raw = spark.createDataFrame(
        [("r", "1", "x", "bus")], "route_id string, route_short_name string,"
        " route_long_name string, route_type string"
    )
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        staging.routes(raw).collect()
    assert staging.routes(raw, strict=False).first().route_type is None


def test_rail_file_headers(spark, tmp_path):
    write(
        tmp_path / "lines.csv",
        "﻿Line Code , Station Code,English Name,Chinese Name,,\n"
        "ISL,KET,Kennedy Town,堅尼地城,,\nISL,HKU,HKU,香港大學,,\n",
    )
    path = str(tmp_path / "lines.csv")
    plain = feed.read_csv_text(spark, path)
    assert plain.columns == ["Line Code", "Station Code", "English Name", "Chinese Name"]
    renamed = feed.read_rail(spark, path, "mtr_lines_stations")
    assert renamed.columns == ["line_code", "station_code", "station_name_en", "station_name_zh"]
    assert renamed.orderBy("station_code").first().station_name_zh == "香港大學"


def test_unlisted_columns_pass_and_missing_are_ignored(spark):
    df = spark.createDataFrame([("1", "2")], "LINE string, SRC_STATION_NAME string")
    assert feed.rename_rail(df, "mtr_fares").columns == ["line_code", "SRC_STATION_NAME"]


def test_rail_load_lands_csv_and_counts_rows(spark, tmp_path):
    write(tmp_path / "in.csv", 'LINE,SRC_STATION_ID,note\nISL,001,"a ""b"", c"\nTWL,002,\n')
    root = str(tmp_path / "raw")
    assert build.load_rail(spark, {"mtr_fares": str(tmp_path / "in.csv")}, root) == {"mtr_fares": 2}
    # A second load replaces the table.
    build.load_rail(spark, {"mtr_fares": str(tmp_path / "in.csv")}, root)
    assert {tuple(r) for r in tables.load(spark, root, "mtr_fares").drop(feed.FILE_ORDER).collect()} == {
        ("ISL", "001", 'a "b", c'),
        ("TWL", "002", None),
    }


def test_a_landed_file_is_small_however_large_its_source(spark, tmp_path, monkeypatch):
    rows = "".join(f'ISL,{i:03d},"a\nb"\n' for i in range(95))
    write(tmp_path / "in.csv", "LINE,SRC_STATION_ID,note\n" + rows)
    monkeypatch.setattr(build, "LANDED_ROWS", 10)
    root = str(tmp_path / "raw")
    build.load_rail(spark, {"mtr_fares": str(tmp_path / "in.csv")}, root, multiline=True)
    landed = tmp_path / "raw" / "landed" / "mtr_fares"
    assert len(list(landed.glob("part-*.csv"))) == 10
    stored = tables.load(spark, root, "mtr_fares").orderBy(feed.FILE_ORDER).drop(feed.FILE_ORDER)
    assert [tuple(r) for r in stored.collect()] == [("ISL", f"{i:03d}", "a\nb") for i in range(95)]


def test_file_order(spark, tmp_path):
    names = [f"row{i:05d}" for i in range(3000, 0, -1)]
    write(tmp_path / "f.csv", "name\n" + "\n".join(names) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = feed.read_csv_text(spark, str(tmp_path / "f.csv"), file_order=True)
        assert df.rdd.getNumPartitions() > 2
        assert [r.name for r in df.orderBy(feed.FILE_ORDER).collect()] == names
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_file_order_of_many_files_is_short(spark, tmp_path):
    """In the order of paths and rows, without the folder's name in each row."""
    folder = tmp_path / ("long" * 30) / "read here"
    files = ["p=1/a.csv", "p=1/a.csv.2", "p=1/ab.csv", 'p=1/a|b, "c".csv', "p=1/站.csv", "p=10/a.csv", "p=1 0/a.csv"]
    for file in files:
        write(folder / file, "number\n" + "".join(f"{i:05d}\n" for i in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = feed.read_csv_text(spark, str(folder), file_order=True)
        assert df.rdd.getNumPartitions() > len(files)
        rows = df.select("*", "_metadata.file_path").orderBy(feed.FILE_ORDER).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    places = [(f"{r.file_path}|", r.number) for r in rows]
    assert len(set(places)) == len({r[feed.FILE_ORDER] for r in rows}) == 2000 * len(files)
    assert places == sorted(places)
    assert max(len(r[feed.FILE_ORDER]) for r in rows) < 40


def test_a_landed_file_is_hardly_larger_than_its_source(spark, tmp_path):
    rows = "".join(f"ISL,Station {i % 97},Station {i % 89},{i % 300 / 10}\n" for i in range(50_000))
    source = tmp_path / ("long" * 30) / "in.csv"
    write(source, "LINE,SRC_STATION_NAME,DEST_STATION_NAME,OCT_ADT_FARE\n" + rows)
    root = tmp_path / "raw"
    assert build.load_rail(spark, {"mtr_fares": str(source)}, str(root)) == {"mtr_fares": 50_000}
    landed = sum(f.stat().st_size for f in (root / "landed" / "mtr_fares").glob("part-*"))
    assert landed < 1.5 * source.stat().st_size


def test_landed_files_may_be_compressed(spark, tmp_path, monkeypatch):
    rows = "".join(f'ISL,{i:03d},"a\nb"\n' for i in range(95))
    write(tmp_path / "in.csv", "LINE,SRC_STATION_ID,note\n" + rows)
    monkeypatch.setattr(build, "LANDED_ROWS", 10)
    root = str(tmp_path / "raw")
    build.load_rail(spark, {"mtr_fares": str(tmp_path / "in.csv")}, root, multiline=True, codec="gzip")
    landed = tmp_path / "raw" / "landed" / "mtr_fares"
    assert len(list(landed.glob("part-*"))) == len(list(landed.glob("part-*.csv.gz"))) == 10
    stored = tables.load(spark, root, "mtr_fares").orderBy(feed.FILE_ORDER).drop(feed.FILE_ORDER)
    assert [tuple(r) for r in stored.collect()] == [("ISL", f"{i:03d}", "a\nb") for i in range(95)]


@pytest.mark.parametrize("name", ["loaded_light_rail_points", "loaded_bus_stops", "loaded_fare_lookup", "loaded_mean_fares"])
def test_queries_land_less_than_their_source(spark, tmp_path, name):
    items = spark.range(60_000).selectExpr(
        "id * 7 l_orderkey", "id * 13 % 20011 l_partkey", "id * 17 % 1009 l_suppkey", "cast(id % 7 as int) l_linenumber"
    )
    items.write.parquet(f"{tmp_path}/lineitem.parquet")
    earlier = set(Path(shared_dir(spark)).glob(f"headway/{name}-*"))
    catalogue.QUERIES[name](spark, str(tmp_path)).collect()
    (root,) = set(Path(shared_dir(spark)).glob(f"headway/{name}-*")) - earlier

    def size(folder):
        return sum(f.stat().st_size for f in folder.rglob("part-*"))

    assert size(root / "raw" / "landed") < 0.5 * size(root / "in")


def test_build_from_files(spark, feed_dir, tmp_path):
    root = str(tmp_path / "out")
    rows = build.build_from_files(spark, str(feed_dir), root)
    assert rows["stg_stop_times"] == 2
    assert rows["mart_trip_trajectories"] == 2
    assert rows["mart_transfer_hubs"] == 0
    again = build.build_from_files(spark, str(feed_dir), root)
    assert again == rows
    trip = tables.load(spark, root, "mart_route_service_hours").where("route_type = 7").first()
    assert (trip.first_departure, trip.total_trips, trip.total_stops) == ("25:10:00", 1, 1)


def test_clustered_layout_splits_a_hot_key(spark):
    df = spark.range(30000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 500 as string)) k", "cast(id as string) v"
    )
    sizes = (
        tables.clustered(df, "k", "v")
        .groupBy(F.spark_partition_id().alias("p"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("k") == "hot").alias("hot"))
        .collect()
    )
    assert sum(r.n for r in sizes) == 30000
    if len(sizes) > 1:  # AQE may merge the small test partitions
        assert max(r.hot for r in sizes) < 10000


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.sql(f"create database if not exists layouts location '{tmp_path}/layouts'")
    df = spark.range(1000).selectExpr("cast(id % 50 as string) trip_id", "id v")
    tables.save_bucketed(df, "layouts.a", 4, "trip_id")
    tables.save_bucketed(df.groupBy("trip_id").count(), "layouts.b", 4, "trip_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("layouts.a").join(spark.table("layouts.b"), "trip_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rail_event_days_prune_partitions(spark, tmp_path):
    events = spark.range(2000).selectExpr(
        "'KTL' line", "cast(id % 9 as string) station",
        "timestampadd(minute, cast(id * 10 as int), timestamp '2024-01-01') timestamp",
    )
    tables.save_rail_events(events, str(tmp_path))
    tables.save_rail_events(events, str(tmp_path))
    stored = tables.load(spark, str(tmp_path), tables.LOADED_EVENTS)
    part = tables.between(stored, "2024-01-03", "2024-01-04")
    assert part.count() == 144
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_broker_options():
    assert topics.broker_options("b:9092") == {"kafka.bootstrap.servers": "b:9092"}
    options = topics.broker_options("b:9092", "me", 'a"b')
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert options["kafka.sasl.mechanism"] == "SCRAM-SHA-256"
    assert options["kafka.sasl.jaas.config"].endswith('username="me" password="a\\"b";')


class Session:
    """A session with a master and, or not, a shared folder."""

    def __init__(self, master, folder=None):
        self.sparkContext = self.conf = self
        self.master, self.folder, self.applicationId = master, folder, f"{master}-{folder}"

    def get(self, name, default):
        return self.folder or default


def test_work_paths_follow_the_session_setting():
    cluster = Session("spark://host:7077", "hdfs://store/shared/")
    a, b = work_path(cluster, "x"), work_path(cluster, "x")
    assert a != b and a.startswith("hdfs://store/shared/headway/x-")
    for master in ("local", "local[4]"):
        alone = Session(master)
        assert shared_dir(alone) == shared_dir(alone)
        assert work_path(alone, "x").startswith(shared_dir(alone))
    for master in ("spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(Session(master))


def test_a_session_without_the_setting_can_store(tmp_path):
    """In a process of its own, without the machine's defaults."""
    code = (
        "from headway.session import local_session, work_path\n"
        "spark = local_session(1, '1g')\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "path = work_path(spark, 'x')\n"
        "spark.range(3).write.parquet(path)\n"
        "print(spark.read.parquet(path).count())\n"
    )
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run(
        [sys.executable, "-c", code], env=os.environ | {"PYTHONPATH": root, "TMPDIR": str(tmp_path), "SPARK_CONF_DIR": str(tmp_path)},
        capture_output=True, text=True, timeout=300,
    )
    assert done.stdout.strip() == "3", done.stderr[-2000:]


def test_the_entry_works_without_the_training_data_part(tmp_path):
    root = Path(__file__).resolve().parents[1]
    (tmp_path / "headway").mkdir()
    for path in root.glob("headway/*"):
        if path.name != "llm":
            (tmp_path / "headway" / path.name).symlink_to(path)
    (tmp_path / "__spark_entry__.py").symlink_to(root / "__spark_entry__.py")
    code = (
        "import __spark_entry__ as e; q = e.queries()\n"
        "assert set(q) == set(e.oracle_sql()) and len(q) > 100 and 'pipeline' not in q; print('fine')"
    )
    done = subprocess.run(
        [sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300,
        env=os.environ | {"PYTHONPATH": str(tmp_path)},
    )
    assert done.stdout.strip() == "fine", done.stderr[-2000:]


def test_a_failing_write_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path)
    tables.save(spark.range(3), root, "t")
    broken = spark.createDataFrame([("x",)], "id string").select(F.col("id").cast("bigint"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.save(broken, root, "t")
    assert tables.load(spark, root, "t").count() == 3
    tables.save_csv(spark.range(3), f"{root}/c")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.save_csv(broken, f"{root}/c")
    assert feed.read_csv_text(spark, f"{root}/c").count() == 3


def test_csv_of_a_report_is_one_file_and_keeps_blanks(spark, tmp_path):
    df = spark.createDataFrame([(" a ", 1), ("b", 2)], "k string, v bigint").repartition(4)
    tables.save_csv(df, str(tmp_path / "top"), single_file=True)
    assert len(list((tmp_path / "top").glob("part-*.csv"))) == 1
    back = feed.read_csv_text(spark, str(tmp_path / "top"))
    assert {tuple(r) for r in back.collect()} == {(" a ", "1"), ("b", "2")}


def test_feed_columns_are_found_in_any_case_and_must_be_there(spark, tmp_path):
    write(tmp_path / "trips.txt", "TRIP_ID,Route_Id,service_id\na,b,c\n")
    assert [tuple(r) for r in feed.read_feed(spark, str(tmp_path))["trips"].collect()] == [
        ("a", "b", "c")
    ]
    write(tmp_path / "trips.txt", "tripid,route_id,service_id\na,b,c\n")
    with pytest.raises(ValueError, match="trips.txt lacks the columns trip_id"):
        feed.read_feed(spark, str(tmp_path))


def test_a_feed_without_calendar_builds_the_other_marts(spark, feed_dir, tmp_path, caplog):
    root = str(tmp_path / "out")
    build.build_from_files(spark, str(feed_dir), root)
    first = {r.table_name: r.run for r in tables.load(spark, root, "build_log").collect()}
    assert len(set(first.values())) == 1
    raw = feed.read_feed(spark, str(feed_dir))
    del raw["calendar"]
    with caplog.at_level(logging.WARNING):
        rows = build.build_all(spark, raw, root)
    marts_built = [name for name in rows if name.startswith("mart_")]
    assert len(marts_built) == 9 and "mart_weekday_vs_weekend" not in rows
    assert "mart_weekday_vs_weekend is not built, stg_calendar missing" in caplog.text
    second = {r.table_name: r.run for r in tables.load(spark, root, "build_log").collect()}
    assert {n for n in second if second[n] == first[n]} == {
        "stg_calendar", "mart_weekday_vs_weekend"
    }
    fresh = str(tmp_path / "fresh")
    del raw["stop_times"]
    assert set(build.build_all(spark, raw, fresh)) == {
        "stg_routes", "stg_stops", "stg_trips", "mart_trips_per_route"
    }


def test_loaded_rail_tables_keep_file_order_and_line_breaks(spark, tmp_path):
    write(
        tmp_path / "l.csv",
        "\ufeffLine Code,Station Code,English Name,Chinese Name,\n"
        'ISL,KET,"Kennedy\nTown",堅,\nISL,HKU,HKU,香,\nISL,KET,Again,再,\n',
    )
    root = str(tmp_path / "raw")
    rows = build.load_rail(
        spark, {"mtr_lines_stations": str(tmp_path / "l.csv")}, root, multiline=True
    )
    assert rows == {"mtr_lines_stations": 3}
    lines = tables.load(spark, root, "mtr_lines_stations")
    assert [tuple(r) for r in rail_reports.station_picker(lines, "ISL").collect()] == [
        ("KET", "Kennedy\nTown 堅 (KET)"), ("HKU", "HKU 香 (HKU)")
    ]
    assert rail_reports.network_size(lines).first()[:] == (1, 2)


def test_preview_is_in_file_order_without_the_helper_column(spark, tmp_path):
    names = [f"row{i:05d}" for i in range(3000, 0, -1)]
    write(tmp_path / "f.csv", "name\n" + "\n".join(names) + "\n")
    df = feed.read_csv_text(spark, str(tmp_path / "f.csv"), file_order=True)
    shown = rail_reports.light_rail_routes(df)
    assert shown.columns == ["name"]
    assert [r.name for r in shown.collect()] == names[:30]
