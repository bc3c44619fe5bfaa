from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from headway.plans import event_reports
from headway.schemas import RAIL_EVENT
from headway.sources import samples, tables
from headway.sources.topics import BUS_TOPIC, RAIL_TOPIC, read_message_files
from headway.streaming import codec, ingest, live

EVENT = ("mtr_schedule", "ISL", "KET", "UP", None, "1", "t", "3", True,
         dt.datetime(2024, 1, 2, 3, 4, 5, 678901))


def messages(spark, *rows):
    schema = "topic string, key binary, value binary"
    return spark.createDataFrame([(t, None, v) for t, v in rows], schema)


def good_value(spark):
    return codec.encode(spark.createDataFrame([EVENT], RAIL_EVENT), RAIL_TOPIC).first().value


def test_encode_keys(spark):
    rail = spark.createDataFrame([EVENT], RAIL_EVENT)
    assert bytes(codec.encode(rail, RAIL_TOPIC).first().key) == b"ISL-KET"
    both = spark.createDataFrame(
        [("B1", "x", "y"), ("", "x", "y")], "stop_id string, line string, station string"
    )
    assert [bytes(r.key) for r in codec.encode(both, BUS_TOPIC).collect()] == [b"B1", b"x-y"]


def test_decode_round_trip_and_quarantine(spark):
    good = good_value(spark)
    df = messages(
        spark,
        (RAIL_TOPIC, good),
        (RAIL_TOPIC, good),
        (RAIL_TOPIC, b'{"line": '),
        (RAIL_TOPIC, b"[1, 2]"),
        (RAIL_TOPIC, b"\xff\xfe"),
        (RAIL_TOPIC, None),
        ("other", good),
    )
    decoded = codec.decode(df, RAIL_TOPIC)
    assert [tuple(r) for r in codec.events(decoded).collect()] == [EVENT, EVENT]
    bad = [r.value and bytes(r.value) for r in codec.bad_messages(decoded).collect()]
    assert sorted(bad, key=str) == sorted([b'{"line": ', b"[1, 2]", b"\xff\xfe", None], key=str)


def test_values_are_parsed_once(spark):
    df = codec.decode(messages(spark, (RAIL_TOPIC, good_value(spark))), RAIL_TOPIC)
    for used in (df, codec.events(df), codec.bad_messages(df)):
        plan = used._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def test_utc_offset_is_read(spark):
    value = b'{"line": "ISL", "timestamp": "2024-01-01T10:00:00.123456+00:00"}'
    row = codec.decode(messages(spark, (RAIL_TOPIC, value)), RAIL_TOPIC).first()
    assert row.timestamp == dt.datetime(2024, 1, 1, 10, 0, 0, 123456)


def source(spark, path):
    return lambda topic: read_message_files(spark, path).where(F.col("topic") == topic)


def test_restart_adds_nothing_and_new_events_once(spark, tmp_path):
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "tables")
    good = good_value(spark)
    messages(spark, (RAIL_TOPIC, good), (RAIL_TOPIC, b"bad"), ("other", good)).write.parquet(inbox)
    ingest.drain(source(spark, inbox), root)
    ingest.drain(source(spark, inbox), root)
    assert ingest.events_table(spark, root, ingest.RAIL_TABLE).count() == 1
    messages(spark, (RAIL_TOPIC, good)).write.mode("append").parquet(inbox)
    ingest.drain(source(spark, inbox), root)
    stored = ingest.events_table(spark, root, ingest.RAIL_TABLE)
    assert stored.count() == 2
    assert [r.timestamp for r in stored.collect()] == [EVENT[-1]] * 2
    assert (tmp_path / "tables" / ingest.RAIL_TABLE / "status=ok" / "event_date=2024-01-02").exists()
    assert ingest.events_table(spark, root, ingest.BUS_TABLE).count() == 0
    assert ingest.bad_messages(spark, root, ingest.RAIL_TABLE).count() == 1


@pytest.mark.parametrize("mode", ["complete", "update"])
@pytest.mark.parametrize("report", ["events_per_line", "direction_split", "events_per_minute"])
def test_stream_equals_batch(spark, sf_dir, tmp_path, report, mode):
    view = f"{report}_{mode}"
    stream = getattr(live, report)(samples.stream_rail_events(spark, sf_dir))
    query = (
        stream.writeStream.outputMode(mode)
        .format("memory")
        .queryName(view)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    batch = getattr(event_reports, report)(samples.rail_events(spark, sf_dir))
    assert {tuple(r) for r in spark.table(view).collect()} == {tuple(r) for r in batch.collect()}


def test_live_table_counts_late_events(spark, tmp_path):
    inbox, root = str(tmp_path / "inbox"), str(tmp_path)
    late = (*EVENT[:-1], EVENT[-1] - dt.timedelta(minutes=25))
    for events in ([EVENT, EVENT], [late, (*EVENT[:2], "HKU", *EVENT[3:])]):
        spark.createDataFrame(events, RAIL_EVENT).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(RAIL_EVENT).parquet(inbox)
        live.store(stream, f"{root}/events", f"{root}/checkpoint").awaitTermination()
    stored = spark.read.schema(RAIL_EVENT).parquet(f"{root}/events")
    minutes = {r.minute: r.events for r in live.events_per_minute(stored).collect()}
    assert minutes == {dt.datetime(2024, 1, 2, 3, 4): 3, dt.datetime(2024, 1, 2, 2, 39): 1}
    kpis = live.kpis(live.stations(stored)).first()
    assert (kpis.total_events, kpis.lines_tracked, kpis.stations_tracked) == (4, 1, 2)


def test_streamed_and_loaded_events_are_all_read(spark, tmp_path):
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "tables")
    messages(spark, (RAIL_TOPIC, good_value(spark))).write.parquet(inbox)
    ingest.drain(source(spark, inbox), root)
    assert ingest.rail_events(spark, root).count() == 1
    batch = spark.createDataFrame([EVENT, EVENT], RAIL_EVENT)
    for _ in range(2):
        tables.save_rail_events(batch, root)
        assert ingest.rail_events(spark, root).count() == 3
    tables.save_rail_events(batch.limit(1), root, load="other")
    assert ingest.rail_events(spark, root).count() == 4
    assert {tuple(r) for r in ingest.rail_events(spark, root).collect()} == {EVENT}


def test_a_batch_writes_few_files(spark, tmp_path):
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "tables")
    events = spark.range(1000).selectExpr(
        "'mtr_schedule' event_type", "'ISL' line", "cast(id as string) station",
        "timestampadd(second, cast(id as int), timestamp '2024-01-02') timestamp",
    )
    codec.encode(events, RAIL_TOPIC).repartition(32).write.parquet(inbox)
    ingest.drain(source(spark, inbox), root)
    assert ingest.events_table(spark, root, ingest.RAIL_TABLE).count() == 1000
    assert len(list((tmp_path / "tables" / ingest.RAIL_TABLE).rglob("part-*.parquet"))) <= 4


def test_good_rows_are_dealt_to_all_files_of_a_batch(spark, tmp_path):
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "tables")
    events = spark.range(1000).selectExpr("'bus_eta' event_type", "cast(id as string) stop_id")
    codec.encode(events, BUS_TOPIC).write.parquet(inbox)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ingest.drain(source(spark, inbox), root)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [str(p) for p in (tmp_path / "tables" / ingest.BUS_TABLE).rglob("part-*.parquet")]
    rows = [spark.read.parquet(p).count() for p in files]
    # Two of the four parts may meet in a task, but never all of them.
    assert sum(rows) == 1000 and len(rows) > 1 and max(rows) < 900


def test_parts_of_a_batch_never_meet_in_a_task(spark, tmp_path):
    """However few partitions the session shuffles into, and with tasks put together."""
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "tables")
    events = spark.range(1000).selectExpr("'bus_eta' event_type", "cast(id as string) stop_id")
    codec.encode(events, BUS_TOPIC).write.parquet(inbox)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        ingest.drain(source(spark, inbox), root)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    files = (tmp_path / "tables" / ingest.BUS_TABLE).rglob("part-*.parquet")
    rows = [spark.read.parquet(str(p)).count() for p in files]
    assert sum(rows) == 1000 and len(rows) == 4 and max(rows) < 400


def test_a_large_backlog_takes_several_batches(spark, tmp_path):
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "tables")
    codec.encode(spark.createDataFrame([EVENT] * 8, RAIL_EVENT), RAIL_TOPIC).repartition(4).write.parquet(inbox)
    size = max(p.stat().st_size for p in (tmp_path / "inbox").glob("part-*.parquet"))
    stream = lambda topic: read_message_files(spark, inbox, size).where(F.col("topic") == topic)
    ingest.drain(stream, root)
    assert ingest.events_table(spark, root, ingest.RAIL_TABLE).count() == 8
    assert len(list((tmp_path / "tables" / ingest.RAIL_TABLE / "_spark_metadata").glob("[0-9]*"))) == 4
