from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from headway import schemas
from headway.plans import rail_reports
from headway.sources import payloads

NOW = dt.datetime(2024, 5, 1, 10, 0, 0, 123456)


def train(dest="TUM", valid="Y", seq="1"):
    return {"seq": seq, "dest": dest, "plat": "1", "time": "2024-05-01 10:05:00",
            "ttnt": "5", "valid": valid}


def answer(data, status=1, isdelay="N", **more):
    return json.dumps({"status": status, "isdelay": isdelay, "data": data, **more})


def frame(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "payload string")


def flat(df):
    clock = F.lit(NOW)
    return [r.asDict() for r in payloads.flatten_schedule(df, observed_at=clock).collect()]


def test_schedule_rows(spark):
    rows = flat(frame(spark, answer({"TML-HUH": {"UP": [train()], "DOWN": [train("WKS")]}})))
    assert rows[0] == {
        "event_type": "mtr_schedule", "line": "TML", "station": "HUH", "direction": "UP",
        "destination": "TUM", "platform": "1", "arrival_time": "2024-05-01 10:05:00",
        "minutes_away": "5", "is_delayed": False, "timestamp": NOW,
    }
    assert [r["direction"] for r in rows] == ["UP", "DOWN"]


def test_schedule_edges(spark):
    assert flat(frame(spark, answer({"TML-HUH": {"UP": [train()]}}, status=0))) == []
    one_way = flat(frame(spark, answer({"TML-HUH": {"UP": [train()]}}, isdelay="Y")))
    assert [(r["direction"], r["is_delayed"]) for r in one_way] == [("UP", True)]
    assert flat(frame(spark, answer({"TML-HUH": {"UP": [train(valid="N")]}}))) == []
    assert flat(frame(spark, answer({}), "{broken", None)) == []
    assert payloads.broken_payloads(
        frame(spark, answer({}), "{broken", None), schemas.SCHEDULE_PAYLOAD
    ).count() == 2


def test_schedule_keeps_the_station_that_was_asked_for(spark):
    data = {"TML-HUH": {"UP": [train()]}, "TML-ETS": {"UP": [train("X")]}}
    asked = spark.createDataFrame(
        [("TML", "HUH", answer(data))], "line string, station string, payload string"
    )
    assert [r["destination"] for r in flat(asked)] == ["TUM"]


def test_clock_defaults_to_now(spark):
    df = payloads.flatten_schedule(frame(spark, answer({"TML-HUH": {"UP": [train()]}})))
    age = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - df.first().timestamp
    assert abs(age) < dt.timedelta(days=2)
    assert df.schema == schemas.RAIL_EVENT or df.columns == schemas.RAIL_EVENT.names


def test_next_trains_and_status(spark):
    df = frame(
        spark,
        answer({"TML-HUH": {"UP": [train(seq="1"), train(seq="2", valid="N")], "DOWN": []}},
               curr_time="2024-05-01 10:00:00", isdelay="Y"),
        answer({}, status=0, message="no service"),
        "{broken",
    )
    shown = rail_reports.next_trains(df, "TML", "HUH").collect()
    assert [tuple(r) for r in shown] == [("UP", "1", "TUM", "1", "2024-05-01 10:05:00", "5")]
    assert [tuple(r) for r in rail_reports.schedule_status(df).collect()] == [
        (True, "2024-05-01 10:00:00", True, None),
        (False, None, False, "no service"),
        (False, None, False, "Unknown error"),
    ]


def test_eta_rows(spark):
    items = [
        {"route": "1A", "dir": "O", "service_type": 1, "dest_en": "Pier", "dest_tc": "碼頭",
         "eta_seq": 1, "eta": "2024-05-01T10:05:00+08:00"},
        {"route": "1A", "eta_seq": 2, "eta": ""},
        {"route": "1A", "eta_seq": 3, "eta": None},
        {"route": "2"},
    ]
    df = spark.createDataFrame(
        [("B1", json.dumps({"data": items})), ("B2", json.dumps({"data": []})), ("B3", "oops")],
        "stop_id string, payload string",
    )
    rows = [tuple(r) for r in payloads.flatten_eta(df, observed_at=F.lit(NOW)).collect()]
    assert rows == [
        ("bus_eta", "B1", "1A", "O", "1", "Pier", "碼頭", 1, "2024-05-01T10:05:00+08:00", NOW)
    ]


def test_next_trains_come_from_the_newest_answer(spark):
    def trains(time, *seqs):
        return answer({"TML-HUH": {"UP": [train(seq=s) for s in seqs]}}, curr_time=time)

    polls = frame(
        spark,
        trains("2024-05-01 10:00:00", "1", "2"),
        trains("2024-05-01 10:01:00", "3"),
        answer({"TML-KSR": {"UP": [train(seq="9")]}}, curr_time="2024-05-01 10:02:00"),
    )
    assert [r.seq for r in rail_reports.next_trains(polls, "TML", "HUH").collect()] == ["3"]
    later = polls.withColumn("observed_at", F.lit("2024-05-01 10:03:00")).unionByName(
        frame(spark, trains("2024-05-01 09:00:00")).withColumn("observed_at", F.lit("2024-05-02"))
    )
    assert rail_reports.next_trains(later, "TML", "HUH").count() == 0
    asked = polls.withColumns({"line": F.lit("TML"), "station": F.lit("HUH")})
    asked = asked.where("payload not like '%KSR%'")
    assert [r.seq for r in rail_reports.next_trains(asked, "TML", "HUH").collect()] == ["3"]


def test_a_bad_sequence_number_costs_one_field(spark):
    items = [{"route": "1A", "eta_seq": s, "eta": "t"} for s in ("", "2")]
    df = spark.createDataFrame([("B1", json.dumps({"data": items}))], "stop_id string, payload string")
    rows = payloads.flatten_eta(df).collect()
    assert [r.eta_seq for r in rows] == [None, 2]
    assert all(r.timestamp is not None for r in rows)
