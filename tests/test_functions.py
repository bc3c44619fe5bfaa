from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from headway.functions import grid, labels, times


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_service_time_format(spark):
    values = ["07:05:00", "7:05:00", "25:30:00", "07:5:00", "07:05:00\n", "", None, "abc"]
    valid = [True, True, True, False, False, False, None, False]
    assert column(spark, values, "string", times.is_service_time) == valid
    hours = [7, 7, 25, None, None, None, None, None]
    assert column(spark, values, "string", times.valid_hour) == hours


def test_hour_of_strict_and_lenient(spark):
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        column(spark, ["abc"], "string", times.hour_of)
    assert column(
        spark, ["abc", "31:00:00", ""], "string", lambda v: times.hour_of(v, strict=False)
    ) == [None, 31, None]


def test_epoch_ms(spark):
    values = ["00:00:00", "24:00:01", "bad", None]
    expected = [1704067200000, 1704153601000, None, None]
    assert column(spark, values, "string", times.epoch_ms) == expected


def test_seconds_are_taken_from_the_end_of_a_time(spark):
    values = ["7:05:09", "123:45:56", "07:5:00", "07:05:00\n", "", None]
    assert column(spark, values, "string", times.seconds_of) == [25509, 445556, None, None, None, None]
    plan = spark.range(1).select(times.seconds_of(F.col("id").cast("string")))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count(", -5, 2)") >= 1


def test_display_time(spark):
    values = ["25:30:00", "07:05:00", "7:05:00", "49:00:00", "24:00", "", "noon", None]
    shown = ["01:30 (+1day)", "07:05", "07:05", "25:00 (+1day)", "00:00 (+1day)", "", "noon", None]
    assert column(spark, values, "string", times.display_time) == shown


def test_hour_label(spark):
    assert column(spark, [7, 17], "bigint", times.hour_label) == ["07:00", "17:00"]


def test_mode_labels(spark):
    assert column(spark, [0, 1, 3, 4, 7, None], "bigint", labels.mode_label) == [
        "Tram",
        "MTR",
        "Bus",
        "Ferry",
        "Unknown",
        "Unknown",
    ]


def test_line_names(spark):
    codes = ["ISL", "XYZ", None]
    assert column(spark, codes, "string", labels.line_name) == ["Island Line", "XYZ", None]
    assert column(spark, codes, "string", labels.short_line_name) == ["Island", "XYZ", None]


def test_fare_text(spark):
    assert column(spark, ["12", "5.5"], "string", labels.fare_text) == ["HK$ 12.0", "HK$ 5.5"]


def test_blank_to_null(spark):
    assert column(spark, [" a ", "  ", "", None], "string", labels.blank_to_null) == [
        "a",
        None,
        None,
        None,
    ]


def test_grid_truncates_toward_zero(spark):
    values = [22.30, 22.319, -0.03, -0.01, 0.01]
    assert column(spark, values, "double", grid.cell_index) == [1115, 1115, -1, 0, 0]
    assert column(spark, [0, 1115], "bigint", grid.cell_centre) == [0.01, 1115 * 0.02 + 0.01]
