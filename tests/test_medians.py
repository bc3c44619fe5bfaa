from __future__ import annotations

import random
import re
import statistics

import pytest

from headway.operators import medians
from headway.plans import reports


def median(spark, values, kind="bigint"):
    rows = spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(4)
    return medians.median(rows, "v").first()[0]


@pytest.mark.parametrize(
    "values",
    [[5], [1, 2], [1, 2, 4, 10], [3, 3, 3, 9], [None, 7, None, 8, 1], [-5, -5, 0, 10**12], [2] * 9 + [1] * 9],
)
def test_small_medians(spark, values):
    assert median(spark, values) == statistics.median(v for v in values if v is not None)


def test_medians_without_values(spark):
    assert median(spark, []) is None
    assert median(spark, [None, None]) is None


@pytest.mark.parametrize("n", [2000, 2001])
def test_medians_of_many_values_and_a_hot_one(spark, monkeypatch, n):
    draw = random.Random(n)
    for values in (
        [draw.randrange(10**9) for _ in range(n)],
        [7] * (n // 3) + [draw.randrange(50) for _ in range(n - n // 3)],
        [2**k % 1009 for k in range(n)],
    ):
        assert median(spark, values) == statistics.median(values)
    doubles = [draw.uniform(-1, 1) for _ in range(n)]
    assert median(spark, doubles, "double") == statistics.median(doubles)
    monkeypatch.setattr(medians, "BUCKETS", 2)
    assert median(spark, doubles, "double") == statistics.median(doubles)


def test_no_exact_percentile_in_the_report(spark):
    points = spark.range(100).selectExpr(
        "cast(id as string) stop_id", "'s' stop_name", "22.3D latitude", "114.1D longitude",
        "id total_departures", "3L route_type",
    )
    df = reports.underserved_stops(points)
    assert df.count() == 50
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"(?<!_)percentile\(|median\(", plan)
