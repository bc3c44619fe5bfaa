"""Exact medians that no task has to hold whole.

Values become a histogram, whose rows are dealt to buckets of about equal size in value
order. Prefix sums over the few buckets tell which one or two hold the middle, and
only their values are ranked. Bucket limits come from a sketch of bounded size; they
decide how even the buckets are, never the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKETS = 64


def median(rows: DataFrame, column: str) -> DataFrame:
    """(median): one row; the mean of the middle two of an even number of values, NULL
    without any. NULL values don't count."""
    counts = (
        rows.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    shares = [k / BUCKETS for k in range(1, BUCKETS)]
    limits = counts.agg(F.approx_percentile("value", shares, 16 * BUCKETS)).scalar()
    # A subquery may not sit inside the function, so it is a column first.
    bucket = F.size(F.filter("limits", lambda limit: limit < F.col("value")))
    placed = counts.withColumn("limits", limits).select("value", "n", bucket.alias("bucket"))
    # At most BUCKETS rows, so one task may order them.
    in_order = W.partitionBy(F.lit(0)).orderBy("bucket")
    sums = placed.groupBy("bucket").agg(F.sum("n").alias("own")).select(
        "bucket",
        "own",
        (F.sum("own").over(in_order) - F.col("own")).alias("before"),
        F.sum("own").over(W.partitionBy(F.lit(0))).alias("total"),
    )
    low, high = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    middle = sums.withColumns({"low": low, "high": high}).where(
        (F.col("before") <= F.col("high")) & (F.col("before") + F.col("own") > F.col("low"))
    )
    upto = F.col("before") + F.sum("n").over(W.partitionBy("bucket").orderBy("value"))
    ranked = placed.join(F.broadcast(middle), "bucket").withColumn("upto", upto)
    met = (F.col("upto") - F.col("n") <= F.col("high")) & (F.col("upto") > F.col("low"))
    return ranked.where(met).agg(F.avg("value").alias("median"))
