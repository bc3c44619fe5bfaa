"""Rows that the scans of a finished query returned."""

from __future__ import annotations

from pyspark.sql import DataFrame


def rows_read(df: DataFrame, column: str) -> int:
    """Of the scans that read a column, after filters within the scan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return _returned(plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan, column)


def _returned(plan, column: str) -> int:
    leaves = plan.collectLeaves()
    total = 0
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if "QueryStage" in leaf.nodeName():
            total += _returned(leaf.plan(), column)
        elif leaf.nodeName().startswith("Scan parquet") and column in leaf.output().toString():
            total += leaf.metrics().apply("numOutputRows").value()
    return total
