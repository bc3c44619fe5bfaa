"""Small helpers the operators share: tables, cut lineage, clear column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.session import work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The rows as a Parquet table in the shared folder, read again.

    Cuts the lineage: whatever follows reads files that outlive any executor. Large
    tables of text take a third less disk with "zstd".
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column clashes (Spark
    compares column names without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def batch_parts(array, most_bytes: int = 4 << 20):
    """Slices of an Arrow string or binary array of about ``most_bytes`` each,
    so that work arrays stay small however long the texts of a batch are. One
    value longer than that is a slice of its own."""
    if len(array) == 0:
        return
    lengths = array.nbytes // len(array) + 1
    if lengths * len(array) <= most_bytes:
        yield array
        return
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(array), 0), dtype=np.int64))
    start, before = 0, 0
    while start < len(array):
        stop = int(np.searchsorted(ends, before + most_bytes, side="right"))
        stop = max(stop, start + 1)
        yield array.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])
