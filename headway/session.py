"""Session settings the library expects, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Service times and event times are compared in UTC; AQE picks join strategies
# and splits skewed join partitions from the sizes it sees at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Broadcast limits compare with file sizes, and rows are several times
    # larger in memory than in compressed Parquet.
    "spark.sql.sources.fileCompressionFactor": "5.0",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("headway")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# The folder of each local application that names none.
_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a session on one machine (``local``, ``local[...]``) gets, without the
    setting, a temporary folder of its own; on a cluster a machine-local folder
    would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        context = spark.sparkContext
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _own_dirs:
            _own_dirs[context.applicationId] = tempfile.mkdtemp(prefix="headway-")
        named = _own_dirs[context.applicationId]
    return named.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused between runs."""
    return f"{shared_dir(spark)}/headway/{name}-{uuid.uuid4().hex}"
