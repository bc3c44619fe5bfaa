"""Event topics and the broker source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values.
BUS_TOPIC = "hk-bus-eta"
RAIL_TOPIC = "hk-mtr-schedule"


def broker_options(
    servers: str, username: str | None = None, password: str | None = None
) -> dict[str, str]:
    """Connection options; with a user name, SASL over TLS with SCRAM."""
    options = {"kafka.bootstrap.servers": servers}
    if username is not None:
        escaped = {k: v.replace("\\", "\\\\").replace('"', '\\"')
                   for k, v in (("username", username), ("password", password or ""))}
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "SCRAM-SHA-256",
            "kafka.sasl.jaas.config": (
                "org.apache.kafka.common.security.scram.ScramLoginModule required "
                f'username="{escaped["username"]}" password="{escaped["password"]}";'
            ),
        }
    return options


def read_topics(
    spark: SparkSession,
    options: dict[str, str],
    topics: tuple[str, ...] = (BUS_TOPIC, RAIL_TOPIC),
    starting: str = "latest",
    batch_offsets: int = 10_000_000,
) -> DataFrame:
    """A stream of (topic, key, value). Needs Spark's Kafka package.
    ``batch_offsets`` bounds the messages of a batch; a backlog takes several."""
    return (
        spark.readStream.format("kafka")
        .options(**options)
        .option("maxOffsetsPerTrigger", batch_offsets)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .load()
        .select("topic", "key", "value")
    )


def read_message_files(spark: SparkSession, path: str, batch_bytes: int = 256 << 20) -> DataFrame:
    """The same stream from Parquet files of (topic, key, value), for replays
    and tests. ``batch_bytes`` bounds the files of a batch, by size and not by
    number, as files may be of any size; a larger file is a batch of its own."""
    return (
        spark.readStream.schema("topic string, key binary, value binary")
        .option("maxBytesPerTrigger", batch_bytes)
        .parquet(path)
    )
