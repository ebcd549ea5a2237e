"""Message-topic source (Kafka) and the message schema.

The Kafka connector jar is not bundled with this package; ``kafka_options``
and ``read_kafka`` build the reader for a cluster that has it.  Everything
downstream takes any DataFrame with ``MESSAGE_SCHEMA`` (tests use parquet).

A new checkpoint starts a fresh consumer (from ``startingOffsets``); a kept
checkpoint resumes from the offsets it recorded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MESSAGE_SCHEMA = ("key binary, value binary, topic string, partition int, offset bigint, "
                  "timestamp timestamp, timestampType int")


def kafka_options(bootstrap_servers: str, topic: str, starting_offsets: str = "earliest",
                  max_offsets_per_trigger: int | None = None, **extra: str) -> dict[str, str]:
    """Options for ``format('kafka')`` subscribing to one topic."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets, "failOnDataLoss": "true"}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_kafka(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """Kafka reader (needs the spark-sql-kafka connector on the classpath)."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load()


def message_id_columns() -> list[str]:
    """Columns that identify a message for receipts and dead letters."""
    return ["topic", "partition", "offset"]
