"""The keyed message log: Kafka, or files with the same columns."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlane.schemas import BATCH_INTERVAL_MS, BATCH_MAX_MESSAGES, MESSAGE_SCHEMA

#: Kafka's name for the first offset there is.
EARLIEST = -2


def stream_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 max_per_trigger: int | None = None, **options: str) -> DataFrame:
    """Log reader on Kafka; needs the Kafka connector on the class path.

    The durable writer starts at ``earliest``, the realtime feed at ``latest``; each runs
    as its own query with its own checkpoint. Missing offsets fail the query, as data lost
    before it was read must not pass silently.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("includeHeaders", "true")
        .options(**options)
    )
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(*MESSAGE_SCHEMA.names)


def starting_offsets(positions: DataFrame, partitions: dict[str, int]) -> str:
    """Kafka's ``startingOffsets`` for a position vector; partitions without one start at the earliest.

    ``partitions`` holds the number of partitions per topic: Kafka wants all of them named.
    """
    known = {(r.topic, r.partition): r.next_offset for r in positions.collect()}  # a row per log partition
    return json.dumps({t: {str(p): known.get((t, p), EARLIEST) for p in range(n)} for t, n in partitions.items()})


def stream_files(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Log reader on Parquet files that carry the log's columns."""
    return (
        spark.readStream.schema(MESSAGE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )


def stream_realtime(spark: SparkSession, servers: str, topic: str,
                    batch_messages: int = BATCH_MAX_MESSAGES,
                    interval_ms: int = BATCH_INTERVAL_MS, **options: str) -> DataFrame:
    """Log reader of the realtime feed: a batch starts once that many messages wait, or that late.

    It then takes all that wait, so neither limit slows the reading.
    """
    waits = {"minOffsetsPerTrigger": str(batch_messages), "maxTriggerDelay": f"{interval_ms}ms"}
    return stream_kafka(spark, servers, topic, "latest", **{**waits, **options})


def write_kafka(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Deliver every ``(key, value)`` row or fail the write."""
    (
        messages.select("key", "value").write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("topic", topic)
        .options(**options)
        .save()
    )


def write_files(messages: DataFrame, path: str) -> None:
    """Write a closed set of messages as one directory; repeating the write replaces it."""
    messages.write.mode("overwrite").parquet(path)


def observed_counts(messages: DataFrame, observation) -> DataFrame:
    """Attach the number of delivered rows to an ``Observation``."""
    return messages.observe(observation, F.count("*").alias("delivered"))
