"""Retention by age and by size, and log positions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlane.functions import times
from airlane.operators.sequence import OFFSETS_PER_CHUNK, offset_chunk
from airlane.schemas import (
    HISTORY_RETENTION_HOURS,
    RAW_LOG_RETENTION_BYTES,
    RAW_LOG_RETENTION_HOURS,
)


def retain_by_age(rows: DataFrame, as_of, retention_hours: int = HISTORY_RETENTION_HOURS,
                  column: str = "ingested_at") -> DataFrame:
    """Rows younger than the horizon; rows without the time never expire."""
    horizon = times.as_of_column(as_of) - times.hours(retention_hours)
    return rows.where(F.col(column).isNull() | (F.col(column) > horizon))


def retain_by_size(log: DataFrame, max_bytes: int, size="size",
                   chunk_size: int = OFFSETS_PER_CHUNK) -> DataFrame:
    """The newest rows of each log partition whose sizes add up to at most ``max_bytes``.

    Offset ranges are summed first; that gives each partition the range in which the budget
    ends, a map of one entry per partition. Newer ranges are kept and older ones dropped by a
    filter on the scan; only the rows of the last range are shuffled and ordered.
    """
    place = ["topic", "partition"]
    chunked = log.withColumn("_chunk", offset_chunk(F.col("offset"), chunk_size))
    newer = (
        Window.partitionBy(*place).orderBy(F.desc("_chunk"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    last = (
        chunked.groupBy(*place, "_chunk").agg(F.sum(size).alias("_bytes"))
        .withColumn("_newer", F.coalesce(F.sum("_bytes").over(newer), F.lit(0)))
        .where(F.col("_newer") < max_bytes)
        .groupBy(*place).agg(F.min(F.struct("_chunk", "_newer")).alias("_last"))
    )
    entry = F.struct(F.struct(*place), "_last")
    of = last.agg(F.map_from_entries(F.collect_list(entry)).alias("_map")).scalar()
    end = F.element_at(of, F.struct(*place))
    used = end.getField("_newer") + F.sum(size).over(
        Window.partitionBy(*place).orderBy(F.desc("offset"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    whole = chunked.where(F.col("_chunk") > end.getField("_chunk"))
    partial = chunked.where(F.col("_chunk") == end.getField("_chunk")).withColumn("_used", used)
    return whole.select(*log.columns).unionByName(
        partial.where(F.col("_used") <= max_bytes).select(*log.columns)
    )


def retain_log(log: DataFrame, as_of, retention_hours: int = RAW_LOG_RETENTION_HOURS,
               max_bytes: int = RAW_LOG_RETENTION_BYTES, size="size",
               chunk_size: int = OFFSETS_PER_CHUNK) -> DataFrame:
    """Age and size together, whichever removes a row first.

    Size counts the newest rows of the whole log, so the age filter runs after it.
    """
    kept = retain_by_size(log, max_bytes, size, chunk_size)
    horizon = times.as_of_column(as_of) - times.hours(retention_hours)
    return kept.where(F.col("timestamp") >= horizon)


def next_offsets(messages: DataFrame, topic="kafka_topic", partition="kafka_partition",
                 offset="kafka_offset") -> DataFrame:
    """The position to resume from in every log partition."""
    return messages.groupBy(topic, partition).agg((F.max(offset) + 1).alias("next_offset"))


def join_positions(*vectors: DataFrame) -> DataFrame:
    """Position vectors ``topic, partition, next_offset`` as one; the greatest offset of a partition holds."""
    return reduce(DataFrame.unionByName, vectors).groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))


def after_positions(messages: DataFrame, positions: DataFrame, topic="topic", partition="partition",
                    offset="offset") -> DataFrame:
    """The messages, batch or stream, at or after the next offset of their log partition.

    Those of a partition without a position stay, so nothing is lost. A position vector has a row
    per log partition; how it reaches the messages is left to Spark's size-checked choice.
    """
    known = positions.select(F.col("topic").alias("_topic"), F.col("partition").alias("_partition"),
                             F.col("next_offset").alias("_next"))
    met = (messages[topic] == known["_topic"]) & (messages[partition] == known["_partition"])
    told = messages.join(known, met, "left")
    return told.where(F.col("_next").isNull() | (F.col(offset) >= F.col("_next"))).select(*messages.columns)


def consumer_lag(committed: DataFrame, latest: DataFrame) -> DataFrame:
    """Lag per partition a group has joined; a negative commit means none yet."""
    behind = F.when(
        F.col("committed_offset") >= 0,
        F.greatest(F.lit(0), F.col("latest_offset") - F.col("committed_offset")),
    ).otherwise(F.col("latest_offset"))
    return committed.join(latest, ["topic", "partition"], "left").withColumn(
        "lag", behind.cast("bigint")
    )


def total_lag(lag: DataFrame) -> DataFrame:
    return lag.agg(
        F.coalesce(F.sum("lag"), F.lit(0)).alias("total_lag"), F.count("*").alias("partitions")
    )
