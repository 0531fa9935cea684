"""History: event identity, first-arrival deduplication, late rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlane.operators.deadletter import log_identity
from airlane.operators.latest import ARRIVAL
from airlane.operators.sequence import OFFSETS_PER_CHUNK, offset_chunk, running_before


def event_identity() -> Column:
    """The event's own id, or its log coordinates."""
    return F.coalesce(F.nullif(F.col("event_id"), F.lit("")), log_identity())


def with_identity(events: DataFrame) -> DataFrame:
    return events.withColumn("_id", event_identity())


def first_arrivals(events: DataFrame, key: str = "_id") -> DataFrame:
    """One row per id, the earliest arrival.

    Copies collapse before the shuffle, so an id redelivered millions of times costs each
    task one row.
    """
    columns = events.columns
    first = F.min_by(F.struct(*columns), F.struct(*ARRIVAL))
    return events.groupBy(F.col(key).alias("_key")).agg(first.alias("_row")).select("_row.*")


def history(events: DataFrame) -> DataFrame:
    """The append-only history table: every distinct valid event."""
    return first_arrivals(with_identity(events))


def late_events(events: DataFrame, chunk_size: int = OFFSETS_PER_CHUNK) -> DataFrame:
    """Events older than something that arrived before them for the same aircraft.

    They belong to history but never reach the live state.
    """
    chunked = events.withColumn("_chunk", offset_chunk(F.col("kafka_offset"), chunk_size))
    return (
        running_before(
            chunked,
            keys=["icao24"],
            chunk=["kafka_partition", "_chunk"],
            order=list(ARRIVAL),
            value=F.col("observed_at"),
            aggregate=F.max,
            name="newest_before",
        )
        .where(F.col("observed_at") < F.col("newest_before"))
        .drop("_chunk")
    )
