"""Durable writer: history, live table and dead letters from the message log.

One query reads the log from the earliest offset and writes all three from one classification
of each micro-batch. It moves on only after every write succeeded, and repeating a micro-batch
changes nothing, so delivery is at least once with idempotent effects.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airlane.functions import times
from airlane.operators import deadletter, history, latest, retention, validate
from airlane.schemas import HISTORY_RETENTION_HOURS, LIVE_RETENTION_HOURS, STORED_SCHEMA
from airlane.sources import log, tables


def log_time():
    """When the log took a record: the same in every sink and on every retry."""
    return times.instant_to_utc(F.col("timestamp"))


def valid_events(messages: DataFrame) -> DataFrame:
    return validate.valid(validate.validate(messages, log_time()))


def write_history(events: DataFrame, path: str, horizon_hours: int | None = HISTORY_RETENTION_HOURS,
                  retention_hours: int | None = None) -> None:
    """Append valid events whose ids are not stored yet, see `tables.append_history`.

    Every event is stored, however far behind others its log partition is. With
    ``retention_hours``, date directories that ended longer ago than that, by the newest log
    time of the events, are deleted.
    """
    rows = history.history(events).persist()
    try:
        newest = rows.agg(F.max(log_time())).first()[0]
        if newest is None:
            return
        tables.append_history(rows.select(*STORED_SCHEMA.names, "extra"), path, horizon_hours)
        if retention_hours is not None:
            tables.drop_expired(events.sparkSession, path, newest - timedelta(hours=retention_hours))
    finally:
        rows.unpersist()


def write_live(events: DataFrame, path: str, retention_hours: int = LIVE_RETENTION_HOURS,
               keep_versions: int = 24, positions: DataFrame | None = None) -> None:
    """Merge valid events into the live table and its open members, as the next version.

    Only the aircraft of the batch are looked up, and only those it changed are written. Rows
    older than the retention, by the newest log time of the events, leave the table; a repeated
    batch has the same time and changes nothing. An empty batch writes nothing. ``positions``,
    the batch's next offsets, are kept with the version, see `tables.read_positions`.
    """
    spark = events.sparkSession
    newest = events.agg(F.max(log_time())).first()[0]
    if newest is None:
        return
    current = tables.read_live(spark, path)
    met = current.join(events.select("icao24").distinct(), "icao24", "left_semi").select(*current.columns)
    taken = latest.accepted_after(met, events).persist()
    try:
        changed = taken.where("_turn = 1").select("icao24").distinct()
        merged = latest.fold(taken).select(*current.columns).join(changed, "icao24", "left_semi")
        known = tables.read_members(spark, path).join(changed, "icao24", "left_semi")
        members = latest.merge_members(known, taken)
        tables.write_changes(merged, members, path, newest - timedelta(hours=retention_hours), positions)
        tables.compact_live(spark, path)
        tables.drop_old_versions(spark, path, keep_versions, fold=False)
    finally:
        taken.unpersist()


def write_batch(batch: DataFrame, batch_id: int, history_path: str, live_path: str,
                dead_letters: Callable[[DataFrame, int], None], consumer_group: str,
                horizon_hours: int | None = HISTORY_RETENTION_HOURS,
                history_retention_hours: int | None = None,
                live_retention_hours: int = LIVE_RETENTION_HOURS) -> None:
    """Dead letters, history and live snapshot of one micro-batch, from one classification."""
    classified = validate.validate(batch, log_time()).persist()
    try:
        envelopes = deadletter.envelopes(validate.rejected(classified), consumer_group, log_time())
        dead_letters(deadletter.to_messages(envelopes), batch_id)
        events = validate.valid(classified)
        write_history(events, history_path, horizon_hours, history_retention_hours)
        positions = retention.next_offsets(classified).withColumnsRenamed({"kafka_topic": "topic", "kafka_partition": "partition"})
        write_live(events, live_path, live_retention_hours, positions=positions)
    finally:
        classified.unpersist()


def dead_letter_files(path: str, writer: str = "writer") -> Callable[[DataFrame, int], None]:
    """Dead-letter sink of one directory per micro-batch; a new checkpoint takes a new ``writer`` name."""
    def write(messages: DataFrame, batch_id: int) -> None:
        log.write_files(messages, f"{path}/writer={writer}/batch={batch_id}")

    return write


def dead_letter_kafka(servers: str, topic: str, **options) -> Callable[[DataFrame, int], None]:
    """Dead-letter sink on a log; the envelope's id is the key, so copies are recognisable."""
    def write(messages: DataFrame, batch_id: int) -> None:
        log.write_kafka(messages, servers, topic, **options)

    return write


def start_writer(messages: DataFrame, history_path: str, live_path: str,
                 dead_letters: Callable[[DataFrame, int], None], checkpoint: str,
                 consumer_group: str, horizon_hours: int | None = HISTORY_RETENTION_HOURS,
                 history_retention_hours: int | None = None,
                 live_retention_hours: int = LIVE_RETENTION_HOURS, **trigger) -> StreamingQuery:
    """Keep history, live snapshots and the dead-letter log up to date, see `write_batch`."""
    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, history_path, live_path, dead_letters, consumer_group,
                    horizon_hours, history_retention_hours, live_retention_hours)

    return (
        messages.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def latest_states(messages: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Whole-row latest state as a streaming aggregate, for update or complete mode."""
    events = valid_events(messages).drop("present", "extra", "timestamp")
    return latest.live(events, columns)
