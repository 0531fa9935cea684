"""Realtime feed: small public micro-batches from the newest messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from airlane.operators import latest, live, retention, validate

Publish = Callable[[DataFrame, int], None]


def public_batch(batch: DataFrame, coalesce: bool = False) -> tuple[DataFrame, DataFrame]:
    """Publishable rows of a micro-batch, and one row of its counters.

    Unusable messages are counted and left out without losing the rows around them. With
    ``coalesce`` only the newest row per aircraft remains, by the feed's rule.
    """
    rows = validate.realtime_events(batch)
    usable = live.public(rows.where(~F.col("skipped")))
    return (latest.latest(usable, "last") if coalesce else usable), rows.agg(*_counters())


def _counters():
    return (
        F.count("*").alias("received"),
        F.count_if("skipped").alias("skipped"),
        F.count_if(~F.col("skipped")).alias("published"),
        F.max(F.when(~F.col("skipped"), F.col("ingested_at"))).alias("newest_ingested_at"),
    )


def resume_positions(batch: DataFrame) -> DataFrame:
    """Next offset per partition after a micro-batch, unusable messages included."""
    return retention.next_offsets(batch, "topic", "partition", "offset")


def start_feed(messages: DataFrame, publish: Publish, checkpoint: str, coalesce: bool = False,
               report: Callable[[dict, int], None] | None = None, positions: DataFrame | None = None,
               **trigger) -> StreamingQuery:
    """Publish every micro-batch; a failed publish fails the batch, which is then repeated.

    ``report`` gets the counters of each published batch: ``received``, ``skipped``,
    ``published`` and ``newest_ingested_at``. Batches follow each other as the reader ends
    them, see `log.stream_realtime`. With the ``positions`` of a snapshot the feed begins with the
    first message after it, see `tables.read_positions`; they must not change under a checkpoint.
    """
    if positions is not None:
        messages = retention.after_positions(messages, positions)

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            rows, counters = public_batch(batch, coalesce)
            publish(rows, batch_id)
            if report is not None:
                report(counters.first().asDict(), batch_id)
        finally:
            batch.unpersist()

    return (
        messages.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )


class ProgressCounters(StreamingQueryListener):
    """Sums the input rows and the named counters that queries observe."""

    def __init__(self) -> None:
        self.totals: dict[str, int] = {}

    def _add(self, name: str, amount: int) -> None:
        self.totals[name] = self.totals.get(name, 0) + amount

    def onQueryStarted(self, event) -> None:
        self._add("queries", 1)

    def onQueryProgress(self, event) -> None:
        self._add("input_rows", event.progress.numInputRows)
        for observation in event.progress.observedMetrics.values():
            for name, value in observation.asDict().items():
                if isinstance(value, int):
                    self._add(name, value)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._add("terminated", 1)


def observed_feed(messages: DataFrame, name: str = "feed") -> DataFrame:
    """The feed as a streaming DataFrame whose progress reports its counters."""
    rows = validate.realtime_events(messages).observe(
        name,
        *_counters(),
    )
    return live.public(rows.where(~F.col("skipped")))
