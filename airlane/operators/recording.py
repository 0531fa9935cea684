"""Recording rules: counters kept as summaries that merge, so that any window is a fold of stored rows.

A summary of a series over a slot of time holds its first and last sample and the growth between
them, a drop counting as a restart from zero. Two neighbouring summaries merge into one by adding
both growths and the step from the earlier one's last sample to the later one's first; the merge is
associative, so minutes give five minutes, hours or days without the samples.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airlane.functions import times
from airlane.operators.metrics import series_key
from airlane.operators.sequence import previous
from airlane.sources import storage

SUMMARY_SCHEMA = (
    "metric STRING, series ARRAY<STRUCT<key: STRING, value: STRING>>, slot_start TIMESTAMP_NTZ, "
    "first_ts TIMESTAMP_NTZ, first DOUBLE, last_ts TIMESTAMP_NTZ, last DOUBLE, growth DOUBLE"
)
_SERIES = ["metric", "series"]


def _slot(ts: str, minutes: int) -> Column:
    return F.floor(times.to_millis(F.col(ts)) / (minutes * 60_000)).cast("bigint")


def _step(before: Column, now: Column) -> Column:
    """Growth from one sample to the next, none to the first."""
    return F.when(before.isNull(), F.lit(0.0)).when(now < before, now).otherwise(now - before)


def _named(rows: DataFrame, minutes: int) -> DataFrame:
    start = times.from_millis(F.col("_slot") * (minutes * 60_000)).alias("slot_start")
    return rows.select(*_SERIES, start, "_first.ts", "_first.value", "_last.ts", "_last.value", "growth").toDF(
        *_SERIES, "slot_start", "first_ts", "first", "last_ts", "last", "growth")


def summaries(samples: DataFrame, minutes: int = 1) -> DataFrame:
    """A row per series and slot that holds samples; samples without a value are left out.

    One shuffle, by series and slot, serves the order and the grouping. A group is what one series
    sends in one slot.
    """
    rows = samples.where(F.col("ts").isNotNull() & F.col("value").isNotNull()).select(
        "metric", series_key().alias("series"), _slot("ts", minutes).alias("_slot"), "ts", "value")
    inside = Window.partitionBy(*_SERIES, "_slot").orderBy("ts", "value")
    sample = F.struct("ts", "value")
    return _named(
        rows.withColumn("_step", _step(F.lag("value").over(inside), F.col("value")))
        .groupBy(*_SERIES, "_slot").agg(F.min(sample).alias("_first"), F.max(sample).alias("_last"), F.sum("_step").alias("growth")),
        minutes,
    )


def merge(kept: DataFrame, minutes: int) -> DataFrame:
    """Summaries of slots of ``minutes``, from summaries of slots that divide them."""
    rows = kept.withColumn("_slot", _slot("slot_start", minutes))
    inside = Window.partitionBy(*_SERIES, "_slot").orderBy("slot_start")
    joined = _step(F.lag("last").over(inside), F.col("first")) + F.col("growth")
    point = lambda end: F.struct(F.col(f"{end}_ts").alias("ts"), F.col(end).alias("value"))
    return _named(
        rows.withColumn("_grown", joined).groupBy(*_SERIES, "_slot").agg(
            F.min(point("first")).alias("_first"), F.max(point("last")).alias("_last"), F.sum("_grown").alias("growth")),
        minutes,
    )


def increases(kept: DataFrame, window_minutes: int = 5, slots_per_chunk: int = 1440) -> DataFrame:
    """`metrics.increases` from summaries of slots that divide the windows: the same rows and values.

    The step between two summaries belongs to the later one. A series is worked on in chunks of
    slots, so a long one is no single task. The first summary of a series has none before it: to
    read part of a store, begin one slot that holds the series earlier.
    """
    chunk = F.floor(_slot("slot_start", window_minutes) / F.lit(max(1, slots_per_chunk // window_minutes))).cast("bigint")
    rows = kept.select(*_SERIES, "slot_start", "first", "last", "growth", chunk.alias("_chunk"))
    rows = previous(rows, keys=_SERIES, chunk=["_chunk"], order=["slot_start"], fields=["last"], name="_before")
    grown = _step(F.col("_before.last"), F.col("first")) + F.col("growth")
    return rows.groupBy(*_SERIES, "_chunk", _slot("slot_start", window_minutes).alias("_slot")).agg(
        F.sum(grown).alias("increase")
    ).select(
        "metric", F.map_from_entries("series").alias("labels"),
        times.from_millis(F.col("_slot") * (window_minutes * 60_000)).alias("window_start"), "increase",
    )


def rates(kept: DataFrame, window_minutes: int = 5) -> DataFrame:
    """`metrics.rates` from summaries."""
    return increases(kept, window_minutes).withColumn("rate", F.col("increase") / (window_minutes * 60))


# -- the store: a directory per recorded span of time -------------------------------------------------


def _ms(at: datetime) -> int:
    return (at - datetime(1970, 1, 1)) // timedelta(milliseconds=1)


def spans(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """Recorded spans ``(start, end)`` in milliseconds, in order."""
    found = [n.removeprefix("span=") for n in storage.names(spark, path)
             if n.startswith("span=") and storage.exists(spark, f"{path}/{n}/_SUCCESS")]
    return sorted(tuple(map(int, n.split("_"))) for n in found)


def record(samples: DataFrame, path: str, start: datetime, end: datetime, minutes: int = 1) -> None:
    """Summarise the samples of ``[start, end)``, whole slots, and store them as one span.

    No other sample and no stored summary is read, so the work is that of the span. Recording a
    span again, when late samples have come, replaces it; a span that overlaps another is an error.
    """
    spark, span = samples.sparkSession, (_ms(start), _ms(end))
    if span[0] >= span[1] or any(at % (minutes * 60_000) for at in span):
        raise ValueError(f"{start} to {end} is not a span of whole slots of {minutes} min")
    for other in spans(spark, path):
        if other != span and other[0] < span[1] and span[0] < other[1]:
            raise ValueError(f"{start} to {end} overlaps the span {other} stored")
    inside = samples.where((F.col("ts") >= F.lit(start)) & (F.col("ts") < F.lit(end)))
    summaries(inside, minutes).write.mode("overwrite").parquet(f"{path}/span={span[0]}_{span[1]}")


def recorded(spark: SparkSession, path: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Stored summaries of the spans that meet ``[start, end)``; other spans are not opened."""
    low, high = (None if at is None else _ms(at) for at in (start, end))
    where = [f"{path}/span={a}_{b}" for a, b in spans(spark, path)
             if (low is None or b > low) and (high is None or a < high)]
    if not where:
        return spark.createDataFrame([], SUMMARY_SCHEMA)
    return spark.read.schema(SUMMARY_SCHEMA).parquet(*where)
