"""Queries over metric samples ``(ts, metric, labels MAP<STRING,STRING>, value)``.

Label sets are read through ``labels[...]`` and grouped by named labels; a series is
identified by its metric and its sorted label entries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlane.functions import times
from airlane.operators.sequence import previous

# --- fixed values: latency buckets in seconds ------------------------------
LATENCY_BUCKETS_S = (0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
INFINITY_LABEL = "+Inf"


def series_key() -> Column:
    """Series identity: label entries in name order."""
    return F.sort_array(F.map_entries("labels"))


def select_series(samples: DataFrame, metric: str, equals: dict[str, str] | None = None,
                  not_equals: dict[str, str] | None = None,
                  not_matching: dict[str, str] | None = None) -> DataFrame:
    """Samples of a metric by label matchers; a missing label counts as empty text.

    ``not_matching`` patterns must match the whole label to exclude it.
    """
    rows = samples.where(F.col("metric") == metric)
    for name, wanted in (equals or {}).items():
        rows = rows.where(label(name) == wanted)
    for name, unwanted in (not_equals or {}).items():
        rows = rows.where(label(name) != unwanted)
    for name, pattern in (not_matching or {}).items():
        rows = rows.where(~label(name).rlike(f"^(?s:{pattern})\\z"))
    return rows


def label(name: str) -> Column:
    return F.coalesce(F.try_element_at("labels", F.lit(name)), F.lit(""))


def latest_samples(samples: DataFrame, as_of, lookback_minutes: int = 5) -> DataFrame:
    """The newest sample of every series inside the lookback ``(as_of - lookback, as_of]``."""
    now = times.as_of_column(as_of)
    window = samples.where(
        (F.col("ts") <= now) & (F.col("ts") > now - times.minutes(lookback_minutes))
    )
    return (
        window.groupBy("metric", series_key().alias("_series"))
        .agg(F.max_by("value", "ts").alias("value"), F.max("ts").alias("ts"))
        .select("metric", "ts", F.map_from_entries("_series").alias("labels"), "value")
    )


def by_label(rows: DataFrame, labels: Sequence[str], aggregate, value: str = "value",
             extra: Sequence[str] = ()) -> DataFrame:
    """``sum/avg/max by (labels)`` over rows; no labels gives one row."""
    keys = [*extra, *(label(name).alias(name) for name in labels)]
    return rows.groupBy(*keys).agg(aggregate(value).alias(value))


def increases(samples: DataFrame, window_minutes: int = 5, value: str = "value",
              windows_per_chunk: int | None = None) -> DataFrame:
    """Counter growth per series and tumbling window, counting a drop as a restart from zero.

    Growth between two samples belongs to the window of the later one, so window values
    add up to the whole growth. Rates divide by the window length; nothing is extrapolated
    to the window edges. A series is worked on in chunks of ``windows_per_chunk`` windows,
    by default an hour or one window.
    """
    seconds = window_minutes * 60
    per_chunk = windows_per_chunk or max(1, 60 // window_minutes)
    slot = F.floor(times.to_millis(F.col("ts")) / (seconds * 1000)).cast("bigint")
    rows = samples.select(
        "ts", "metric", value, series_key().alias("_series"), slot.alias("_slot")
    ).withColumn("_chunk", F.floor(F.col("_slot") / per_chunk).cast("bigint"))
    rows = previous(
        rows, keys=["metric", "_series"], chunk=["_chunk"], order=["ts"],
        fields=[value], name="_before",
    )
    before = F.col(f"_before.{value}")
    now = F.col(value)
    grown = F.when(F.col("_before").isNull(), F.lit(0.0)).when(now < before, now).otherwise(
        now - before
    )
    # Grouping by the chunk as well keeps the partitioning of the step before.
    return rows.groupBy("metric", "_series", "_chunk", "_slot").agg(
        F.sum(grown).alias("increase")
    ).select(
        "metric",
        F.map_from_entries("_series").alias("labels"),
        times.from_millis(F.col("_slot") * (seconds * 1000)).alias("window_start"),
        "increase",
    )


def rates(samples: DataFrame, window_minutes: int = 5) -> DataFrame:
    """Growth per second per series and window."""
    return increases(samples, window_minutes).withColumn(
        "rate", F.col("increase") / (window_minutes * 60)
    )


def increase_by(samples: DataFrame, labels: Sequence[str], window_minutes: int = 60) -> DataFrame:
    return by_label(
        increases(samples, window_minutes), labels, F.sum, "increase", ["window_start"]
    )


def rate_by(samples: DataFrame, labels: Sequence[str], window_minutes: int = 5,
            aggregate=F.sum) -> DataFrame:
    """``sum by (labels) (rate(...))`` per window."""
    return by_label(rates(samples, window_minutes), labels, aggregate, "rate", ["window_start"])


def histogram_quantile(q: float, buckets: DataFrame, keys: Sequence[str],
                       value: str = "rate") -> DataFrame:
    """Quantile of cumulative bucket rows ``(*keys, le, value)`` by linear interpolation.

    ``le`` is the upper bound as text, ``+Inf`` for the last. A quantile inside the last
    bucket gives the greatest finite bound. Groups without ``+Inf`` or without any
    observation give null. A group has one row per bound, so its window stays small.
    """
    bound = F.when(F.col("le") == INFINITY_LABEL, F.lit(float("inf"))).otherwise(
        F.col("le").cast("double")
    )
    rows = buckets.select(*keys, bound.alias("_upper"), F.col(value).alias("_cum"))
    group = Window.partitionBy(*keys)
    rising = group.orderBy("_upper")
    spread = group.orderBy("_upper").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    rows = rows.withColumns(
        {
            # Rounding may leave a bucket below its predecessor; cumulative counts never fall.
            "_cum": F.max("_cum").over(rising),
        }
    ).withColumns(
        {
            "_total": F.last("_cum").over(spread),
            "_top": F.last("_upper").over(spread),
            "_lower": F.lag("_upper").over(rising),
            "_below": F.lag("_cum", 1, 0.0).over(rising),
        }
    )
    rank = F.lit(q) * F.col("_total")
    finite = F.col("_upper") < F.lit(float("inf"))
    start = F.when(
        F.col("_lower").isNull(), F.when(F.col("_upper") > 0, F.lit(0.0)).otherwise(F.col("_upper"))
    ).otherwise(F.col("_lower"))
    share = F.try_divide(rank - F.col("_below"), F.col("_cum") - F.col("_below"))
    inner = start + (F.col("_upper") - start) * share
    estimate = F.when(finite, inner).otherwise(F.col("_lower"))
    hit = F.when((F.col("_cum") >= rank) & (F.col("_total") > 0)
                 & (F.col("_top") == float("inf")), F.struct("_upper", estimate.alias("_at")))
    return rows.groupBy(*keys).agg(F.min(hit).alias("_hit")).select(
        *keys, F.col("_hit._at").alias("quantile")
    )


def latency_histogram(requests: DataFrame, labels: Sequence[str] = ("method", "route"),
                      seconds: str = "duration_s",
                      buckets: Sequence[float] = LATENCY_BUCKETS_S) -> DataFrame:
    """Cumulative request counts per bucket, with total count and sum of durations.

    All bounds are counted in one pass over the rows; only the group totals are unfolded.
    """
    bounds = [*(str(b) for b in buckets), INFINITY_LABEL]
    counts = [F.count_if(F.col(seconds) <= b) for b in buckets] + [F.count(seconds)]
    wide = requests.groupBy(*labels).agg(
        F.array(*counts).alias("_counts"),
        F.count(seconds).alias("count"),
        F.sum(seconds).alias("sum"),
    )
    return wide.select(
        *labels, "count", "sum",
        F.explode(
            F.arrays_zip(F.array(*(F.lit(b) for b in bounds)).alias("le"),
                         F.col("_counts").alias("n"))
        ).alias("_b"),
    ).select(*labels, F.col("_b.le").alias("le"), F.col("_b.n").alias("cumulative_count"),
             "count", "sum")


def request_counts(requests: DataFrame) -> DataFrame:
    return requests.groupBy("method", "route", "status_code").agg(F.count("*").alias("requests"))


def throughput(events: DataFrame, ts: str = "ts", window_minutes: int = 5) -> DataFrame:
    """Events per second in tumbling windows, counted directly."""
    seconds = window_minutes * 60
    slot = F.floor(times.to_millis(F.col(ts)) / (seconds * 1000)).cast("bigint")
    return events.groupBy(slot.alias("_slot")).agg(F.count("*").alias("events")).select(
        times.from_millis(F.col("_slot") * (seconds * 1000)).alias("window_start"),
        "events",
        (F.col("events") / seconds).alias("rate"),
    )


def percent_used(samples: DataFrame, available: str, total: str,
                 on: Sequence[str] | None = None) -> DataFrame:
    """``100 * (1 - available / total)`` of two gauges matched on ``on``, by default on all labels and time.

    Both gauges are gathered by one grouping; a match that lacks either is left out. Two samples of
    one gauge under one match are an error, as they are two series or a repeated one.
    """
    on = [c for c in samples.columns if c not in ("metric", "value")] if on is None else list(on)

    def gauge(metric: str) -> Column:
        is_own = F.col("metric") == metric
        several = F.raise_error(F.lit(f"{metric} has several series under one match of {', '.join(on)}"))
        return F.when(F.count_if(is_own) > 1, several.cast("double")).otherwise(
            F.max(F.when(is_own, F.col("value"))))

    keys = {c: F.to_json(c) if isinstance(samples.schema[c].dataType, T.MapType) else F.col(c) for c in on}
    keyed = samples.withColumns({f"_on_{c}": k for c, k in keys.items()})
    matched = keyed.where(F.col("metric").isin(available, total)).groupBy(*[f"_on_{c}" for c in on]).agg(
        *[F.first(c).alias(c) for c in on], gauge(available).alias("_a"), gauge(total).alias("_b")
    ).where(F.col("_a").isNotNull() & F.col("_b").isNotNull())
    return matched.select(
        *on, (100 * (1 - F.try_divide(F.col("_a"), F.col("_b")))).alias("percent")
    )


def percent_busy(samples: DataFrame, labels: Sequence[str], window_minutes: int = 5) -> DataFrame:
    """``100 * (1 - avg by (labels) (rate(idle)))`` per window."""
    idle = rate_by(samples, labels, window_minutes, F.avg)
    return idle.select(
        "window_start", *labels, (100 * (1 - F.col("rate"))).alias("percent")
    )
