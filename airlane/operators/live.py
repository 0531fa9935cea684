"""Read queries over the live and history tables."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlane.functions import payload, times
from airlane.schemas import (
    HISTORY_LIMIT_DEFAULT,
    HISTORY_LIMIT_MAX,
    LIVE_LIMIT_DEFAULT,
    LIVE_LIMIT_MAX,
    LIVE_WINDOW_MINUTES,
    PUBLIC_COLUMNS,
    STORED_SCHEMA,
    TABLE_ROWS,
)

# --- fixed values: freshness severity steps in seconds ---------------------
WARNING_AGE_S, CRITICAL_AGE_S = 180, 300


def check_limit(limit: int, maximum: int) -> int:
    if isinstance(limit, bool) or not isinstance(limit, int) or not 1 <= limit <= maximum:
        raise ValueError(f"limit must be between 1 and {maximum}, not {limit!r}")
    return limit


def check_icao24(icao24: str) -> str:
    if not re.fullmatch(r"[0-9a-fA-F]{6}", icao24):
        raise ValueError(f"icao24 must be six hexadecimal characters, not {icao24!r}")
    return icao24.lower()


def public(rows: DataFrame) -> DataFrame:
    """The public columns, typed nulls where the input lacks one."""
    def column(name: str) -> Column:
        if name == "_id":
            candidates = [F.col(c).cast("string") for c in ("_id", "icao24") if c in rows.columns]
            filled = [F.nullif(c, F.lit("")) for c in candidates]
            return F.coalesce(*filled, F.lit("")).alias(name)
        if name in rows.columns:
            return F.col(name)
        return F.lit(None).cast(STORED_SCHEMA[name].dataType).alias(name)

    return rows.select(*(column(name) for name in PUBLIC_COLUMNS))


def recent(rows: DataFrame, as_of, window_minutes: int = LIVE_WINDOW_MINUTES) -> DataFrame:
    """Rows observed at or after ``as_of`` minus the window; no upper bound."""
    since = times.as_of_column(as_of) - times.minutes(window_minutes)
    return rows.where(F.col("observed_at") >= since)


def stale_count(rows: DataFrame, as_of, window_minutes: int = LIVE_WINDOW_MINUTES) -> DataFrame:
    """One row: total, live and hidden aircraft."""
    since = times.as_of_column(as_of) - times.minutes(window_minutes)
    is_live = F.coalesce(F.col("observed_at") >= since, F.lit(False))
    return rows.agg(
        F.count("*").alias("total"),
        F.count_if(is_live).alias("live"),
        F.count_if(~is_live).alias("hidden_stale"),
    )


class LiveList(NamedTuple):
    """A bounded list with its envelope."""

    items: DataFrame
    envelope: DataFrame


def live_page(live: DataFrame, as_of, limit: int = LIVE_LIMIT_DEFAULT,
              window_minutes: int = LIVE_WINDOW_MINUTES) -> LiveList:
    """Newest live aircraft and the one-row envelope ``count, window_minutes, truncated``.

    One row more than the limit is enough to know that something was left out.
    """
    check_limit(limit, LIVE_LIMIT_MAX)
    fresh = recent(live, as_of, window_minutes)
    order = [F.desc("observed_at"), F.asc("icao24")]
    items = public(fresh).orderBy(*order).limit(limit)
    probe = fresh.select("icao24").limit(limit + 1)
    envelope = probe.agg(F.count("*").alias("_n")).select(
        F.least(F.col("_n"), F.lit(limit)).cast("bigint").alias("count"),
        F.lit(window_minutes).alias("window_minutes"),
        (F.col("_n") > limit).alias("truncated"),
    )
    return LiveList(items, envelope)


def aircraft(live: DataFrame, icao24: str) -> DataFrame:
    """The live row of one aircraft; empty when it is unknown."""
    return public(live.where(F.col("icao24") == check_icao24(icao24)))


def aircraft_history(history: DataFrame, icao24: str,
                     limit: int = HISTORY_LIMIT_DEFAULT) -> DataFrame:
    """Newest history rows of one aircraft."""
    check_limit(limit, HISTORY_LIMIT_MAX)
    rows = public(history.where(F.col("icao24") == check_icao24(icao24)))
    return rows.orderBy(*_newest_first()).limit(limit)


def _newest_first() -> list[Column]:
    return [F.desc("observed_at"), F.desc("kafka_offset"), F.asc("_id")]


def history_top_n(history: DataFrame, limit: int = HISTORY_LIMIT_DEFAULT) -> DataFrame:
    """Newest rows of every aircraft, numbered in ``rank``.

    The limit is within Spark's window-group limit, so the scan's tasks keep at most ``limit`` rows
    per aircraft before the only shuffle.
    """
    check_limit(limit, HISTORY_LIMIT_MAX)
    newest = Window.partitionBy("icao24").orderBy(*_newest_first())
    ranked = public(history).withColumn("rank", F.row_number().over(newest))
    return ranked.where(F.col("rank") <= limit).select(*PUBLIC_COLUMNS, "rank")


def ground_counts() -> list[Column]:
    """Total, airborne, grounded and unknown, each row in exactly one of the last three."""
    return [
        F.count("*").alias("total_aircraft"),
        F.count_if(~F.col("on_ground")).alias("airborne"),
        F.count_if(F.col("on_ground")).alias("on_ground"),
        F.count_if(F.col("on_ground").isNull()).alias("unknown_ground_state"),
    ]


def live_statistics(live: DataFrame, as_of,
                    window_minutes: int = LIVE_WINDOW_MINUTES) -> DataFrame:
    """One row of counts; zeros and a null time when nothing is live."""
    return recent(live, as_of, window_minutes).agg(
        *ground_counts(), F.max("observed_at").alias("last_observed_at")
    )


def feed_statistics(feed: DataFrame, as_of,
                    window_minutes: int = LIVE_WINDOW_MINUTES) -> DataFrame:
    """The same counts over a merged feed."""
    return recent(feed, as_of, window_minutes).agg(*ground_counts())


def search(rows: DataFrame, text: str) -> DataFrame:
    """Rows whose address, callsign or country contains the text, case-insensitively.

    The text is literal; an empty one keeps every row.
    """
    needle = text.strip().lower()
    if not needle:
        return rows
    hit = F.col("icao24").contains(needle)
    for name in ("callsign", "origin_country"):
        hit = hit | F.coalesce(F.contains(F.lower(name), F.lit(needle)), F.lit(False))
    return rows.where(hit)


def has_valid_position() -> Column:
    return payload.finite(F.col("latitude")) & payload.finite(F.col("longitude"))


def table_rows(feed: DataFrame, as_of, text: str = "", limit: int = TABLE_ROWS,
               window_minutes: int = LIVE_WINDOW_MINUTES) -> DataFrame:
    """Head of the live rows of the feed that match a search, in the feed's order."""
    return search(recent(feed, as_of, window_minutes), text).orderBy(
        F.coalesce(F.col("observed_at"), F.expr(times.EPOCH)).desc(), F.col("icao24")
    ).limit(limit)


def data_freshness(live: DataFrame, as_of,
                   window_minutes: int = LIVE_WINDOW_MINUTES) -> DataFrame:
    """One row: newest ingestion, its age in whole seconds, status and severity."""
    newest = live.agg(F.max("ingested_at").alias("last_ingested_at"))
    age = times.timestamp_seconds_between(F.col("last_ingested_at"), times.as_of_column(as_of))
    aged = newest.withColumn("age_seconds", F.greatest(F.lit(0).cast("bigint"), age))
    known = F.col("last_ingested_at").isNotNull()
    aged = aged.withColumn("age_seconds", F.when(known, F.col("age_seconds")))
    return aged.withColumns(
        {
            "status": F.when(~known, "empty")
            .when(F.col("age_seconds") <= window_minutes * 60, "fresh")
            .otherwise("stale"),
            "severity": F.when(F.col("age_seconds") >= CRITICAL_AGE_S, "critical")
            .when(F.col("age_seconds") >= WARNING_AGE_S, "warning")
            .when(known, "ok"),
        }
    )
