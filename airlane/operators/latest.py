"""Latest state per aircraft: whole-row, document-merge and feed rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlane.functions import times
from airlane.operators.sequence import OFFSETS_PER_CHUNK, offset_chunk, running_before
from airlane.schemas import LOG_FIELDS, OPTIONAL_FIELDS

KEY = "icao24"
ARRIVAL = ("kafka_partition", "kafka_offset")


def recency(tie: str) -> Column:
    """Ordering of updates of one aircraft; the greatest wins.

    ``tie="first"`` is the stored state's rule: strictly newer replaces, so on equal time
    the earliest arrival stays. ``tie="last"`` is the feed's rule: on equal time the
    greater offset wins, a missing time counts as the epoch and a missing offset as -1.
    """
    if tie == "first":
        return F.struct(
            F.col("observed_at"), -F.col("kafka_partition"), -F.col("kafka_offset")
        )
    if tie == "last":
        return F.struct(
            F.coalesce(F.col("observed_at"), F.expr(times.EPOCH)),
            F.coalesce(F.col("kafka_offset"), F.lit(-1)),
        )
    raise ValueError(f"tie must be 'first' or 'last', not {tie!r}")


def latest(
    rows: DataFrame, tie: str = "first", columns: Sequence[str] | None = None, *, then=()
) -> DataFrame:
    """One row per aircraft, the one that wins under ``tie`` (then under ``then``).

    Pass ``columns`` to carry only what is read later: the aggregate holds the whole
    struct, so Catalyst cannot prune it. Rows collapse per task before the shuffle.
    """
    kept = list(columns) if columns is not None else rows.columns
    kept = [c for c in kept if c != KEY]
    order = F.struct(recency(tie), *then) if then else recency(tie)
    best = rows.groupBy(KEY).agg(F.max_by(F.struct(*kept), order).alias("_row"))
    return best.select(KEY, "_row.*")


def live(events: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Live table by whole-row replacement; ``_id`` is the aircraft address.

    Input is the validated stream before deduplication: a reused event id with new content
    is ignored by history but still updates the live state.
    """
    kept = None if columns is None else [c for c in columns if c != "_id"]
    return latest(events.drop("_id"), "first", kept).withColumn("_id", F.col(KEY))


def accepted(
    events: DataFrame,
    chunk_size: int = OFFSETS_PER_CHUNK,
    arrival: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Events that replaced the live state on arrival: strictly newer than all before them.

    ``arrival`` names the columns of arrival order, the offset last.
    """
    *places, offset = arrival
    chunked = events.withColumn("_chunk", offset_chunk(F.col(offset), chunk_size))
    return (
        running_before(
            chunked,
            keys=[KEY],
            chunk=[*places, "_chunk"],
            order=list(arrival),
            value=F.col("observed_at"),
            aggregate=F.max,
            name="_newest",
        )
        .where(F.col("_newest").isNull() | (F.col("observed_at") > F.col("_newest")))
        .drop("_newest", "_chunk")
    )


def live_merged(
    events: DataFrame,
    fields: Sequence[str] = OPTIONAL_FIELDS,
    chunk_size: int = OFFSETS_PER_CHUNK,
    arrival: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Live table by document merge.

    An accepted event overrides exactly the members it carries: an explicit null
    overwrites, an absent member keeps the earlier value. ``present`` tells the two apart.
    """
    return fold(accepted(events, chunk_size, arrival), fields)


def fold(rows: DataFrame, fields: Sequence[str] = OPTIONAL_FIELDS) -> DataFrame:
    """One document per aircraft from its accepted events."""
    newest = F.col("observed_at")
    always = ["longitude", "latitude", "ingested_at", *(name for name, _ in LOG_FIELDS)]
    merged = rows.groupBy(KEY).agg(
        F.max("observed_at").alias("observed_at"),
        *(F.max_by(name, newest).alias(name) for name in always),
        *(
            F.max_by(name, F.when(F.col(f"present.{name}"), newest)).alias(name)
            for name in fields
        ),
    )
    return merged.withColumn("_id", F.col(KEY))


def accepted_after(live_table: DataFrame, events: DataFrame,
                   chunk_size: int = OFFSETS_PER_CHUNK) -> DataFrame:
    """Stored rows, as events that carry every member (``_turn`` 0), and what a batch adds (1)."""
    columns = [c for c in live_table.columns if c != "_id"]
    carried = F.struct(*(F.lit(True).alias(name) for name in OPTIONAL_FIELDS))
    before = live_table.select(*columns, carried.alias("present"), F.lit(0).alias("_turn"))
    batch = events.select(*columns, "present", "extra", F.lit(1).alias("_turn"))
    both = before.unionByName(batch, allowMissingColumns=True)
    return accepted(both, chunk_size, ("_turn", *ARRIVAL))


def merge_into(live_table: DataFrame, events: DataFrame,
               chunk_size: int = OFFSETS_PER_CHUNK) -> DataFrame:
    """Live table after a further batch of events, under the document-merge rule.

    Merging a batch again changes nothing: none of its events is strictly newer by then.
    """
    return fold(accepted_after(live_table, events, chunk_size)).select(*live_table.columns)


def _newest_members(rows: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Newest value of each open member, less originals that a typed value has replaced."""
    members = rows.select(KEY, F.explode("extra").alias("name", "json"), "observed_at")
    if before is not None:
        members = before.select(*members.columns).unionByName(members)
    newest = members.groupBy(KEY, "name").agg(
        F.max_by("json", "observed_at").alias("json"), F.max("observed_at").alias("observed_at")
    )
    typed = F.col("name").isin(*OPTIONAL_FIELDS)
    carried = rows.groupBy(KEY).agg(
        *(F.max(F.when(F.col(f"present.{n}"), F.col("observed_at"))).alias(n) for n in OPTIONAL_FIELDS)
    ).unpivot([KEY], list(OPTIONAL_FIELDS), "name", "_carried").where("_carried IS NOT NULL")
    originals = (
        newest.where(typed).join(carried, [KEY, "name"], "left")
        .where("_carried IS NULL OR _carried <= observed_at").drop("_carried")
    )
    return newest.where(~typed).unionByName(originals)


def merged_members(events: DataFrame, chunk_size: int = OFFSETS_PER_CHUNK) -> DataFrame:
    """``icao24, name, json, observed_at``: the live table's open members under the merge rule.

    One row per member, since the names that a producer may use are unbounded. Originals of
    mistyped members last until an event carries the member again.
    """
    return _newest_members(accepted(events, chunk_size))


def merge_members(members: DataFrame, taken: DataFrame) -> DataFrame:
    """Open members after a further batch, of which ``accepted_after`` left ``taken``."""
    return _newest_members(taken.where("_turn = 1"), members)


def extra_map(members: DataFrame) -> DataFrame:
    """``icao24, extra``: the members of each aircraft as a map, for documents written or read whole."""
    entries = F.sort_array(F.collect_list(F.struct("name", "json")))
    return members.groupBy(KEY).agg(F.map_from_entries(entries).alias("extra"))


def merge_feed(snapshot: DataFrame, updates: DataFrame) -> DataFrame:
    """Snapshot rows and pending updates folded to one row per aircraft, newest first.

    On equal time and offset the update wins.
    """
    tagged = snapshot.withColumn("_update", F.lit(0)).unionByName(
        updates.withColumn("_update", F.lit(1)), allowMissingColumns=True
    )
    return latest(tagged, "last", then=[F.col("_update")]).drop("_update")


def feed_order() -> list[Column]:
    """Newest first, a missing time last; the address settles ties."""
    return [F.coalesce(F.col("observed_at"), F.expr(times.EPOCH)).desc(), F.col(KEY)]
