"""Queries of the write side's state: history, live table, feed merge, retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from airlane.operators import history, latest, live, retention, validate
from airlane.plans import views
from airlane.plans.ingest import classified
from airlane.plans.registry import query
from airlane.schemas import LIVE_RETENTION_HOURS, TABLE_ROWS
from airlane.sources import archive, tables

#: The reference time of the positions view.
AS_OF = "(SELECT max(observed_at) FROM positions)"

#: Newest row per aircraft of the positions view under the stored-state rule.
LIVE_SQL = """live AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY icao24
                                     ORDER BY observed_at DESC, kafka_offset) AS rn
        FROM positions) WHERE rn = 1)"""

_ROW = """_id, icao24, callsign, origin_country, latitude, longitude, baro_altitude_m, on_ground,
       velocity_mps, observed_at, ingested_at, kafka_topic, kafka_partition, kafka_offset"""
_ROW_COLUMNS = [c.strip() for c in _ROW.replace("\n", " ").split(",")]


def good(spark, sf_dir):
    return validate.valid(classified(spark, sf_dir))


def sequence_input(spark, sf_dir, *columns):
    """Valid events stored once: computations over sequences scan their input twice."""
    order = ["icao24", "observed_at", "kafka_partition", "kafka_offset"]
    return tables.staged(good(spark, sf_dir).select(*order, *columns), "events")


def stored(spark, sf_dir, *columns):
    """History and live tables of the message log, with the given columns or all.

    The valid events are stored once: both tables read them, and parsing is dearer than all that follows.
    """
    events = good(spark, sf_dir)
    events = tables.staged(events.select(*columns) if columns else events, "events")
    return {"raw_positions": history.history(events), "live_positions": latest.live(events)}


@query(
    f"""
WITH {views.MESSAGES_SQL}
SELECT {_ROW} FROM (
    SELECT *, row_number() OVER (PARTITION BY _id ORDER BY kafka_partition, kafka_offset) AS rn
    FROM good) WHERE rn = 1
"""
)
def raw_positions(spark, sf_dir):
    """History: the first arrival of every event id."""
    return history.history(good(spark, sf_dir).select(
        "event_id", *(c for c in _ROW_COLUMNS if c != "_id"))
    ).select(*_ROW_COLUMNS)


@query(
    f"""
WITH {views.MESSAGES_SQL}
SELECT {_ROW.replace("_id,", "icao24 AS _id,", 1)} FROM (
    SELECT *, row_number() OVER (PARTITION BY icao24
                                 ORDER BY observed_at DESC, kafka_partition, kafka_offset) AS rn
    FROM good) WHERE rn = 1
"""
)
def live_positions(spark, sf_dir):
    """Live table, whole-row rule: newest observation, earliest arrival on a tie."""
    return latest.live(good(spark, sf_dir), _ROW_COLUMNS).select(*_ROW_COLUMNS)


@query(
    f"""
WITH {views.MESSAGES_SQL},
seen AS (
    SELECT *, max(observed_at) OVER (PARTITION BY icao24 ORDER BY kafka_partition, kafka_offset
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
    FROM good
),
taken AS (SELECT * FROM seen WHERE newest IS NULL OR observed_at > newest)
SELECT icao24 AS _id, icao24, max(observed_at) AS observed_at,
       last(latitude ORDER BY kafka_offset) AS latitude,
       last(longitude ORDER BY kafka_offset) AS longitude,
       last(ingested_at ORDER BY kafka_offset) AS ingested_at,
       max(kafka_offset) AS kafka_offset,
       last(callsign ORDER BY kafka_offset) FILTER (WHERE has_callsign) AS callsign,
       last(origin_country ORDER BY kafka_offset) FILTER (WHERE has_country) AS origin_country,
       last(baro_altitude_m ORDER BY kafka_offset) FILTER (WHERE has_altitude) AS baro_altitude_m,
       last(on_ground ORDER BY kafka_offset) FILTER (WHERE has_ground) AS on_ground,
       last(velocity_mps ORDER BY kafka_offset) AS velocity_mps
FROM taken GROUP BY icao24
"""
)
def live_merged(spark, sf_dir):
    """Live table, document-merge rule: an event overrides only the members it carries."""
    fields = ["callsign", "origin_country", "baro_altitude_m", "on_ground", "velocity_mps"]
    others = ["latitude", "longitude", "ingested_at", "kafka_topic", "present"]
    events = sequence_input(spark, sf_dir, *others, *fields)
    return latest.live_merged(events, fields).select(
        "_id", "icao24", "observed_at", "latitude", "longitude", "ingested_at", "kafka_offset",
        *fields,
    )


@query(
    f"""
WITH {views.MESSAGES_SQL},
seen AS (
    SELECT *, max(observed_at) OVER (PARTITION BY icao24 ORDER BY kafka_partition, kafka_offset
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
    FROM good
),
taken AS (SELECT * FROM seen WHERE newest IS NULL OR observed_at > newest),
truths AS (
    SELECT icao24, max(kafka_offset) AS carried, max(kafka_offset) FILTER (number_ground) AS original
    FROM taken WHERE has_ground GROUP BY icao24)
SELECT icao24, 'note' AS name, '"' || last(note ORDER BY kafka_offset) || '"' AS json
FROM taken WHERE note IS NOT NULL GROUP BY icao24
UNION ALL SELECT icao24, 'on_ground', '1' FROM truths WHERE original = carried
"""
)
def live_merged_extra(spark, sf_dir):
    """Open members under the same merge rule, mistyped originals included."""
    return latest.merged_members(sequence_input(spark, sf_dir, "present", "extra")).select("icao24", "name", "json")


@query(
    f"""
WITH {views.MESSAGES_SQL}
SELECT icao24, kafka_offset, observed_at, newest_before FROM (
    SELECT *, max(observed_at) OVER (PARTITION BY icao24 ORDER BY kafka_partition, kafka_offset
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest_before
    FROM good) WHERE observed_at < newest_before
"""
)
def late_events(spark, sf_dir):
    """Events kept in history that arrived too late for the live table."""
    return history.late_events(sequence_input(spark, sf_dir)).select("icao24", "kafka_offset", "observed_at", "newest_before")


# The feed resumes from a snapshot one day old with two days of updates: the day that both
# cover repeats rows at equal time and offset, where the update must win.
_FEED_SQL = f"""
{views.POSITIONS_SQL},
older AS (SELECT * FROM positions WHERE observed_at <= {AS_OF} - INTERVAL 1 DAY),
snapshot AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY icao24
                                     ORDER BY observed_at DESC, kafka_offset) AS rn FROM older)
    WHERE rn = 1),
updates AS (
    SELECT * REPLACE ('feed' AS source) FROM positions
    WHERE observed_at >= {AS_OF} - INTERVAL 2 DAY),
feed AS (
    SELECT * EXCLUDE (rn, u) FROM (
        SELECT *, row_number() OVER (PARTITION BY icao24
                                     ORDER BY observed_at DESC, kafka_offset DESC, u DESC) AS rn
        FROM (SELECT *, 0 AS u FROM snapshot UNION ALL SELECT *, 1 AS u FROM updates))
    WHERE rn = 1)
"""
_FEED_COLUMNS = ["icao24", "callsign", "origin_country", "on_ground", "observed_at", "source",
                 "kafka_offset"]


def feed(spark, sf_dir, columns=None):
    rows = views.positions(spark, sf_dir).select(*(columns or _FEED_COLUMNS), "kafka_partition")
    as_of = views.newest(rows).scalar()
    day = F.expr("INTERVAL 1 DAY")
    snapshot = latest.latest(rows.where(F.col("observed_at") <= as_of - day))
    updates = rows.where(F.col("observed_at") >= as_of - day - day).withColumn(
        "source", F.lit("feed")
    )
    return latest.merge_feed(snapshot, updates).drop("kafka_partition")


@query(f"WITH {_FEED_SQL} SELECT {', '.join(_FEED_COLUMNS)} FROM feed")
def feed_merge(spark, sf_dir):
    """Snapshot and updates merged to one row per aircraft, in feed order."""
    return feed(spark, sf_dir).select(*_FEED_COLUMNS).orderBy(*latest.feed_order())


@query(
    f"""
WITH {views.POSITIONS_SQL}
SELECT {', '.join(_FEED_COLUMNS)}
FROM positions
QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY observed_at DESC, kafka_offset DESC) = 1
"""
)
def feed_resync(spark, sf_dir):
    """Snapshot of the first half of two of three log partitions, and the feed from its positions on: no gap, no repeat."""
    rows = views.positions(spark, sf_dir).select(*_FEED_COLUMNS, "kafka_topic").withColumn(
        "kafka_partition", (F.col("kafka_offset") % 3).cast("int"))
    half = rows.agg(F.max("kafka_offset") / 2).scalar()
    before = rows.where((F.col("kafka_partition") < 2) & (F.col("kafka_offset") <= half))
    positions = retention.next_offsets(before).withColumnsRenamed({"kafka_topic": "topic", "kafka_partition": "partition"})
    after = retention.after_positions(rows, positions, "kafka_topic", "kafka_partition", "kafka_offset")
    return latest.merge_feed(latest.latest(before, "last"), after).select(*_FEED_COLUMNS)


@query(
    f"""
WITH {_FEED_SQL}
SELECT count(*) AS total_aircraft, count(*) FILTER (WHERE NOT on_ground) AS airborne,
       count(*) FILTER (WHERE on_ground) AS on_ground,
       count(*) FILTER (WHERE on_ground IS NULL) AS unknown_ground_state
FROM feed WHERE observed_at >= {AS_OF} - INTERVAL 720 MINUTE
"""
)
def feed_statistics(spark, sf_dir):
    """Ground-state counts over the merged feed."""
    as_of = views.newest(views.positions(spark, sf_dir))
    return live.feed_statistics(feed(spark, sf_dir), as_of, 720)


@query(
    f"""
WITH {_FEED_SQL}
SELECT {', '.join(_FEED_COLUMNS)} FROM feed WHERE observed_at >= {AS_OF} - INTERVAL 720 MINUTE
ORDER BY observed_at DESC, icao24 LIMIT 300
"""
)
def feed_top300(spark, sf_dir):
    """Head of the live part of the merged feed."""
    return _head(spark, sf_dir, TABLE_ROWS)


@query(
    f"""
WITH {_FEED_SQL}
SELECT {', '.join(_FEED_COLUMNS)} FROM feed
WHERE observed_at >= {AS_OF} - INTERVAL 720 MINUTE AND (contains(lower(origin_country), 'e')
    OR contains(lower(callsign), 'e') OR contains(icao24, 'e'))
ORDER BY observed_at DESC, icao24 LIMIT 5
"""
)
def feed_search_top5(spark, sf_dir):
    """Recency, then search, then the head, short enough to cut."""
    return _head(spark, sf_dir, 5, " E ")


def _head(spark, sf_dir, limit, text=""):
    as_of = views.newest(views.positions(spark, sf_dir))
    return live.table_rows(feed(spark, sf_dir), as_of, text, limit, 720).select(*_FEED_COLUMNS)


@query(
    f"""
WITH {views.POSITIONS_SQL}
SELECT _id, ingested_at FROM positions
WHERE ingested_at > (SELECT max(ingested_at) FROM positions) - INTERVAL 48 HOUR
"""
)
def retain_by_age(spark, sf_dir):
    """History rows within the retention horizon."""
    rows = views.positions(spark, sf_dir)
    kept = retention.retain_by_age(rows, views.newest(rows, "ingested_at"))
    return kept.select("_id", "ingested_at")


@query(
    f"""
WITH {views.POSITIONS_SQL}, {LIVE_SQL}
SELECT icao24, ingested_at FROM live
WHERE ingested_at > (SELECT max(ingested_at) FROM positions) - INTERVAL 168 HOUR
"""
)
def live_retained(spark, sf_dir):
    """Live rows within their longer horizon."""
    return _retained(spark, sf_dir, LIVE_RETENTION_HOURS)


@query(
    f"""
WITH {views.POSITIONS_SQL}, {LIVE_SQL}
SELECT icao24, ingested_at FROM live
WHERE ingested_at > (SELECT max(ingested_at) FROM positions) - INTERVAL 6 HOUR
"""
)
def live_retained_6h(spark, sf_dir):
    """Live rows within a horizon that some aircraft have left."""
    return _retained(spark, sf_dir, 6)


def _retained(spark, sf_dir, hours):
    rows = views.positions(spark, sf_dir)
    current = latest.live(rows, ["ingested_at"])
    kept = retention.retain_by_age(current, views.newest(rows, "ingested_at"), hours)
    return kept.select("icao24", "ingested_at")


_LOG_SQL = """
log AS (
    SELECT 'log' AS topic, CAST(user_id % 3 AS INT) AS partition, event_id AS "offset",
           ts AS timestamp, strlen(props) + strlen(event_type) + 20 AS size
    FROM events
)"""


def _log(spark, sf_dir):
    return views.table(spark, sf_dir, "events").selectExpr(
        "'log' AS topic", "CAST(user_id % 3 AS INT) AS partition", "event_id AS offset",
        "ts AS timestamp",
        "CAST(octet_length(props) + octet_length(event_type) + 20 AS BIGINT) AS size",
    )


@query(
    f"""
WITH {_LOG_SQL},
used AS (
    SELECT *, sum(size) OVER (PARTITION BY topic, partition ORDER BY "offset" DESC) AS used
    FROM log
)
SELECT topic, partition, "offset", timestamp FROM used
WHERE used <= 50000 AND timestamp >= (SELECT max(ts) FROM events) - INTERVAL 240 HOUR
"""
)
def retain_by_age_and_size(spark, sf_dir):
    """Log rows kept by ten days or 50 kB per partition, whichever is less."""
    log = _log(spark, sf_dir)
    kept = retention.retain_log(
        log, views.newest(log, "timestamp"), retention_hours=240, max_bytes=50_000
    )
    return kept.select("topic", "partition", "offset", "timestamp")


@query(
    """
SELECT 'log' AS topic, CAST(user_id % 3 AS INT) AS partition, max(event_id) + 1 AS next_offset
FROM events GROUP BY ALL
"""
)
def next_offsets(spark, sf_dir):
    """Where every partition's reader resumes."""
    return retention.next_offsets(_log(spark, sf_dir), "topic", "partition", "offset")


_LAG_SQL = f"""
{_LOG_SQL},
latest AS (SELECT topic, partition, max("offset") + 1 AS latest_offset FROM log GROUP BY ALL),
committed AS (
    SELECT topic, partition,
           CASE WHEN any_value(partition) = 2 THEN -1 ELSE max("offset") FILTER (
               WHERE timestamp <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY) + 1 END
               AS committed_offset
    FROM log GROUP BY ALL),
lag AS (
    SELECT topic, partition, committed_offset, latest_offset,
           CAST(CASE WHEN committed_offset >= 0
                THEN greatest(0, latest_offset - committed_offset)
                ELSE latest_offset END AS BIGINT) AS lag
    FROM committed JOIN latest USING (topic, partition))
"""


def _lag(spark, sf_dir):
    """A group one day behind that has never committed on partition 2."""
    log = _log(spark, sf_dir)
    cut = views.newest(log, "timestamp").scalar() - F.expr("INTERVAL 1 DAY")
    places = log.groupBy("topic", "partition")
    latest_offsets = places.agg((F.max("offset") + 1).alias("latest_offset"))
    seen = F.max(F.when(F.col("timestamp") <= cut, F.col("offset"))) + 1
    committed = places.agg(
        F.when(F.col("partition") == 2, F.lit(-1)).otherwise(seen).alias("committed_offset")
    )
    return retention.consumer_lag(committed, latest_offsets)


@query(f"WITH {_LAG_SQL} SELECT * FROM lag")
def consumer_lag(spark, sf_dir):
    """Lag of a reader group per partition."""
    return _lag(spark, sf_dir)


@query(
    f"WITH {_LAG_SQL} SELECT CAST(sum(lag) AS BIGINT) AS total_lag, count(*) AS partitions FROM lag"
)
def consumer_lag_total(spark, sf_dir):
    """Lag of a reader group over all partitions."""
    return retention.total_lag(_lag(spark, sf_dir))


_STORED_SQL = f"""
{views.MESSAGES_SQL},
raw AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY _id ORDER BY kafka_offset) AS rn FROM good)
    WHERE rn = 1),
live AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY icao24
                                     ORDER BY observed_at DESC, kafka_offset) AS rn FROM good)
    WHERE rn = 1)
"""


@query(
    f"""
WITH {_STORED_SQL},
counts AS (SELECT 'raw_positions' AS "table", count(*) AS rows FROM raw
           UNION ALL SELECT 'live_positions', count(*) FROM live)
SELECT "table", rows FROM counts
UNION ALL SELECT '*', CAST(sum(rows) AS BIGINT) FROM counts
"""
)
def table_counts(spark, sf_dir):
    """Rows of both stored tables and in total."""
    keys = ["event_id", "icao24", "observed_at", "kafka_topic", "kafka_partition", "kafka_offset"]
    return tables.table_counts(stored(spark, sf_dir, *keys))


@query(
    f"""
WITH {_STORED_SQL},
both_tables AS (SELECT 'raw_positions' AS collection, * FROM raw
         UNION ALL SELECT 'live_positions', * REPLACE (icao24 AS _id) FROM live)
SELECT collection, _id, icao24, kafka_offset,
       strftime(observed_at, '%Y-%m-%dT%H:%M:%S.%g') AS observed_at
FROM both_tables
"""
)
def export_rows(spark, sf_dir):
    """Archive lines of both tables, their members read back in one pass over each line."""
    lines = archive.export_lines(stored(spark, sf_dir))
    members = F.json_tuple("document", "_id", "icao24", "kafka_offset", "observed_at")
    return lines.select(
        "collection", members.alias("_id", "icao24", "kafka_offset", "observed_at")
    ).withColumn("kafka_offset", F.col("kafka_offset").cast("bigint"))
