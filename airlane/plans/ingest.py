"""Queries of the ingest side: snapshots, normalisation, validation, dead letters."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlane.functions import redact, times
from airlane.operators import deadletter, history, live, normalize, validate
from airlane.plans import views
from airlane.plans.registry import query
from airlane.sources import area as stored_area
from airlane.sources import snapshots as snapshot_source
from airlane.sources import tables

_AS_OF = "(SELECT date_trunc('milliseconds', max(ts)) FROM events)"


def states(spark, sf_dir):
    return snapshot_source.explode_states(views.snapshots(spark, sf_dir))


def events(spark, sf_dir):
    """States of the snapshots as typed events, ingested at their snapshot's time."""
    return normalize.normalize_states(
        states(spark, sf_dir), as_of=times.from_epoch_seconds(F.col("api_time"))
    )


def classified(spark, sf_dir):
    return validate.validate(
        views.messages(spark, sf_dir), views.messages_as_of(spark, sf_dir)
    )


@query(
    f"""
WITH {views.SNAPSHOTS_SQL}
SELECT secs AS api_time, CAST(position AS INT) AS position,
       CASE kind WHEN 'sound' THEN upper(icao24) WHEN 'no_address' THEN ''
            WHEN 'text' THEN NULL WHEN 'null' THEN NULL ELSE icao24 END AS address,
       CASE WHEN kind IN ('text', 'null', 'short') THEN false ELSE true END AS long_enough
FROM states
"""
)
def snapshot_explode(spark, sf_dir):
    """Every state of every landed snapshot."""
    element = snapshot_source.element
    return states(spark, sf_dir).select(
        "api_time",
        "position",
        element(0, "string").alias("address"),
        element(normalize.MIN_STATE_LENGTH - 1).isNotNull().alias("long_enough"),
    )


_NORMALIZED_SQL = f"""
WITH {views.SNAPSHOTS_SQL}
SELECT CAST(1 AS INT) AS schema_version, icao24,
       CASE kind WHEN 'sound' THEN 'CS' || u WHEN 'zero_time' THEN 'B' END AS callsign,
       CASE kind WHEN 'sound' THEN event_type WHEN 'bare' THEN NULL ELSE 'X' END AS origin_country,
       CASE kind WHEN 'sound' THEN secs WHEN 'zero_time' THEN 0 END AS time_position,
       make_timestamp(1000000 * CASE kind WHEN 'zero_time' THEN secs + 1 ELSE secs END)
           AS observed_at,
       CASE kind WHEN 'sound' THEN secs + 1 WHEN 'zero_time' THEN secs + 1 WHEN 'blank' THEN 0 END
           AS last_contact,
       CASE kind WHEN 'sound' THEN CAST(lon AS DOUBLE) WHEN 'bare' THEN 1.5e0 ELSE 1e0 END
           AS longitude,
       CASE kind WHEN 'sound' THEN CAST(lat AS DOUBLE) WHEN 'bare' THEN 2.5e0 ELSE 2e0 END
           AS latitude,
       CASE kind WHEN 'sound' THEN CAST(k AS DOUBLE) WHEN 'blank' THEN 3e0 END AS baro_altitude_m,
       CASE kind WHEN 'sound' THEN false WHEN 'blank' THEN true END AS on_ground,
       CASE kind WHEN 'sound' THEN CAST(k AS DOUBLE) WHEN 'bare' THEN NULL ELSE 4e0 END
           AS velocity_mps,
       CASE kind WHEN 'sound' THEN 90e0 WHEN 'bare' THEN NULL ELSE 5e0 END AS true_track_deg,
       CASE kind WHEN 'sound' THEN 0e0 WHEN 'bare' THEN NULL ELSE 6e0 END AS vertical_rate_mps,
       CASE kind WHEN 'sound' THEN CAST(k AS DOUBLE) WHEN 'bare' THEN NULL ELSE 7e0 END
           AS geo_altitude_m,
       CASE kind WHEN 'sound' THEN '1234' WHEN 'blank' THEN '1' END AS squawk,
       CASE kind WHEN 'sound' THEN false WHEN 'blank' THEN false WHEN 'zero_time' THEN true END
           AS spi,
       CAST(CASE kind WHEN 'sound' THEN 0 WHEN 'blank' THEN 0 WHEN 'zero_time' THEN 2 END AS INT)
           AS position_source,
       CAST(CASE kind WHEN 'sound' THEN 3 WHEN 'blank' THEN 1 END AS INT) AS category,
       secs AS api_time, make_timestamp(1000000 * secs) AS ingested_at, 'opensky' AS source
FROM usable WHERE kept
"""


@query(_NORMALIZED_SQL)
def normalize_states(spark, sf_dir):
    """Usable states as typed events (ids aside, which are digests)."""
    return events(spark, sf_dir).drop("event_id")


@query(
    f"""
WITH {views.SNAPSHOTS_SQL}
SELECT count(*) AS api_records, count(*) FILTER (WHERE kept) AS queued,
       count(*) FILTER (WHERE NOT kept) AS skipped
FROM usable
"""
)
def normalize_skipped(spark, sf_dir):
    """Received, queued and skipped states."""
    return normalize.counts(states(spark, sf_dir))


@query(
    f"""
WITH {views.SNAPSHOTS_SQL}
SELECT CASE WHEN kind = 'sound' THEN 'position' WHEN kind = 'zero_time' THEN 'contact'
            ELSE 'api' END AS time_source,
       count(*) AS events,
       max(make_timestamp(1000000 * CASE kind WHEN 'zero_time' THEN secs + 1 ELSE secs END))
           AS newest
FROM usable WHERE kept GROUP BY ALL
"""
)
def observed_fallback(spark, sf_dir):
    """Which of the three times an event took, zero counting as missing."""
    source = (
        F.when(F.coalesce(F.col("time_position"), F.lit(0)) != 0, "position")
        .when(F.coalesce(F.col("last_contact"), F.lit(0)) != 0, "contact")
        .otherwise("api")
    )
    return events(spark, sf_dir).groupBy(source.alias("time_source")).agg(
        F.count("*").alias("events"), F.max("observed_at").alias("newest")
    )


@query(
    f"""
WITH {views.POSITIONS_SQL}
SELECT _id, latitude, longitude FROM positions
WHERE latitude BETWEEN 35 AND 43.5 AND longitude BETWEEN 25 AND 46
"""
)
def area_filter(spark, sf_dir):
    """Positions inside the regional box."""
    rows = normalize.in_area(views.positions(spark, sf_dir), "turkey")
    return rows.select("_id", "latitude", "longitude")


@query(
    f"""
WITH {views.POSITIONS_SQL}
SELECT _id, latitude, longitude FROM positions
WHERE latitude BETWEEN -90 AND -20 AND longitude BETWEEN -180 AND 0
"""
)
def area_filter_wide(spark, sf_dir):
    """Positions inside a box that holds rows of every scale."""
    rows = normalize.in_box(views.positions(spark, sf_dir), (-90.0, -180.0, -20.0, 0.0))
    return rows.select("_id", "latitude", "longitude")


@query(
    f"""
WITH {views.POSITIONS_SQL}
SELECT box, _id, latitude, longitude
FROM positions JOIN (VALUES ('dateline', -60e0, 150e0, 60e0, -150e0), ('north', 60e0, -20e0, 90e0, 35e0),
                            ('south', -75.5e0, -64.25e0, -30e0, 10e0)) AS boxes(box, south, west, north, east)
  ON latitude BETWEEN south AND north
 AND (longitude BETWEEN west AND east OR (west > east AND (longitude >= west OR longitude <= east)))
"""
)
def area_by_cells(spark, sf_dir):
    """Positions stored along the space-filling order, read for three boxes, one across the date line."""
    rows = views.positions(spark, sf_dir).select("_id", "latitude", "longitude")
    path = f"{tables.shared_folder(spark)}/cells-{uuid.uuid4().hex}"
    stored_area.write_by_cell(rows, path)
    boxes = {"dateline": (-60.0, 150.0, 60.0, -150.0), "north": (60.0, -20.0, 90.0, 35.0), "south": (-75.5, -64.25, -30.0, 10.0)}
    found = [stored_area.read_box(spark, path, rows.schema, box).select(F.lit(name).alias("box"), "*") for name, box in boxes.items()]
    return reduce(DataFrame.unionByName, found)


@query(
    f"""
WITH {views.SNAPSHOTS_SQL}
SELECT icao24 AS key, CASE kind WHEN 'sound' THEN 'CS' || u WHEN 'zero_time' THEN 'B' END
           AS callsign,
       strftime(make_timestamp(1000000 * CASE kind WHEN 'zero_time' THEN secs + 1 ELSE secs END),
                '%Y-%m-%dT%H:%M:%S.000+00:00') AS observed_at,
       CASE kind WHEN 'sound' THEN CAST(lon AS DOUBLE) WHEN 'bare' THEN 1.5e0 ELSE 1e0 END
           AS longitude,
       CAST(23 AS INT) AS members
FROM usable WHERE kept
"""
)
def to_messages(spark, sf_dir):
    """Events as keyed messages, read back member by member."""
    rows = normalize.to_messages(events(spark, sf_dir))
    text = F.col("value").cast("string")
    return rows.select(
        F.col("key").cast("string").alias("key"),
        F.get_json_object(text, "$.callsign").alias("callsign"),
        F.get_json_object(text, "$.observed_at").alias("observed_at"),
        F.get_json_object(text, "$.longitude").cast("double").alias("longitude"),
        F.size(F.json_object_keys(text)).alias("members"),
    )


@query(
    f"""
WITH {views.MESSAGES_SQL}
SELECT kafka_topic, kafka_partition, kafka_offset, error_code FROM msgs
"""
)
def validate_errors(spark, sf_dir):
    """Every message with the first rule it failed, if any."""
    return classified(spark, sf_dir).select(
        "kafka_topic", "kafka_partition", "kafka_offset", "error_code"
    )


@query(
    f"""
WITH {views.MESSAGES_SQL}
SELECT CASE WHEN error_code IS NULL THEN 'valid' ELSE 'quarantined' END AS outcome,
       coalesce(error_code, '') AS error_code, count(*) AS messages
FROM msgs GROUP BY ALL
"""
)
def valid_vs_quarantined(spark, sf_dir):
    """Messages per outcome and failed rule."""
    rows = classified(spark, sf_dir)
    outcome = F.when(F.col("error_code").isNull(), "valid").otherwise("quarantined")
    return rows.groupBy(
        outcome.alias("outcome"), F.coalesce("error_code", F.lit("")).alias("error_code")
    ).agg(F.count("*").alias("messages"))


@query(
    f"""
WITH {views.MESSAGES_SQL}
SELECT kafka_offset, icao24, observed_at, ingested_at FROM good
"""
)
def ingested_default(spark, sf_dir):
    """Times of valid events, a missing ingestion time replaced by the reference time."""
    return validate.valid(classified(spark, sf_dir)).select(
        "kafka_offset", "icao24", "observed_at", "ingested_at"
    )


@query(f"WITH {views.MESSAGES_SQL} SELECT kafka_offset, event_id FROM good")
def canonical_event_id(spark, sf_dir):
    """Event ids in canonical form, whatever their spelling."""
    return validate.valid(classified(spark, sf_dir)).select("kafka_offset", "event_id")


@query(f"WITH {views.MESSAGES_SQL} SELECT kafka_offset, _id FROM good")
def event_identity(spark, sf_dir):
    """Identity of valid events: own id or log coordinates."""
    rows = history.with_identity(validate.valid(classified(spark, sf_dir)))
    return rows.select("kafka_offset", "_id")


@query(
    f"""
WITH {views.MESSAGES_SQL}
SELECT kafka_offset, callsign, origin_country, baro_altitude_m, velocity_mps, on_ground,
       has_callsign, has_ground, CASE WHEN note IS NULL THEN NULL ELSE '"' || note || '"' END
           AS note
FROM good
"""
)
def typed_members(spark, sf_dir):
    """Optional members of valid events, which of them are present, and one extra member."""
    return validate.valid(classified(spark, sf_dir)).select(
        "kafka_offset", "callsign", "origin_country", "baro_altitude_m", "velocity_mps",
        "on_ground", F.col("present.callsign").alias("has_callsign"),
        F.col("present.on_ground").alias("has_ground"),
        F.col("extra")["note"].alias("note"),
    )


@query(
    f"""
WITH {views.MESSAGES_SQL}
SELECT CAST(1 AS INT) AS schema_version,
       kafka_topic || ':' || kafka_partition || ':' || kafka_offset AS dlq_id,
       strftime({_AS_OF}, '%Y-%m-%dT%H:%M:%S.%g') || '+00:00' AS failed_at,
       '{views.CONSUMER_GROUP}' AS consumer_group, CAST(1 AS INT) AS attempts,
       'permanent' AS classification, kafka_offset AS source_offset,
       CAST(epoch_us(ts) // 1000 AS BIGINT) AS timestamp_ms,
       base64(encode(icao24)) AS key_base64, 'hop' AS header_name,
       base64(encode(CAST(n AS VARCHAR))) AS header_value,
       'base64' AS payload_encoding,
       CASE WHEN n % 97 = 13 THEN '/2JhZA==' ELSE base64(encode(value_text)) END AS payload_data
FROM msgs WHERE error_code IS NOT NULL
"""
)
def dlq_envelope(spark, sf_dir):
    """Dead-letter envelopes of the rejected messages, scalars only."""
    rows = deadletter.envelopes(
        validate.rejected(classified(spark, sf_dir)),
        views.CONSUMER_GROUP,
        views.messages_as_of(spark, sf_dir),
    )
    return rows.select(
        "schema_version", "dlq_id", "failed_at", "consumer_group", "attempts",
        F.col("error.classification").alias("classification"),
        F.col("source.offset").alias("source_offset"),
        F.col("source.timestamp_ms").alias("timestamp_ms"),
        F.col("source.key_base64").alias("key_base64"),
        F.col("source.headers")[0]["name"].alias("header_name"),
        F.col("source.headers")[0]["value_base64"].alias("header_value"),
        F.col("payload.encoding").alias("payload_encoding"),
        F.col("payload.data").alias("payload_data"),
    )


@query(
    f"""
WITH {views.MESSAGES_SQL}
SELECT kafka_topic, kafka_partition, kafka_offset,
       CASE WHEN n % 97 = 2 THEN 'bad' ELSE upper(icao24) END AS icao24,
       CASE WHEN n % 97 = 2 THEN 'bad' ELSE upper(icao24) END AS _id,
       velocity_mps
FROM msgs WHERE coalesce(error_code, '') <> 'payload'
"""
)
def realtime_valid(spark, sf_dir):
    """Messages that pass the realtime feed's weaker check, as public rows."""
    rows = validate.realtime_events(views.messages(spark, sf_dir)).where(~F.col("skipped"))
    return live.public(rows).select(
        "kafka_topic", "kafka_partition", "kafka_offset", "icao24", "_id", "velocity_mps"
    )


@query(
    f"""
WITH {views.MESSAGES_SQL}
SELECT count(*) AS received,
       count(*) FILTER (WHERE error_code IS NULL) AS processed,
       count(*) FILTER (WHERE error_code IS NOT NULL) AS dead_lettered,
       count(*) FILTER (WHERE coalesce(error_code, '') <> 'payload') AS published,
       count(*) FILTER (WHERE coalesce(error_code, '') = 'payload') AS skipped
FROM msgs
"""
)
def ingest_counters(spark, sf_dir):
    """Counters of both readers of the log, in one pass each."""
    writer = classified(spark, sf_dir).agg(
        F.count("*").alias("received"),
        F.count_if(F.col("error_code").isNull()).alias("processed"),
        F.count_if(F.col("error_code").isNotNull()).alias("dead_lettered"),
    )
    feed = validate.realtime_events(views.messages(spark, sf_dir)).agg(
        F.count_if(~F.col("skipped")).alias("published"),
        F.count_if("skipped").alias("skipped"),
    )
    both = writer.unionByName(feed, allowMissingColumns=True)
    return both.agg(*(F.max(c).alias(c) for c in both.columns))


@query(
    f"""
WITH {views.POSITIONS_SQL}
SELECT _id, CASE WHEN kafka_offset % 3 = 0 THEN ingested_at WHEN kafka_offset % 3 = 1
            THEN observed_at ELSE (SELECT max(observed_at) FROM positions) END AS ingested_at
FROM positions
"""
)
def ingested_backfill(spark, sf_dir):
    """Rows stored without an ingestion time take their observation time, else the reference."""
    rows = views.positions(spark, sf_dir)
    third = F.col("kafka_offset") % 3
    gaps = rows.withColumns(
        {
            "ingested_at": F.when(third == 0, F.col("ingested_at")),
            "observed_at": F.when(third != 2, F.col("observed_at")),
        }
    )
    return validate.backfill_ingested(gaps, views.newest(rows)).select("_id", "ingested_at")


@query(
    """
SELECT event_id, 'user ' || CAST(user_id AS VARCHAR) || ' password=[REDACTED]' ||
    CASE event_id % 3 WHEN 0 THEN ', Authorization=[REDACTED]' WHEN 1 THEN '; Bearer [REDACTED]'
                      ELSE '&Access_Token=[REDACTED]&next=1' END || ' done' AS line
FROM events
"""
)
def redact_text(spark, sf_dir):
    """Log lines with secrets masked."""
    return views.log_lines(spark, sf_dir).select(
        "event_id", redact.redact_text(F.col("line")).alias("line")
    )


@query("SELECT doc_id, text || ' access_token=[REDACTED] end' AS text FROM documents")
def redact_documents(spark, sf_dir):
    """Whole documents, each with a secret behind it, masked."""
    told = F.concat("text", F.lit(" access_token="), F.col("doc_id").cast("string"), F.lit(" end"))
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", redact.redact_text(told).alias("text")
    )


@query(
    """
SELECT event_id, '{"headers":{"Authorization":"[REDACTED]","n":[1,{"api_token":"[REDACTED]"}]},' ||
       '"note":"password=[REDACTED]","k":' || CAST(user_id AS VARCHAR) || '}' AS body
FROM events
"""
)
def redact_json_members(spark, sf_dir):
    """Open members that hold JSON text, masked by name at every depth."""
    body = F.format_string(
        '{"headers":{"Authorization":"%s","n":[1,{"api_token":[%s,{"x":%s}]}]},'
        '"note":"password=%s","k":%s}',
        "event_type", "event_id", "props", "event_type", "user_id",
    )
    rows = views.table(spark, sf_dir, "events").select(
        "event_id", F.create_map(F.lit("body"), body).alias("extra"))
    masked = rows.select(*redact.redact_columns(rows.schema))
    return masked.select("event_id", F.col("extra")["body"].alias("body"))


@query(
    """
SELECT event_id, event_type AS icao24, '[REDACTED]' AS x_auth_token,
       '[REDACTED]' AS client_secret, '[REDACTED]' AS nested_authorization,
       'password=[REDACTED]' AS nested_note, 'Bearer [REDACTED]' AS list_item,
       user_id AS nested_count
FROM events
"""
)
def redact_props(spark, sf_dir):
    """Keyed values masked by name, through maps, lists and structs."""
    rows = views.table(spark, sf_dir, "events").select(
        "event_id",
        F.create_map(
            F.lit("icao24"), F.col("event_type"), F.lit("X-Auth-Token"), F.col("props")
        ).alias("context"),
        F.col("props").alias("client_secret"),
        F.struct(
            F.col("event_type").alias("Authorization"),
            F.concat(F.lit("password="), "event_type").alias("note"),
            F.col("user_id").alias("count"),
        ).alias("headers"),
        F.array(F.concat(F.lit("bearer "), "event_type")).alias("items"),
    )
    masked = rows.select(*redact.redact_columns(rows.schema))
    return masked.select(
        "event_id",
        F.col("context")["icao24"].alias("icao24"),
        F.col("context")["X-Auth-Token"].alias("x_auth_token"),
        "client_secret",
        F.col("headers.Authorization").alias("nested_authorization"),
        F.col("headers.note").alias("nested_note"),
        F.col("items")[0].alias("list_item"),
        F.col("headers.count").alias("nested_count"),
    )
