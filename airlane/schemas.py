"""Schemas and fixed values of the position data model.

Event times are ``TIMESTAMP_NTZ`` holding UTC at millisecond precision.
"""

from __future__ import annotations

from pyspark.sql import types as T

NTZ = T.TimestampNTZType()

# --- fixed values: the position event, version 1 ---------------------------
SCHEMA_VERSION = 1

#: Typed fields of one position event, in wire order.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("icao24", T.StringType()),
        T.StructField("callsign", T.StringType()),
        T.StructField("origin_country", T.StringType()),
        T.StructField("time_position", T.LongType()),
        T.StructField("observed_at", NTZ),
        T.StructField("last_contact", T.LongType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("baro_altitude_m", T.DoubleType()),
        T.StructField("on_ground", T.BooleanType()),
        T.StructField("velocity_mps", T.DoubleType()),
        T.StructField("true_track_deg", T.DoubleType()),
        T.StructField("vertical_rate_mps", T.DoubleType()),
        T.StructField("geo_altitude_m", T.DoubleType()),
        T.StructField("squawk", T.StringType()),
        T.StructField("spi", T.BooleanType()),
        T.StructField("position_source", T.IntegerType()),
        T.StructField("category", T.IntegerType()),
        T.StructField("api_time", T.LongType()),
        T.StructField("ingested_at", NTZ),
        T.StructField("source", T.StringType()),
    ]
)

#: Fields every valid event carries; the others may be absent.
REQUIRED_FIELDS = ("icao24", "longitude", "latitude", "observed_at", "ingested_at")
OPTIONAL_FIELDS = tuple(f.name for f in EVENT_SCHEMA if f.name not in REQUIRED_FIELDS)

#: Log coordinates stored beside every event.
LOG_FIELDS = (
    ("kafka_topic", T.StringType()),
    ("kafka_partition", T.IntegerType()),
    ("kafka_offset", T.LongType()),
)

#: A row of the history or live table: id, event, log coordinates.
STORED_SCHEMA = T.StructType(
    [T.StructField("_id", T.StringType())]
    + list(EVENT_SCHEMA.fields)
    + [T.StructField(name, kind) for name, kind in LOG_FIELDS]
)

#: A history row with all other members of its document as JSON text, and its date.
HISTORY_SCHEMA = T.StructType(
    list(STORED_SCHEMA.fields)
    + [
        T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
        T.StructField("ingest_date", T.DateType()),
    ]
)

#: Open members of the live documents, a row per aircraft and name.
MEMBER_SCHEMA = T.StructType(
    [
        T.StructField("icao24", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("json", T.StringType()),
        T.StructField("observed_at", NTZ),
    ]
)

#: Columns that public reads return, in order.
PUBLIC_COLUMNS = (
    "_id",
    "icao24",
    "callsign",
    "origin_country",
    "latitude",
    "longitude",
    "baro_altitude_m",
    "geo_altitude_m",
    "on_ground",
    "velocity_mps",
    "true_track_deg",
    "vertical_rate_mps",
    "observed_at",
    "ingested_at",
    "source",
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
)

#: Column set of the log reader (the Kafka source's columns, with headers).
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
        T.StructField(
            "headers",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("key", T.StringType()),
                        T.StructField("value", T.BinaryType()),
                    ]
                )
            ),
        ),
    ]
)

# --- fixed values: default limits and horizons -----------------------------
LIVE_LIMIT_DEFAULT, LIVE_LIMIT_MAX = 200, 50_000
HISTORY_LIMIT_DEFAULT, HISTORY_LIMIT_MAX = 100, 1_000
ROUTE_POINTS = 120
TABLE_ROWS = 300
LIVE_WINDOW_MINUTES = 20
HISTORY_RETENTION_HOURS = 48
LIVE_RETENTION_HOURS = 168
RAW_LOG_RETENTION_HOURS, RAW_LOG_RETENTION_BYTES = 48, 10 * 1024**3
DLQ_LOG_RETENTION_HOURS, DLQ_LOG_RETENTION_BYTES = 30 * 24, 1024**3
BATCH_INTERVAL_MS, BATCH_MAX_MESSAGES = 250, 500
