"""Views that give the provided ``events`` table the shape of aircraft data.

Each view exists twice: as a DataFrame and as a SQL common table expression for the
cross-check. Every event becomes rows, so all views grow with the table. Message faults
are chosen by ``event_id`` remainders; the SQL side derives the expected class from the
remainder alone and never parses the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


TOPIC = "aircraft.positions.raw.v1"
CONSUMER_GROUP = "position-writer"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrivals(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """Narrow events, and columns of the files' rows, dealt over the tasks, as the partitions of a log or many landed files bring them.

    Always, whatever the table's size: the work per row that follows outweighs this shuffle. The
    session's number of shuffle partitions is taken as it is, since adaptive execution would join
    partitions by bytes, of which there are few, and not by the work they cause.
    """
    columns = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return table(spark, sf_dir, "events").select(*columns, *more).repartition(parts, "event_id")


# --------------------------------------------------------------------------
# positions: clean typed rows, one per event
# --------------------------------------------------------------------------

#: Expressions both engines read alike; ``{icao24}``, ``{k}``, ``{ts_ms}`` and
#: ``{ingested}`` are filled in per engine.
_POSITION_COLUMNS = """
    CAST(event_id AS STRING) AS _id,
    CAST(event_id AS STRING) AS event_id,
    {icao24} AS icao24,
    CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 1 THEN ''
         ELSE upper(substr(event_type, 1, 3)) || CAST(user_id AS STRING) END AS callsign,
    CASE WHEN event_id % 19 = 0 THEN NULL ELSE upper(event_type) END AS origin_country,
    CAST((event_id * 37) % 18001 AS DOUBLE) / 1e2 - 9e1 AS latitude,
    CASE WHEN event_id % 23 = 5 THEN NULL
         ELSE CAST((event_id * 53) % 36001 AS DOUBLE) / 1e2 - 18e1 END AS longitude,
    CASE WHEN event_id % 17 = 3 THEN NULL ELSE value * 25e0 END AS baro_altitude_m,
    value * 25e0 + 1e2 AS geo_altitude_m,
    CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN true ELSE false END AS on_ground,
    CASE WHEN event_id % 31 = 4 THEN NULL ELSE value / 2e0 END AS velocity_mps,
    CAST({k} AS DOUBLE) * 3.6e0 AS true_track_deg,
    CAST(NULL AS DOUBLE) AS vertical_rate_mps,
    {ts_ms} AS observed_at,
    {ingested} AS ingested_at,
    event_type AS source,
    'positions' AS kafka_topic,
    CAST(0 AS INT) AS kafka_partition,
    event_id AS kafka_offset
"""

POSITIONS_SQL = "positions AS (SELECT " + _POSITION_COLUMNS.format(
    icao24="lpad(lower(to_hex(user_id)), 6, '0')",
    k="json_extract_string(props, '$.k')",
    ts_ms="date_trunc('milliseconds', ts)",
    ingested="date_trunc('milliseconds', ts) + to_seconds(event_id % 300)",
) + " FROM events)"


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = "CAST(date_trunc('MILLISECOND', ts) AS TIMESTAMP_NTZ)"
    columns = _POSITION_COLUMNS.format(
        icao24="lpad(lower(hex(user_id)), 6, '0')",
        k="get_json_object(props, '$.k')",
        ts_ms=ms,
        ingested=f"timestampadd(SECOND, event_id % 300, {ms})",
    )
    return spark.sql(f"SELECT {columns} FROM {{events}}", events=table(spark, sf_dir, "events"))


def newest(rows: DataFrame, column: str = "observed_at") -> DataFrame:
    """Reference time of the queries: the newest time in the data, as a one-cell DataFrame."""
    return rows.agg(F.max(column).alias("as_of"))


# --------------------------------------------------------------------------
# messages: the log, with faults, redeliveries, reused ids and late rows
# --------------------------------------------------------------------------

#: Offsets interleave originals (even) with copies delivered 25 events later (odd).
_COPIES = """
    SELECT *, event_id * 2 AS kafka_offset FROM base
    UNION ALL
    SELECT *, (event_id + 25) * 2 + 1 AS kafka_offset FROM base WHERE event_id % 50 = 20
"""

#: Message text, from base columns: icao24, uuid, obs, obs3 (obs + 3 h), ing, k.
_BODY = """
    '{' || concat_ws(',',
      CASE event_id % 97 WHEN 7 THEN '"schema_version":2' WHEN 11 THEN '"schema_version":null'
           WHEN 12 THEN '"schema_version":2' ELSE '"schema_version":1' END,
      CASE WHEN event_id % 97 = 8 THEN '"event_id":"xyz"'
           WHEN event_id % 97 = 15 THEN NULL
           WHEN event_id % 4 = 1 THEN '"event_id":"{' || upper(uuid) || '}"'
           WHEN event_id % 4 = 2 THEN '"event_id":"urn:uuid:' || uuid || '"'
           WHEN event_id % 4 = 3 THEN '"event_id":"' || replace(uuid, '-', '') || '"'
           ELSE '"event_id":"' || uuid || '"' END,
      CASE WHEN event_id % 97 = 2 THEN '"icao24":"bad"'
           ELSE '"icao24":"' || upper(icao24) || '"' END,
      CASE WHEN event_id % 97 IN (3, 12) THEN '"latitude":95'
           ELSE '"latitude":' || CAST((event_id * 37) % 181 - 90 AS STRING) END,
      CASE WHEN event_id % 97 = 4 THEN '"longitude":"12"'
           ELSE '"longitude":' || CAST((event_id * 53) % 361 - 180 AS STRING) END,
      CASE WHEN event_id % 97 = 5 THEN '"observed_at":"2024-13-01"'
           WHEN event_id % 97 = 17 THEN '"observed_at":"' || obs || '"'
           WHEN event_id % 11 = 4 THEN '"observed_at":"' || obs3 || '+03:00"'
           ELSE '"observed_at":"' || obs || 'Z"' END,
      CASE WHEN event_id % 97 = 6 THEN '"ingested_at":"yesterday"'
           WHEN event_id % 97 = 14 THEN NULL
           ELSE '"ingested_at":"' || ing || '+00:00"' END,
      CASE WHEN event_id % 97 = 9 THEN '"on_ground":"yes"'
           WHEN event_id % 97 = 16 THEN '"on_ground":1'
           WHEN event_type = 'error' THEN NULL
           WHEN event_type = 'signup' THEN '"on_ground":true'
           WHEN event_type = 'view' THEN '"on_ground":null'
           ELSE '"on_ground":false' END,
      CASE event_id % 3 WHEN 0 THEN '"callsign":"CS' || CAST(user_id AS STRING) || '"'
           WHEN 1 THEN NULL ELSE '"callsign":null' END,
      CASE WHEN event_id % 7 = 0 THEN NULL
           ELSE '"origin_country":"' || event_type || '"' END,
      CASE WHEN event_id % 5 = 0 THEN NULL
           ELSE '"baro_altitude_m":' || CAST(k * 100 AS STRING) END,
      '"velocity_mps":' || CAST(event_id % 250 AS STRING),
      CASE WHEN event_id % 13 = 0 THEN '"note":"n' || CAST(event_id AS STRING) || '"' END
    ) || '}'
"""

#: Value text; null stands for bytes that are no text (remainder 13) or for no value (18).
_VALUE = """
    CASE event_id % 97 WHEN 0 THEN 'not-json' WHEN 1 THEN '[1]' WHEN 10 THEN body || ' x'
         WHEN 13 THEN NULL WHEN 18 THEN NULL ELSE body END
"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    base = (
        arrivals(spark, sf_dir)
        .selectExpr(
            "*",
            "CASE WHEN event_id % 41 = 7 THEN ts - INTERVAL '2' DAY ELSE ts END AS obs_ts",
            """explode(IF(event_id % 50 = 20,
                          array(event_id * 2, (event_id + 25) * 2 + 1),
                          array(event_id * 2))) AS kafka_offset""",
        )
        .selectExpr(
            "event_id", "ts", "user_id", "event_type", "kafka_offset",
            "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
            "lpad(lower(hex(user_id)), 6, '0') AS icao24",
            """'00000000-0000-4000-8000-' || lpad(lower(hex(
                 CASE WHEN event_id % 101 = 50 THEN event_id - 1 ELSE event_id END)), 12, '0')
               AS uuid""",
            f'date_format(obs_ts, "{iso}") AS obs',
            f'date_format(obs_ts + INTERVAL 3 HOUR, "{iso}") AS obs3',
            f'date_format(ts, "{iso}") AS ing',
        )
    )
    return base.selectExpr("*", f"{_BODY} AS body").selectExpr(
        "CAST(icao24 AS BINARY) AS key",
        f"""CASE event_id % 97 WHEN 13 THEN unhex('FF626164')
            ELSE CAST({_VALUE} AS BINARY) END AS value""",
        f"'{TOPIC}' AS topic",
        "0 AS partition",
        "kafka_offset AS offset",
        "CAST(ts AS TIMESTAMP) AS timestamp",
        "0 AS timestampType",
        """array(named_struct('key', 'hop',
                'value', CAST(CAST(event_id AS STRING) AS BINARY))) AS headers""",
    )


#: Expected typed rows: ``msgs`` has one row per message with its expected ``error_code``.
MESSAGES_SQL = f"""
base AS (
    SELECT event_id, ts, user_id, event_type,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           lpad(lower(to_hex(user_id)), 6, '0') AS icao24,
           '00000000-0000-4000-8000-' || lpad(lower(to_hex(
               CASE WHEN event_id % 101 = 50 THEN event_id - 1 ELSE event_id END)), 12, '0')
               AS uuid,
           obs AS obs_ts,
           strftime(obs, '%Y-%m-%dT%H:%M:%S.%f') AS obs,
           strftime(obs + INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%S.%f') AS obs3,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ing
    FROM (SELECT *, CASE WHEN event_id % 41 = 7 THEN ts - INTERVAL 2 DAY ELSE ts END AS obs
          FROM events)
),
copies AS ({_COPIES}),
texts AS (SELECT *, {_BODY} AS body FROM copies),
msgs AS (
    SELECT event_id AS n, '{TOPIC}' AS kafka_topic, 0 AS kafka_partition, kafka_offset,
           ts, user_id, body, {_VALUE} AS value_text,
           CASE WHEN event_id % 97 IN (0, 1, 10, 13, 18) THEN 'payload'
                WHEN event_id % 97 = 2 THEN 'icao24'
                WHEN event_id % 97 IN (3, 12) THEN 'latitude'
                WHEN event_id % 97 = 4 THEN 'longitude'
                WHEN event_id % 97 = 5 THEN 'observed_at'
                WHEN event_id % 97 = 6 THEN 'ingested_at'
                WHEN event_id % 97 IN (7, 11) THEN 'schema_version'
                WHEN event_id % 97 = 8 THEN 'event_id'
                WHEN event_id % 97 = 9 THEN 'on_ground' END AS error_code,
           CASE WHEN event_id % 97 <> 15 THEN uuid END AS event_id,
           icao24,
           CASE WHEN event_id % 3 = 0 THEN 'CS' || CAST(user_id AS VARCHAR) END AS callsign,
           event_id % 3 <> 1 AS has_callsign,
           CASE WHEN event_id % 7 <> 0 THEN event_type END AS origin_country,
           event_id % 7 <> 0 AS has_country,
           CAST((event_id * 37) % 181 - 90 AS DOUBLE) AS latitude,
           CAST((event_id * 53) % 361 - 180 AS DOUBLE) AS longitude,
           CASE WHEN event_id % 5 <> 0 THEN CAST(k * 100 AS DOUBLE) END AS baro_altitude_m,
           event_id % 5 <> 0 AS has_altitude,
           CAST(event_id % 250 AS DOUBLE) AS velocity_mps,
           CASE WHEN event_id % 97 = 16 OR event_type IN ('error', 'view') THEN NULL
                ELSE event_type = 'signup' END AS on_ground,
           event_id % 97 = 16 OR event_type <> 'error' AS has_ground,
           event_id % 97 = 16 AS number_ground,
           CASE WHEN event_id % 13 = 0 THEN 'n' || CAST(event_id AS VARCHAR) END AS note,
           date_trunc('milliseconds', obs_ts) AS observed_at,
           CASE WHEN event_id % 97 = 14 THEN (SELECT date_trunc('milliseconds', max(ts)) FROM events)
                ELSE date_trunc('milliseconds', ts) END AS ingested_at
    FROM texts
),
good AS (
    SELECT *, coalesce(event_id, kafka_topic || ':' || kafka_partition || ':' || kafka_offset)
              AS _id
    FROM msgs WHERE error_code IS NULL
)
"""


def messages_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest_ts = F.max("ts")
    return table(spark, sf_dir, "events").agg(
        F.date_trunc("MILLISECOND", newest_ts).cast("timestamp_ntz").alias("as_of")
    )


# --------------------------------------------------------------------------
# snapshots: one landed payload per event, one sound and one doubtful state each
# --------------------------------------------------------------------------

#: The second state's defect by remainder of ``event_id % 8``.
_SNAPSHOT = """
    CASE WHEN event_id % 53 = 9 THEN '{"time":' || t || ',"states":null}' ELSE
    '{"time":' || t || ',"states":[' ||
      '["' || upper(icao24) || '"," CS' || u || ' ","' || event_type || '",' || t || ',' || t1 ||
        ',' || lon || ',' || lat || ',' || k || ',false,' || k || ',90,0,null,' || k ||
        ',"1234",false,0,3],' ||
      CASE event_id % 8
        WHEN 0 THEN '["' || icao24 || '","A","X",' || t || ',' || t || ',1,2,3,false,4,5,6,null,7,"1",false]'
        WHEN 1 THEN '["' || icao24 || '","B","X",0,' || t1 || ',1,2,null,null,4,5,6,null,7,null,true,2]'
        WHEN 2 THEN '["' || icao24 || '","C","X",' || t || ',' || t || ',null,2,3,false,4,5,6,null,7,"1",false,0,1]'
        WHEN 3 THEN '["","D","X",' || t || ',' || t || ',1,2,3,false,4,5,6,null,7,"1",false,0,1]'
        WHEN 4 THEN '["' || icao24 || '","   ","X",null,0,1,2,3,true,4,5,6,null,7,"1",false,0,1]'
        WHEN 5 THEN '"not a state"'
        WHEN 6 THEN 'null'
        ELSE '["' || icao24 || '",null,null,null,null,1.5,2.5,null,null,null,null,null,null,null,null,null,null,null]'
      END || ']}' END
"""

SNAPSHOTS_SQL = f"""
parts AS (
    SELECT event_id, event_type, user_id, ts,
           lpad(lower(to_hex(user_id)), 6, '0') AS icao24,
           CAST(user_id AS VARCHAR) AS u,
           json_extract_string(props, '$.k') AS k,
           CAST((event_id * 37) % 181 - 90 AS VARCHAR) AS lat,
           CAST((event_id * 53) % 361 - 180 AS VARCHAR) AS lon,
           CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS secs
    FROM events
),
states AS (
    SELECT *, 0 AS position, 'sound' AS kind FROM parts WHERE event_id % 53 <> 9
    UNION ALL
    SELECT *, 1 AS position,
           CASE event_id % 8 WHEN 0 THEN 'short' WHEN 1 THEN 'zero_time' WHEN 2 THEN 'no_longitude'
                WHEN 3 THEN 'no_address' WHEN 4 THEN 'blank' WHEN 5 THEN 'text' WHEN 6 THEN 'null'
                ELSE 'bare' END AS kind
    FROM parts WHERE event_id % 53 <> 9
),
usable AS (
    SELECT *, kind IN ('sound', 'zero_time', 'blank', 'bare') AS kept FROM states
)
"""


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = spark.sql(
        """
        SELECT event_id, event_type,
               lpad(lower(hex(user_id)), 6, '0') AS icao24,
               CAST(user_id AS STRING) AS u,
               get_json_object(props, '$.k') AS k,
               CAST((event_id * 37) % 181 - 90 AS STRING) AS lat,
               CAST((event_id * 53) % 361 - 180 AS STRING) AS lon,
               CAST(unix_seconds(CAST(ts AS TIMESTAMP)) AS STRING) AS t,
               CAST(unix_seconds(CAST(ts AS TIMESTAMP)) + 1 AS STRING) AS t1
        FROM {events}
        """,
        events=arrivals(spark, sf_dir),
    )
    return parts.selectExpr("event_id", f"{_SNAPSHOT} AS value")


# --------------------------------------------------------------------------
# samples, requests, log lines
# --------------------------------------------------------------------------

#: Share of the counter reached by each bucket bound, in percent.
_BUCKET_SHARE = (5, 15, 30, 45, 60, 75, 85, 95, 100)
_BUCKET_LE = ("0.05", "0.1", "0.25", "0.5", "1.0", "2.5", "5.0", "10.0", "+Inf")

#: A counter that grows with the event number and restarts every 5,000 events.
COUNTER = "CAST(event_id % 5000 AS DOUBLE)"


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three gauges/counters per event, labelled by route, status and pod.

    ``scrape`` tells which samples were taken together: the place of their event in the files, since
    events of one time and series, and whole events, may repeat.
    """
    place = F.struct("_metadata.file_path", "_metadata.row_index").alias("scrape")
    return spark.sql(
        f"""
        SELECT ts, scrape, s.metric, map('route', event_type,
                   'status_code', CASE WHEN user_id % 10 = 0 THEN '500' ELSE '200' END,
                   'pod', 'pod-' || CAST(user_id % 4 AS STRING)) AS labels, s.value
        FROM {{events}}
        LATERAL VIEW inline(array(
            named_struct('metric', 'http_requests_total', 'value', {COUNTER}),
            named_struct('metric', 'freshness_seconds', 'value', value),
            named_struct('metric', 'memory_bytes', 'value', value * 1000 + 1))) s
        """,
        events=arrivals(spark, sf_dir, place),
    )


def bucket_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency bucket counters: nine cumulative bounds per event."""
    bounds = ", ".join(
        f"named_struct('le', '{le}', 'value', floor({COUNTER} * {share} / 100) * 1e0)"
        for le, share in zip(_BUCKET_LE, _BUCKET_SHARE, strict=True)
    )
    return spark.sql(
        f"""
        SELECT ts, 'request_duration_seconds_bucket' AS metric,
               map('le', b.le, 'route', event_type) AS labels, CAST(b.value AS DOUBLE) AS value
        FROM {{events}} LATERAL VIEW inline(array({bounds})) b
        """,
        events=arrivals(spark, sf_dir),
    )


BUCKETS_SQL = "bounds(i, le, share) AS (VALUES " + ", ".join(
    f"({i}, '{le}', {share})"
    for i, (le, share) in enumerate(zip(_BUCKET_LE, _BUCKET_SHARE, strict=True))
) + ")"


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "CASE WHEN user_id % 5 = 0 THEN 'POST' ELSE 'GET' END AS method",
        "event_type AS route",
        "CASE WHEN user_id % 10 = 0 THEN '500' ELSE '200' END AS status_code",
        "value / 5e1 AS duration_s",
    )


#: A log line with one secret of each kind.
LOG_LINE = """
    'user ' || CAST(user_id AS STRING) || ' password = ' || event_type ||
    CASE event_id % 3 WHEN 0 THEN ', Authorization:abc' || CAST(event_id AS STRING)
                      WHEN 1 THEN '; bearer ' || event_type || '.x'
                      ELSE '&Access_Token=' || CAST(event_id AS STRING) || '&next=1' END ||
    ' done'
"""


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{LOG_LINE} AS line", "event_type", "user_id"
    )
