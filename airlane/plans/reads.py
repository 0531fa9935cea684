"""Queries of the read side over the positions view: live, history, search, freshness."""

from __future__ import annotations

from pyspark.sql import functions as F

from airlane.functions import display
from airlane.operators import latest, live, routes
from airlane.plans import views
from airlane.plans.registry import query
from airlane.plans.state import AS_OF, LIVE_SQL
from airlane.schemas import PUBLIC_COLUMNS

#: The window of the checks: the provided events are minutes apart, not seconds.
WINDOW_MINUTES = 720

_SINCE = f"{AS_OF} - INTERVAL {WINDOW_MINUTES} MINUTE"
_WITH_LIVE = f"WITH {views.POSITIONS_SQL}, {LIVE_SQL}"
_PUBLIC = ", ".join(PUBLIC_COLUMNS)
_PUBLIC_LIVE = _PUBLIC.replace("_id", "icao24 AS _id", 1)


def live_rows(spark, sf_dir, columns):
    """Whole live table of the positions view."""
    return latest.live(views.positions(spark, sf_dir), columns)


def live_window(spark, sf_dir, columns, window_minutes=WINDOW_MINUTES):
    """Live rows within the window, and the reference time.

    The newest row of an aircraft is inside the window exactly when it has any row there,
    so history is cut to the window before the aggregation. On stored tables the cut reaches
    the file scan; in this view the time is an expression, so it is a filter above the scan.
    """
    rows = views.positions(spark, sf_dir)
    as_of = views.newest(rows)
    return latest.live(live.recent(rows, as_of, window_minutes), columns), as_of


@query(
    f"""
{_WITH_LIVE}
SELECT count(*) AS total_aircraft, count(*) FILTER (WHERE NOT on_ground) AS airborne,
       count(*) FILTER (WHERE on_ground) AS on_ground,
       count(*) FILTER (WHERE on_ground IS NULL) AS unknown_ground_state,
       max(observed_at) AS last_observed_at
FROM live WHERE observed_at >= {_SINCE}
"""
)
def live_statistics(spark, sf_dir):
    """Live aircraft by ground state."""
    rows, as_of = live_window(spark, sf_dir, ["observed_at", "on_ground"])
    return live.live_statistics(rows, as_of, WINDOW_MINUTES)


@query(
    f"""
{_WITH_LIVE}
SELECT {_PUBLIC_LIVE} FROM live WHERE observed_at >= {_SINCE}
ORDER BY observed_at DESC, icao24 LIMIT 200
"""
)
def live_list(spark, sf_dir):
    """Newest live aircraft, at most the default page."""
    rows, as_of = live_window(spark, sf_dir, PUBLIC_COLUMNS)
    return live.live_page(rows, as_of, window_minutes=WINDOW_MINUTES).items


@query(
    f"""
{_WITH_LIVE}
SELECT {_PUBLIC_LIVE} FROM live WHERE observed_at >= {_SINCE}
ORDER BY observed_at DESC, icao24 LIMIT 5
"""
)
def live_list_page5(spark, sf_dir):
    """Newest live aircraft, a page short enough to cut."""
    rows, as_of = live_window(spark, sf_dir, PUBLIC_COLUMNS)
    return live.live_page(rows, as_of, 5, WINDOW_MINUTES).items


@query(
    f"""
{_WITH_LIVE}
SELECT CAST(least(count(*), 50) AS BIGINT) AS count,
       CAST({WINDOW_MINUTES} AS INT) AS window_minutes, count(*) > 50 AS truncated
FROM live WHERE observed_at >= {_SINCE}
"""
)
def live_list_envelope(spark, sf_dir):
    """Envelope of a page of fifty."""
    rows, as_of = live_window(spark, sf_dir, ["observed_at"])
    return live.live_page(rows, as_of, 50, WINDOW_MINUTES).envelope


@query(f"{_WITH_LIVE} SELECT {_PUBLIC_LIVE} FROM live WHERE icao24 = '00002a'")
def aircraft_detail(spark, sf_dir):
    """Live row of one aircraft, from its own history alone."""
    rows = views.positions(spark, sf_dir).where(F.col("icao24") == live.check_icao24("00002A"))
    return live.aircraft(latest.live(rows, PUBLIC_COLUMNS), "00002A")


@query(
    f"""
WITH {views.POSITIONS_SQL}
SELECT {_PUBLIC} FROM positions WHERE icao24 = '00002a'
ORDER BY observed_at DESC, kafka_offset DESC LIMIT 100
"""
)
def aircraft_history(spark, sf_dir):
    """Newest history of one aircraft."""
    return live.aircraft_history(views.positions(spark, sf_dir), "00002A")


@query(
    f"""
WITH {views.POSITIONS_SQL}
SELECT {_PUBLIC} FROM positions
WHERE icao24 = (SELECT min(icao24) FROM positions)
ORDER BY observed_at DESC, kafka_offset DESC LIMIT 10
"""
)
def aircraft_history_page10(spark, sf_dir):
    """Newest history of the first aircraft, a page short enough to cut."""
    rows = views.positions(spark, sf_dir)
    first = rows.agg(F.min("icao24")).first()[0]
    return live.aircraft_history(rows, first, 10)


def _top_sql(limit):
    return f"""
WITH {views.POSITIONS_SQL}
SELECT {_PUBLIC}, rank FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY icao24
              ORDER BY observed_at DESC, kafka_offset DESC) AS INT) AS rank FROM positions)
WHERE rank <= {limit}
"""


@query(_top_sql(100))
def history_topn_all(spark, sf_dir):
    """Newest history of every aircraft."""
    return live.history_top_n(views.positions(spark, sf_dir))


@query(_top_sql(20))
def history_top20_all(spark, sf_dir):
    """Newest history of every aircraft, a limit that most exceed."""
    return live.history_top_n(views.positions(spark, sf_dir), 20)


@query(
    f"""
WITH {views.POSITIONS_SQL}
SELECT {_PUBLIC} FROM (SELECT * REPLACE (CAST(NULL AS DOUBLE) AS velocity_mps) FROM positions)
"""
)
def public_projection(spark, sf_dir):
    """Public columns of every row, a missing column as null."""
    return live.public(views.positions(spark, sf_dir).drop("velocity_mps"))


@query(
    f"""
{_WITH_LIVE}
SELECT count(*) AS total, count(*) FILTER (WHERE observed_at >= {_SINCE}) AS live,
       count(*) FILTER (WHERE observed_at < {_SINCE}) AS hidden_stale
FROM live
"""
)
def stale_hidden_count(spark, sf_dir):
    """Aircraft hidden because their last observation is too old."""
    rows = live_rows(spark, sf_dir, ["observed_at"])
    return live.stale_count(rows, views.newest(views.positions(spark, sf_dir)), WINDOW_MINUTES)


@query(
    f"""
{_WITH_LIVE}
SELECT icao24, callsign, origin_country, observed_at FROM live
WHERE observed_at >= {_SINCE} AND (contains(icao24, 'err') OR contains(lower(callsign), 'err')
   OR contains(lower(origin_country), 'err'))
"""
)
def search_aircraft(spark, sf_dir):
    """Live aircraft whose address, callsign or country contains a text."""
    columns = ["callsign", "origin_country", "observed_at"]
    rows, _ = live_window(spark, sf_dir, columns)
    return live.search(rows, " ERR ").select("icao24", *columns)


@query(
    f"""
WITH {views.POSITIONS_SQL}
SELECT _id, latitude, longitude FROM positions
WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  AND isfinite(latitude) AND isfinite(longitude)
"""
)
def valid_position(spark, sf_dir):
    """Rows with finite coordinates."""
    rows = views.positions(spark, sf_dir).where(live.has_valid_position())
    return rows.select("_id", "latitude", "longitude")


_BUCKET_SQL = """
    CASE WHEN on_ground THEN 'ft-0'
         WHEN baro_altitude_m IS NULL OR NOT isfinite(baro_altitude_m) THEN 'unknown'
         WHEN baro_altitude_m * 3.28084e0 < 500 THEN 'ft-0'
         WHEN baro_altitude_m * 3.28084e0 < 1000 THEN 'ft-500'
         WHEN baro_altitude_m * 3.28084e0 < 2000 THEN 'ft-1000'
         WHEN baro_altitude_m * 3.28084e0 < 4000 THEN 'ft-2000'
         WHEN baro_altitude_m * 3.28084e0 < 6000 THEN 'ft-4000'
         WHEN baro_altitude_m * 3.28084e0 < 8000 THEN 'ft-6000'
         WHEN baro_altitude_m * 3.28084e0 < 10000 THEN 'ft-8000'
         WHEN baro_altitude_m * 3.28084e0 < 20000 THEN 'ft-10000'
         WHEN baro_altitude_m * 3.28084e0 < 30000 THEN 'ft-20000'
         WHEN baro_altitude_m * 3.28084e0 < 40000 THEN 'ft-30000'
         ELSE 'ft-40000' END"""

COLOR_SQL = f"""
    CASE {_BUCKET_SQL} WHEN 'ft-0' THEN '#ff7816' WHEN 'ft-500' THEN '#ff8b18'
         WHEN 'ft-1000' THEN '#ffa51b' WHEN 'ft-2000' THEN '#ffc21b' WHEN 'ft-4000' THEN '#e3d812'
         WHEN 'ft-6000' THEN '#b7dc08' WHEN 'ft-8000' THEN '#52d211' WHEN 'ft-10000' THEN '#1fc84a'
         WHEN 'ft-20000' THEN '#28c7d7' WHEN 'ft-30000' THEN '#3d6dff'
         WHEN 'ft-40000' THEN '#d313e7' ELSE '#ffffff' END"""


@query(
    f"""
{_WITH_LIVE}
SELECT {_BUCKET_SQL} AS bucket, count(*) AS aircraft, any_value({COLOR_SQL}) AS color
FROM live GROUP BY 1
"""
)
def altitude_buckets(spark, sf_dir):
    """Live aircraft per altitude band."""
    return routes.altitude_population(
        live_rows(spark, sf_dir, ["on_ground", "baro_altitude_m"])
    )


@query(f"WITH {views.POSITIONS_SQL} SELECT _id, {COLOR_SQL} AS color FROM positions")
def altitude_colors(spark, sf_dir):
    """Altitude colour of every row."""
    color = display.altitude_color(F.col("on_ground"), F.col("baro_altitude_m"))
    return views.positions(spark, sf_dir).select("_id", color.alias("color"))


@query(
    f"""
{_WITH_LIVE}
SELECT CASE WHEN on_ground THEN 'ground' WHEN NOT on_ground THEN 'air' ELSE 'unknown' END
           AS flight_state, count(*) AS aircraft
FROM live GROUP BY 1
"""
)
def flight_state(spark, sf_dir):
    """Live aircraft per flight state."""
    return routes.state_population(live_rows(spark, sf_dir, ["on_ground"]))


@query(
    f"""
WITH {views.POSITIONS_SQL}
SELECT _id, velocity_mps * 3.6e0 AS speed_kmh, baro_altitude_m AS altitude_m,
       true_track_deg AS heading_deg
FROM positions
"""
)
def unit_conversion(spark, sf_dir):
    """Display units of every row; nulls stay null."""
    return views.positions(spark, sf_dir).select(
        "_id",
        display.speed_kmh(F.col("velocity_mps")).alias("speed_kmh"),
        F.col("baro_altitude_m").alias("altitude_m"),
        F.col("true_track_deg").alias("heading_deg"),
    )


@query(
    f"""
WITH {views.POSITIONS_SQL},
aged AS (
    SELECT _id, greatest(0, CAST(floor(
        (epoch_ms({AS_OF}) - epoch_ms(observed_at)) / 1e3 + 0.5e0) AS BIGINT)) AS s
    FROM positions)
SELECT _id, CASE WHEN s < 60 THEN s WHEN s < 3600 THEN s // 60 ELSE s // 3600 END AS value,
       CASE WHEN s < 60 THEN 's' WHEN s < 3600 THEN 'min' ELSE 'h' END AS unit
FROM aged
"""
)
def relative_age(spark, sf_dir):
    """Age of every row as value and unit."""
    rows = views.positions(spark, sf_dir)
    age = display.relative_age(F.col("observed_at"), views.newest(rows))
    return rows.select("_id", age.alias("age")).select("_id", "age.*")


@query(
    f"""
{_WITH_LIVE},
newest AS (SELECT max(ingested_at) AS last_ingested_at FROM live),
aged AS (
    SELECT last_ingested_at, greatest(0, CAST(trunc(epoch(
        {AS_OF} + INTERVAL 4 MINUTE - last_ingested_at)) AS BIGINT)) AS age_seconds
    FROM newest)
SELECT last_ingested_at, age_seconds,
       CASE WHEN age_seconds <= 1200 THEN 'fresh' ELSE 'stale' END AS status,
       CASE WHEN age_seconds >= 300 THEN 'critical' WHEN age_seconds >= 180 THEN 'warning'
            ELSE 'ok' END AS severity
FROM aged
"""
)
def data_freshness(spark, sf_dir):
    """Age and status of the newest ingestion, four minutes after the newest observation."""
    rows = views.positions(spark, sf_dir)
    as_of = views.newest(rows).scalar() + F.expr("INTERVAL 4 MINUTE")
    return live.data_freshness(latest.live(rows, ["ingested_at"]), as_of)


@query(
    f"""
WITH {views.POSITIONS_SQL}
SELECT _id, latitude, longitude, coalesce(nullif(callsign, ''), icao24) AS callsign,
       coalesce(nullif(origin_country, ''), 'Bilinmiyor') AS origin_country,
       {_BUCKET_SQL} AS altitude_bucket, on_ground,
       strftime(observed_at, '%Y-%m-%dT%H:%M:%S.%g') || '+00:00' AS observed_at,
       CAST(9 AS INT) AS properties
FROM positions WHERE longitude IS NOT NULL
"""
)
def geojson_points(spark, sf_dir):
    """GeoJSON points of every valid row, read back member by member."""
    rows = views.positions(spark, sf_dir).where(live.has_valid_position())
    text = rows.select("_id", display.geojson_point().alias("geojson"))
    at = lambda path: F.get_json_object("geojson", path)
    return text.select(
        "_id",
        at("$.geometry.coordinates[1]").cast("double").alias("latitude"),
        at("$.geometry.coordinates[0]").cast("double").alias("longitude"),
        at("$.properties.callsign").alias("callsign"),
        at("$.properties.origin_country").alias("origin_country"),
        at("$.properties.altitude_bucket").alias("altitude_bucket"),
        at("$.properties.on_ground").cast("boolean").alias("on_ground"),
        at("$.properties.observed_at").alias("observed_at"),
        F.size(F.json_object_keys(at("$.properties"))).alias("properties"),
    )
