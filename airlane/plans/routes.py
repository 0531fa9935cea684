"""Queries over the routes of every aircraft in the positions view."""

from __future__ import annotations

from pyspark.sql import functions as F

from airlane.operators import routes
from airlane.plans import views
from airlane.plans.reads import COLOR_SQL
from airlane.plans.registry import query

_COLUMNS = ["_id", "icao24", "latitude", "longitude", "baro_altitude_m", "on_ground",
            "observed_at", "kafka_offset"]

def _points_sql(limit):
    return f"""
WITH {views.POSITIONS_SQL},
newest AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY icao24
                   ORDER BY observed_at DESC, kafka_offset DESC) AS rn FROM positions)
    WHERE rn <= {limit}),
points AS (
    SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY observed_at, kafka_offset) AS seq,
           count(*) OVER (PARTITION BY icao24) AS n,
           lag(longitude) OVER w AS from_longitude, lag(latitude) OVER w AS from_latitude
    FROM newest WHERE latitude IS NOT NULL AND longitude IS NOT NULL
    WINDOW w AS (PARTITION BY icao24 ORDER BY observed_at, kafka_offset))
"""


_POINTS_SQL = _points_sql(120)


def points(spark, sf_dir):
    return routes.route_points(views.positions(spark, sf_dir))


@query(
    f"""{_points_sql(20)}
SELECT {', '.join(_COLUMNS)}, CAST(seq AS INT) AS seq FROM points"""
)
def route_points_20(spark, sf_dir):
    """Valid positions among the newest 20 rows, a limit that most aircraft exceed."""
    return routes.route_points(views.positions(spark, sf_dir), 20).select(*_COLUMNS, "seq")


@query(
    f"""{_POINTS_SQL}
SELECT {', '.join(_COLUMNS)}, CAST(seq AS INT) AS seq FROM points"""
)
def route_points(spark, sf_dir):
    """Valid positions among the newest 120 rows of every aircraft, oldest first."""
    return points(spark, sf_dir).select(*_COLUMNS, "seq")


@query(
    f"""{_POINTS_SQL}
SELECT icao24, CAST(seq - 1 AS INT) AS segment, from_longitude, from_latitude,
       longitude AS to_longitude, latitude AS to_latitude, {COLOR_SQL} AS color
FROM points WHERE seq > 1"""
)
def route_segments(spark, sf_dir):
    """Consecutive point pairs in the later point's colour."""
    return routes.route_segments(points(spark, sf_dir))


@query(
    f"""{_POINTS_SQL}
SELECT icao24, CAST(seq AS INT) AS seq,
       CAST(seq - 1 AS DOUBLE) / CAST(n - 1 AS DOUBLE) AS progress, {COLOR_SQL} AS color
FROM points WHERE n > 1"""
)
def route_gradient(spark, sf_dir):
    """Gradient stops along every route."""
    return routes.route_gradient(points(spark, sf_dir))


@query(
    f"""{_POINTS_SQL}
SELECT icao24, CASE WHEN seq = 1 THEN 'start' ELSE 'end' END AS role, longitude, latitude,
       {COLOR_SQL} AS color
FROM points WHERE n > 1 AND (seq = 1 OR seq = n)"""
)
def route_endpoints(spark, sf_dir):
    """Start and end of every route."""
    return routes.route_endpoints(points(spark, sf_dir))


@query(
    f"""{_POINTS_SQL}
SELECT icao24, count(*) AS points, string_agg(CAST(CAST(round(longitude * 100) AS BIGINT) AS VARCHAR)
       || ' ' || CAST(CAST(round(latitude * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY seq) AS hundredths
FROM points GROUP BY icao24 HAVING count(*) > 1"""
)
def route_linestring(spark, sf_dir):
    """One line per route, all its coordinates read back from the GeoJSON text in order."""
    lines = routes.route_linestring(points(spark, sf_dir))
    coordinates = F.from_json(
        F.get_json_object("geojson", "$.geometry.coordinates"), "array<array<double>>"
    )
    hundredths = lambda x: F.round(x * 100).cast("long").cast("string")
    pairs = F.transform(coordinates, lambda c: F.concat_ws(" ", hundredths(c[0]), hundredths(c[1])))
    return lines.select("icao24", "points", F.array_join(pairs, ",").alias("hundredths"))


@query(
    f"""{_POINTS_SQL}
SELECT icao24, count(*) AS points,
       CASE WHEN count(*) > 1 THEN 'ready' ELSE 'empty' END AS status
FROM points GROUP BY icao24"""
)
def route_status(spark, sf_dir):
    """Whether every aircraft's route can be drawn."""
    return routes.route_status(points(spark, sf_dir))
