"""Routes: the last points of every aircraft as segments, gradients, endpoints and lines.

A route holds at most ``ROUTE_POINTS`` points per aircraft, taken with a window-group
limit before any shuffle, so the per-aircraft windows and lists below are bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlane.functions import display
from airlane.operators.live import has_valid_position, history_top_n
from airlane.schemas import ROUTE_POINTS

_FORWARD = ["observed_at", "kafka_offset", "_id"]


def _route() -> Window:
    return Window.partitionBy("icao24").orderBy(*_FORWARD)


def _whole_route() -> Window:
    return Window.partitionBy("icao24")


def _color():
    return display.altitude_color(F.col("on_ground"), F.col("baro_altitude_m"))


def route_points(history: DataFrame, limit: int = ROUTE_POINTS) -> DataFrame:
    """Valid positions among the newest ``limit`` rows, oldest first in ``seq``."""
    newest = history_top_n(history, limit).where(has_valid_position())
    return newest.drop("rank").withColumn("seq", F.row_number().over(_route()))


def route_segments(points: DataFrame) -> DataFrame:
    """Consecutive point pairs, coloured by the later point; none below two points."""
    start = F.lag(F.struct("longitude", "latitude")).over(_route())
    return points.withColumn("_start", start).where(F.col("_start").isNotNull()).select(
        "icao24",
        (F.col("seq") - 1).alias("segment"),
        F.col("_start.longitude").alias("from_longitude"),
        F.col("_start.latitude").alias("from_latitude"),
        F.col("longitude").alias("to_longitude"),
        F.col("latitude").alias("to_latitude"),
        _color().alias("color"),
    )


def route_gradient(points: DataFrame) -> DataFrame:
    """Gradient stops: progress from 0 to 1 along the route and the point's colour."""
    total = F.count("*").over(_whole_route())
    return points.withColumn("_n", total).where(F.col("_n") > 1).select(
        "icao24",
        "seq",
        ((F.col("seq") - 1) / (F.col("_n") - 1)).alias("progress"),
        _color().alias("color"),
    )


def route_endpoints(points: DataFrame) -> DataFrame:
    """Start and end of routes of two points or more."""
    total = F.count("*").over(_whole_route())
    role = F.when(F.col("seq") == 1, "start").when(F.col("seq") == F.col("_n"), "end")
    return (
        points.withColumn("_n", total).where(F.col("_n") > 1).withColumn("role", role)
        .where(F.col("role").isNotNull() & has_valid_position())
        .select("icao24", "role", "longitude", "latitude", _color().alias("color"))
    )


def route_linestring(points: DataFrame) -> DataFrame:
    """One GeoJSON LineString per route of two points or more."""
    point = F.struct(*_FORWARD, "longitude", "latitude")
    ordered = points.where(has_valid_position()).groupBy("icao24").agg(
        F.sort_array(F.collect_list(point)).alias("_points")
    )
    line = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            F.lit("LineString").alias("type"),
            F.transform("_points", lambda p: F.array(p["longitude"], p["latitude"]))
            .alias("coordinates"),
        ).alias("geometry"),
        F.struct().alias("properties"),
    )
    return ordered.where(F.size("_points") > 1).select(
        "icao24", F.size("_points").cast("bigint").alias("points"),
        F.to_json(line).alias("geojson"),
    )


def route_status(points: DataFrame) -> DataFrame:
    """Point count per aircraft and whether a route can be drawn."""
    n = F.count("*")
    return points.groupBy("icao24").agg(
        n.alias("points"), F.when(n > 1, "ready").otherwise("empty").alias("status")
    )


def altitude_population(rows: DataFrame) -> DataFrame:
    """Aircraft per altitude band, with the band's colour."""
    bucket = display.altitude_bucket(F.col("on_ground"), F.col("baro_altitude_m"))
    counted = rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("aircraft"))
    return counted.withColumn("color", display.bucket_color(F.col("bucket")))


def state_population(rows: DataFrame) -> DataFrame:
    """Aircraft per flight state."""
    state = display.flight_state(F.col("on_ground"))
    return rows.groupBy(state.alias("flight_state")).agg(F.count("*").alias("aircraft"))
