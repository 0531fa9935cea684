"""Display values of one aircraft row: altitude bands, units, ages, labels, GeoJSON."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from airlane.functions import times
from airlane.functions.payload import finite

# --- fixed values: altitude bands (upper bound in feet, key, colour) --------
FEET_PER_METRE = 3.28084
ALTITUDE_BANDS = (
    (500, "ft-0", "#ff7816"),
    (1_000, "ft-500", "#ff8b18"),
    (2_000, "ft-1000", "#ffa51b"),
    (4_000, "ft-2000", "#ffc21b"),
    (6_000, "ft-4000", "#e3d812"),
    (8_000, "ft-6000", "#b7dc08"),
    (10_000, "ft-8000", "#52d211"),
    (20_000, "ft-10000", "#1fc84a"),
    (30_000, "ft-20000", "#28c7d7"),
    (40_000, "ft-30000", "#3d6dff"),
    (None, "ft-40000", "#d313e7"),
)
GROUND_BAND = "ft-0"
UNKNOWN_BAND, UNKNOWN_COLOR = "unknown", "#ffffff"
UNKNOWN_COUNTRY = "Bilinmiyor"
KMH_PER_MPS = 3.6


def altitude_bucket(on_ground: Column, altitude_m: Column) -> Column:
    feet = altitude_m * F.lit(FEET_PER_METRE)
    band = F.when(F.coalesce(on_ground, F.lit(False)), GROUND_BAND).when(
        ~finite(altitude_m), UNKNOWN_BAND
    )
    for upper, key, _ in ALTITUDE_BANDS:
        band = band.otherwise(key) if upper is None else band.when(feet < upper, key)
    return band


def bucket_color(bucket: Column) -> Column:
    """Colour of a band from a constant map: twelve entries, nothing to join."""
    pairs = chain.from_iterable((F.lit(key), F.lit(color)) for _, key, color in ALTITUDE_BANDS)
    return F.coalesce(F.try_element_at(F.create_map(*pairs), bucket), F.lit(UNKNOWN_COLOR))


def altitude_color(on_ground: Column, altitude_m: Column) -> Column:
    return bucket_color(altitude_bucket(on_ground, altitude_m))


def speed_kmh(mps: Column) -> Column:
    return mps * F.lit(KMH_PER_MPS)


def flight_state(on_ground: Column) -> Column:
    return F.when(on_ground, "ground").when(~on_ground, "air").otherwise("unknown")


def relative_age(observed_at: Column, as_of) -> Column:
    """Struct ``(value, unit)``: whole seconds, then minutes, then hours; null time gives nulls."""
    millis = times.to_millis(times.as_of_column(as_of)) - times.to_millis(observed_at)
    # Halves round up, as the feed's own clock rounding does.
    age = F.greatest(F.lit(0), F.floor(millis / 1000 + 0.5)).cast("bigint")
    value = (
        F.when(age < 60, age)
        .when(age < 3600, F.floor(age / 60))
        .otherwise(F.floor(age / 3600))
    )
    unit = F.when(age < 60, "s").when(age < 3600, "min").when(age.isNotNull(), "h")
    known = observed_at.isNotNull()
    return F.struct(
        F.when(known, value).cast("bigint").alias("value"), F.when(known, unit).alias("unit")
    )


def or_text(text: Column, fallback) -> Column:
    """Text, or the fallback when it is null or empty."""
    fallback = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.coalesce(F.nullif(text, F.lit("")), fallback)


def geojson_point() -> Column:
    """GeoJSON ``Feature`` text of an aircraft row, nulls kept."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            F.lit("Point").alias("type"),
            F.array("longitude", "latitude").alias("coordinates"),
        ).alias("geometry"),
        F.struct(
            F.col("icao24"),
            or_text(F.col("callsign"), F.col("icao24")).alias("callsign"),
            or_text(F.col("origin_country"), UNKNOWN_COUNTRY).alias("origin_country"),
            altitude_bucket(F.col("on_ground"), F.col("baro_altitude_m")).alias("altitude_bucket"),
            F.col("baro_altitude_m").alias("altitude_m"),
            F.col("true_track_deg").alias("heading_deg"),
            F.col("velocity_mps"),
            times.iso_utc(F.col("observed_at")).alias("observed_at"),
            F.col("on_ground"),
        ).alias("properties"),
    )
    return F.to_json(feature, {"ignoreNullFields": "false"})
