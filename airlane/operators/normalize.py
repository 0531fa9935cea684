"""Positional states to named position events, and events to keyed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlane.functions import payload, times
from airlane.schemas import EVENT_SCHEMA, SCHEMA_VERSION
from airlane.sources.snapshots import element

# --- fixed values: positions inside a state, area box, source name ---------
MIN_STATE_LENGTH = 17
STATE_INDEX = {
    "icao24": 0,
    "callsign": 1,
    "origin_country": 2,
    "time_position": 3,
    "last_contact": 4,
    "longitude": 5,
    "latitude": 6,
    "baro_altitude_m": 7,
    "on_ground": 8,
    "velocity_mps": 9,
    "true_track_deg": 10,
    "vertical_rate_mps": 11,
    "geo_altitude_m": 13,
    "squawk": 14,
    "spi": 15,
    "position_source": 16,
    "category": 17,
}
#: (south, west, north, east) in degrees; ``global`` means no filter.
AREAS = {"turkey": (35.0, 25.0, 43.5, 46.0), "global": None}
SOURCE_NAME = "opensky"


def _number(name: str, kind: str = "double") -> Column:
    value = element(STATE_INDEX[name])
    return payload.number(value, F.schema_of_variant(value)).cast(kind)


def _flag(name: str) -> Column:
    index = STATE_INDEX[name]
    return F.when(payload.is_boolean(element(index)), element(index, "boolean"))


def _text(name: str) -> Column:
    return element(STATE_INDEX[name], "string")


def _present(name: str) -> Column:
    value = element(STATE_INDEX[name])
    return value.isNotNull() & ~F.is_variant_null(value)


def is_usable() -> Column:
    """Long enough, with an address and both coordinates."""
    long_enough = element(MIN_STATE_LENGTH - 1).isNotNull()
    address = payload.is_truthy(element(STATE_INDEX["icao24"]))
    return long_enough & address & _present("longitude") & _present("latitude")


def observation_time(position: Column, contact: Column, api_time: Column) -> Column:
    """First of the three epoch seconds that is neither null nor zero (the last as it is)."""
    seconds = F.coalesce(
        F.nullif(position, F.lit(0)), F.nullif(contact, F.lit(0)), api_time
    )
    return times.from_epoch_seconds(seconds)


def stable_uuid(*parts: Column) -> Column:
    """UUID text derived from the parts, so a recomputed task yields the same ids."""
    digest = F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    piece = lambda start, size: F.substr(digest, F.lit(start), F.lit(size))
    return F.concat(
        piece(1, 8), F.lit("-"), piece(9, 4), F.lit("-8"), piece(14, 3),
        F.lit("-8"), piece(18, 3), F.lit("-"), piece(21, 12),
    )


def normalize_states(
    states: DataFrame, as_of=None, event_id: Column | None = None, source: str = SOURCE_NAME
) -> DataFrame:
    """Usable states as typed version-1 events; the rest are left out (see :func:`counts`)."""
    now = times.instant_to_utc(F.current_timestamp()) if as_of is None else (
        times.as_of_column(as_of)
    )
    identity = event_id if event_id is not None else stable_uuid(
        F.col("api_time"), F.col("position"), F.to_json(F.col("state"))
    )
    columns = {
        "schema_version": F.lit(SCHEMA_VERSION),
        "event_id": identity,
        "icao24": F.lower(_text("icao24")),
        "callsign": F.nullif(payload.strip(_text("callsign")), F.lit("")),
        "origin_country": _text("origin_country"),
        "time_position": _number("time_position", "bigint"),
        "observed_at": observation_time(
            _number("time_position"), _number("last_contact"), F.col("api_time").cast("double")
        ),
        "last_contact": _number("last_contact", "bigint"),
        "on_ground": _flag("on_ground"),
        "squawk": _text("squawk"),
        "spi": _flag("spi"),
        "position_source": _number("position_source", "int"),
        "category": _number("category", "int"),
        "api_time": F.col("api_time"),
        "ingested_at": now,
        "source": F.lit(source),
    }
    return states.where(is_usable()).select(
        *(columns.get(f.name, _number(f.name) if f.name in STATE_INDEX else None)
          .cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA)
    )


def skipped_states(states: DataFrame) -> DataFrame:
    """The states that :func:`normalize_states` leaves out."""
    return states.where(~is_usable())


def counts(states: DataFrame) -> DataFrame:
    """One row: records received, queued and skipped."""
    return states.agg(
        F.count("*").alias("api_records"),
        F.count_if(is_usable()).alias("queued"),
        F.count_if(~is_usable()).alias("skipped"),
    )


def in_area(events: DataFrame, area: str) -> DataFrame:
    if area not in AREAS:
        raise ValueError(f"unknown area {area!r}; expected one of {sorted(AREAS)}")
    box = AREAS[area]
    if box is None:
        return events
    return in_box(events, box)


def in_box(events: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Events inside south, west, north, east, borders included."""
    south, west, north, east = box
    return events.where(
        F.col("latitude").between(south, north) & F.col("longitude").between(west, east)
    )


def to_messages(events: DataFrame) -> DataFrame:
    """Events as keyed messages ``(key, value)``; a NaN or infinite number fails the write."""
    def wire(field):
        column = F.col(field.name)
        if field.dataType.typeName() == "timestamp_ntz":
            return times.iso_utc(column).alias(field.name)
        if field.dataType.typeName() == "double":
            bad = F.raise_error(F.lit(f"{field.name} is not a finite number")).cast("double")
            return F.when(
                column.isNull() | payload.finite(column), column
            ).otherwise(bad).alias(field.name)
        return column.alias(field.name)

    fields = [wire(f) for f in events.schema.fields]
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return events.select(
        F.col("icao24").cast("binary").alias("key"), value.cast("binary").alias("value")
    )
