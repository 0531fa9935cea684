"""Message validation: typed event columns plus the first rule that failed.

A message yields exactly one row. ``error_code`` is null for a valid event, otherwise the
first failing rule in the fixed order payload, icao24, latitude, longitude, observed_at,
ingested_at, schema_version, event_id, on_ground.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlane.functions import payload, times
from airlane.schemas import EVENT_SCHEMA, OPTIONAL_FIELDS, SCHEMA_VERSION

# --- fixed values: formats and ranges --------------------------------------
ICAO24_PATTERN = r"^[0-9a-f]{6}\z"
LATITUDE_LIMIT, LONGITUDE_LIMIT = 90.0, 180.0

ERROR_MESSAGES = {
    "payload": "payload is not a UTF-8 JSON object",
    "icao24": "icao24 must be six hexadecimal characters",
    "latitude": "latitude must be a finite number within its range",
    "longitude": "longitude must be a finite number within its range",
    "observed_at": "observed_at must be an ISO-8601 time",
    "ingested_at": "ingested_at must be an ISO-8601 time",
    "schema_version": "schema_version must be 1",
    "event_id": "event_id must be a UUID",
    "on_ground": "on_ground must be true, false or null",
}

def _doc() -> Column:
    return F.col("_doc")



#: Members that rules look at; each is fetched and its JSON type taken once.
_RULED = ("icao24", "latitude", "longitude", "observed_at", "ingested_at", "schema_version",
          "event_id", "on_ground")


def _fetch(names) -> Column:
    """Several members of the document in one pass over it, as VARIANT values."""
    fields = ",".join(f"`{name}` variant" for name in names)
    return F.try_variant_get(_doc(), "$[0]", f"struct<{fields}>")


def _member(name: str, kind: str | None = None) -> Column:
    value = F.col(f"_members.{name}")
    return value if kind is None else F.try_variant_get(value, "$", kind)


def decode(messages: DataFrame) -> DataFrame:
    """Messages plus the parsed document ``_doc``, null when the value is not one JSON object."""
    return payload.with_document(messages, payload.decode_text(F.col("value")))


def _once(rows: DataFrame, keep: list[str], computed: dict[str, Column]) -> DataFrame:
    """``keep`` and the computed columns, with filters on the latter kept above this step.

    Catalyst copies a projected expression into every filter it pushes below the projection;
    it cannot push a filter below a generator. The struct is built by an ordinary projection,
    so the generator itself only unpacks it.
    """
    packed = F.struct(*(column.alias(name) for name, column in computed.items()))
    return rows.select(*keep, packed.alias("_row")).select(*keep, F.inline(F.array("_row")))


def uuid_digits(text: Column) -> Column:
    """A UUID's usual spellings without prefix, braces and hyphens, in lower case."""
    bare = F.replace(F.replace(text, F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit(""))
    return F.lower(F.replace(F.btrim(bare, F.lit("{}")), F.lit("-"), F.lit("")))


def canonical_uuid(digits: Column) -> Column:
    """Hyphenated UUID from its digits; null unless there are 32 hexadecimal ones."""
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    parts = [F.substr(digits, F.lit(start), F.lit(size)) for start, size in cut]
    return F.when(digits.rlike(r"^[0-9a-f]{32}\z"), F.concat_ws("-", *parts))


def _type(name: str) -> Column:
    """JSON type of a ruled member: null when absent, VOID for an explicit null."""
    return F.col(f"_{name}_type")


def _inspect(parsed: DataFrame) -> DataFrame:
    """Ruled members and their typed readings, step by step so that none is computed twice.

    Each member is a copy of all names of its document, so none is carried past its readings.
    """
    text = {n: F.when(_type(n) == "STRING", _member(n, "string"))
            for n in ("observed_at", "ingested_at", "event_id")}
    return (
        parsed.withColumn("_members", _fetch(_RULED))
        .withColumns({f"_{n}_type": F.schema_of_variant(_member(n)) for n in _RULED})
        .withColumns(
            {
                # A whole JSON number counts as its digits; nothing else is text.
                "_address": F.when(
                    _type("icao24").isin("STRING", "BIGINT"), F.lower(_member("icao24", "string"))
                ),
                "_lat": payload.number(_member("latitude"), _type("latitude")),
                "_lon": payload.number(_member("longitude"), _type("longitude")),
                "_observed_text": text["observed_at"],
                "_ingested_text": text["ingested_at"],
                "_digits": uuid_digits(text["event_id"]),
                "_version": payload.number(_member("schema_version"), _type("schema_version")),
                "_true_version": (_type("schema_version") == "BOOLEAN")
                & _member("schema_version", "boolean"),
                "_ground": F.when(
                    _type("on_ground") == "BOOLEAN", _member("on_ground", "boolean")
                ),
                "_ground_number": payload.number(_member("on_ground"), _type("on_ground")),
            }
        )
        .withColumns(
            {
                "_observed": times.parse_iso(F.col("_observed_text")),
                "_ingested": times.parse_iso(F.col("_ingested_text")),
                "_uuid": canonical_uuid(F.col("_digits")),
            }
        )
        .drop("_members")
    )


def _absent(name: str) -> Column:
    return _type(name).isNull()


def error_code() -> Column:
    """First failing rule over the inspected columns, or null."""
    version, ground = "schema_version", "on_ground"
    rules = [
        ("payload", _doc().isNotNull()),
        ("icao24", F.col("_address").rlike(ICAO24_PATTERN)),
        ("latitude", F.col("_lat").between(-LATITUDE_LIMIT, LATITUDE_LIMIT)),
        ("longitude", F.col("_lon").between(-LONGITUDE_LIMIT, LONGITUDE_LIMIT)),
        ("observed_at", F.col("_observed").isNotNull()),
        (
            "ingested_at",
            _absent("ingested_at") | (_type("ingested_at") == "VOID")
            | F.col("_ingested").isNotNull(),
        ),
        # True and 1 both equal the supported version; an explicit null does not.
        (
            "schema_version",
            _absent(version) | (F.col("_version") == SCHEMA_VERSION)
            | F.col("_true_version"),
        ),
        ("event_id", _absent("event_id") | F.col("_uuid").isNotNull()),
        # 0 and 1 compare equal to booleans and pass as unknown state.
        (
            "on_ground",
            _absent(ground) | _type(ground).isin("BOOLEAN", "VOID")
            | F.col("_ground_number").isin(0.0, 1.0),
        ),
    ]
    code = F
    for name, passes in rules:
        code = code.when(~F.coalesce(passes, F.lit(False)), name)
    return code


def _typed(field: T.StructField) -> Column:
    """A pass-through field in its column type; a value of another JSON type becomes null."""
    value = _member(field.name)
    if isinstance(field.dataType, T.StringType):
        return _member(field.name, "string")
    if isinstance(field.dataType, T.BooleanType):
        return F.when(payload.is_boolean(value), _member(field.name, "boolean"))
    return payload.number(value, F.schema_of_variant(value)).cast(field.dataType)


def _lost(name: str) -> Column:
    """Whether an optional member holds a value that its typed column does not."""
    kind, value = EVENT_SCHEMA[name].dataType, F.col(name)
    differs = value.isNull()
    if isinstance(kind, T.IntegralType):
        differs = differs | (_member(name, "double") != value)
    # The JSON type, the dearest to tell, is asked last and of few.
    return _member(name).isNotNull() & differs & ~payload.is_json_null(_member(name))


def _other_members(mistyped) -> Column:
    """JSON text of the members outside the typed event, and of those whose typed column lost them.

    A map, null when there are none.
    """
    members = F.try_variant_get(_doc(), "$[0]", "map<string,variant>")
    known = [f.name for f in EVENT_SCHEMA]
    other = F.transform_values(
        F.map_filter(members, lambda k, _: ~k.isin(*known)), lambda _, v: F.to_json(v)
    )
    originals = F.array_compact(F.array(*(
        F.when(_lost(n), F.struct(F.lit(n).alias("name"), F.to_json(_member(n)).alias("json")))
        for n in mistyped
    )))
    # Most documents have lost nothing: the array of originals is built for the others alone.
    lost = reduce(or_, (F.coalesce(_lost(n), F.lit(False)) for n in mistyped))
    every = F.when(lost, F.map_concat(other, F.map_from_entries(originals))).otherwise(other)
    return F.when(F.size(every) > 0, every)


def validate(messages: DataFrame, as_of) -> DataFrame:
    """Classify messages.

    Output: the message columns (log coordinates renamed ``kafka_*``), every typed event
    field, ``present`` (which optional fields the document carries), ``extra`` (all other
    members, and the original of a typed member whose value is of another JSON type) and
    ``error_code``. ``as_of`` stands in for a missing ``ingested_at``.
    """
    optional = [name for name in OPTIONAL_FIELDS if name not in _RULED]
    odd = ["schema_version", "on_ground"]  # a boolean version and a numeric ground state pass
    derived = {
        "schema_version": F.col("_version").cast("int"),
        "event_id": F.col("_uuid"),
        "icao24": F.col("_address"),
        "latitude": F.col("_lat"),
        "longitude": F.col("_lon"),
        "observed_at": F.col("_observed"),
        "ingested_at": F.coalesce(F.col("_ingested"), times.as_of_column(as_of)),
        "on_ground": F.col("_ground"),
    }
    events = [derived.get(f.name, _typed(f)).alias(f.name) for f in EVENT_SCHEMA]
    present = F.struct(
        *(
            (_member(name) if name in optional else _type(name)).isNotNull().alias(name)
            for name in OPTIONAL_FIELDS
        )
    )
    kept = ["_doc", "_address", "_lat", "_lon", "_observed", "_ingested", "_uuid", "_version",
            "_ground", *(f"_{n}_type" for n in OPTIONAL_FIELDS if n in _RULED)]
    checked = _once(
        _inspect(decode(messages)),
        messages.columns,
        {**{c: F.col(c) for c in kept}, "error_code": error_code()},
    ).withColumn("_members", _fetch([*optional, *odd]))
    typed = checked.select(
        "key", "value", "timestamp", "timestampType", "headers",
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        *events,
        present.alias("present"),
        "_doc", "_members",
        "error_code",
    )
    extra = _other_members([*optional, *odd])
    return typed.withColumn("extra", extra).drop("_doc", "_members")


def valid(classified: DataFrame) -> DataFrame:
    """Events that passed every rule, without the raw message."""
    return classified.where(F.col("error_code").isNull()).drop(
        "key", "value", "timestampType", "headers", "error_code"
    )


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("error_code").isNotNull())


def realtime_events(messages: DataFrame) -> DataFrame:
    """The weaker check of the realtime feed: a JSON object with a truthy ``icao24``.

    Fields are read as they stand (no lower-casing, no range check). ``skipped`` marks the
    messages that would not be published.
    """
    fields = []
    for f in EVENT_SCHEMA:
        is_time = isinstance(f.dataType, T.TimestampNTZType)
        column = F.col(f"_{f.name}") if is_time else _typed(f)
        fields.append(column.alias(f.name))
    own_id = F.when(payload.is_truthy(_member("_id")), _member("_id", "string"))
    skipped = ~payload.is_truthy(_member("icao24"))
    names = [*EVENT_SCHEMA.names, "_id"]
    times_read = {
        f"_{n}": times.parse_iso(F.col(f"_{n}_text")) for n in ("observed_at", "ingested_at")
    }
    texts = {
        f"_{n}_text": F.when(payload.is_string(_member(n)), _member(n, "string"))
        for n in ("observed_at", "ingested_at")
    }
    parsed = _once(
        decode(messages).withColumn("_members", _fetch(names)),
        messages.columns,
        {"_members": F.col("_members"), "skipped": skipped},
    )
    return parsed.withColumns(texts).withColumns(times_read).select(
        F.coalesce(own_id, _member("icao24", "string"), F.lit("")).alias("_id"),
        *fields,
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        "skipped",
    )


def backfill_ingested(rows: DataFrame, as_of) -> DataFrame:
    """Stored rows lacking ``ingested_at`` take their observation time, else ``as_of``."""
    return rows.withColumn(
        "ingested_at",
        F.coalesce(F.col("ingested_at"), F.col("observed_at"), times.as_of_column(as_of)),
    )
