import base64
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from airlane.functions import times
from airlane.operators import deadletter, history, live, validate
from helpers import AS_OF, event, messages


def classify(spark, values):
    return validate.validate(messages(spark, values), times.as_of_column(AS_OF))


CASES = [
    (event(), None),
    (json.dumps(event()) + " \n", None),
    (" \t" + json.dumps(event(nested=[{"a": 1}])), None),
    (b"\xffbad", "payload"),
    ("not-json", "payload"),
    ("[1]", "payload"),
    ("", "payload"),
    (None, "payload"),
    ("null", "payload"),
    (json.dumps(event()) + " x", "payload"),
    (json.dumps(event()) + "," + json.dumps(event()), "payload"),
    (json.dumps(event()) + "] x", "payload"),
    (json.dumps(event()) + "} x", "payload"),
    ("{'a': 1}", "payload"),
    (json.dumps(event()).replace('"icao24"', '"icao24": "zz", "icao24"'), None),
    (event(icao24="C0FFE1"), None),
    (event(icao24=123456), None),
    (event(icao24=123456.0), "icao24"),
    (event(icao24="bad"), "icao24"),
    (event(icao24="c0ffe1\n"), "icao24"),
    (event(icao24=None), "icao24"),
    (event(icao24=...), "icao24"),
    (event(icao24=["c0ffe1"]), "icao24"),
    (event(latitude=90), None),
    (event(latitude=-90.0), None),
    (event(latitude=90.0001), "latitude"),
    (event(latitude="41"), "latitude"),
    (event(latitude=True), "latitude"),
    (event(latitude=None), "latitude"),
    (event(latitude=...), "latitude"),
    (json.dumps(event()).replace("52.5", "1e400"), "latitude"),
    (json.dumps(event()).replace("52.5", "525e-1"), None),
    (event(longitude=-180), None),
    (event(longitude=180.5), "longitude"),
    (event(longitude=[1]), "longitude"),
    (event(observed_at="2024-01-01"), None),
    (event(observed_at="2024-01-01T00:00:00Z"), None),
    (event(observed_at="2024-01-01 00:00"), None),
    (event(observed_at="20240101T000000Z"), None),
    (event(observed_at="2024-01-01T00:00:00.1234567+0300"), None),
    (event(observed_at="2024-13-01"), "observed_at"),
    (event(observed_at="2024-02-30T00:00:00Z"), "observed_at"),
    (event(observed_at="2024"), "observed_at"),
    (event(observed_at="2024-1-1"), "observed_at"),
    (event(observed_at=" 2024-01-01"), "observed_at"),
    (event(observed_at="12:00"), "observed_at"),
    (event(observed_at=1704067200), "observed_at"),
    (event(observed_at=None), "observed_at"),
    (event(observed_at=...), "observed_at"),
    (event(ingested_at=None), None),
    (event(ingested_at=...), None),
    (event(ingested_at="yesterday"), "ingested_at"),
    (event(ingested_at=5), "ingested_at"),
    (event(schema_version=...), None),
    (event(schema_version=1.0), None),
    (event(schema_version=True), None),
    (event(schema_version=False), "schema_version"),
    (event(schema_version=2), "schema_version"),
    (event(schema_version="1"), "schema_version"),
    (event(schema_version=None), "schema_version"),
    (event(event_id=...), None),
    (event(event_id="{00000000000040008000000000000001}"), None),
    (event(event_id="urn:uuid:00000000-0000-4000-8000-00000000000A"), None),
    (event(event_id="xyz"), "event_id"),
    (event(event_id=None), "event_id"),
    (event(event_id=7), "event_id"),
    (event(on_ground=True), None),
    (event(on_ground=None), None),
    (event(on_ground=0), None),
    (event(on_ground=1.0), None),
    (event(on_ground=2), "on_ground"),
    (event(on_ground="yes"), "on_ground"),
    (event(latitude=95, schema_version=2), "latitude"),
    (event(icao24="bad", event_id="xyz"), "icao24"),
]


def test_rules(spark):
    rows = classify(spark, [value for value, _ in CASES]).orderBy("kafka_offset").collect()
    found = [(case[0], row.error_code) for case, row in zip(CASES, rows, strict=True)]
    assert found == CASES


def test_typed_event(spark):
    row = classify(spark, [event(
        icao24="C0FFE1", event_id="{00000000-0000-4000-8000-0000000000FF}", on_ground=1,
        observed_at="2024-01-01T03:00:00.123999+03:00", ingested_at=None, callsign=None,
        velocity_mps=7, spi="x", category=3, note={"b": [1, None]})]).first()
    assert row.icao24 == "c0ffe1"
    assert row.event_id == "00000000-0000-4000-8000-0000000000ff"
    assert row.observed_at == datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert row.ingested_at == AS_OF
    assert (row.on_ground, row.velocity_mps, row.spi, row.category) == (None, 7.0, None, 3)
    assert row.present.callsign and row.present.on_ground and not row.present.squawk
    assert {k: json.loads(v) for k, v in row.extra.items()} == {
        "note": {"b": [1, None]}, "on_ground": 1, "spi": "x"}


def test_mistyped_members_keep_their_original(spark):
    body = event(velocity_mps="12", time_position=1.5, spi=[True], category=None, on_ground=1, note="n")
    row = validate.valid(classify(spark, [body])).first()
    assert (row.velocity_mps, row.spi, row.category, row.on_ground) == (None, None, None, None)
    assert {k: json.loads(v) for k, v in row.extra.items()} == {
        "velocity_mps": "12", "time_position": 1.5, "spi": [True], "on_ground": 1, "note": "n"}
    assert validate.valid(classify(spark, [event(category=3)])).first().extra is None


@pytest.mark.parametrize("text, expected", [
    ("2024-01-01T12", datetime(2024, 1, 1, 12)),
    ("2024-01-01_12:30", datetime(2024, 1, 1, 12, 30)),
    ("20240101", datetime(2024, 1, 1)),
    ("20240101T1230", datetime(2024, 1, 1, 12, 30)),
    ("2024-01-01T123045,5Z", datetime(2024, 1, 1, 12, 30, 45, 500000)),
    ("2024-01-01T12:30:45-0130", datetime(2024, 1, 1, 14, 0, 45)),
    ("2024-01-01T12:30:45.999999", datetime(2024, 1, 1, 12, 30, 45, 999000)),
    ("2024-01-01T00:00Z", datetime(2024, 1, 1)), ("2024-01-01T00:00+03:00", datetime(2023, 12, 31, 21)),
    ("20240101T0000Z", datetime(2024, 1, 1)), ("2024-01-01T00Z", datetime(2024, 1, 1)),
    ("2024-01-01T00:00+0530", datetime(2023, 12, 31, 18, 30)), ("2024-01-01Z", datetime(2024, 1, 1)),
    ("2024-01-01T00:0000", None),
    ("0000-01-01", None), ("2024-01-01T", None), ("2024-01-01T25:00", None), ("", None),
])
def test_iso_times(spark, text, expected):
    row = spark.createDataFrame([(text,)], "t STRING").select(times.parse_iso(F.col("t"))).first()
    assert row[0] == expected


def test_iso_grid(spark):
    """Date form x separator x precision x zone, as Python's own parser reads them."""
    texts = [day + sep + clock + zone
             for day in ("2024-02-29", "20240229") for sep in "T _"
             for clock in ("07", "07:08", "0708", "07:08:09", "070809", "07:08:09.5", "070809.123456", "07:08:09,25", "24:00", "07:60",
                           "07.5", "07,25", "0708.5", "07:08,25", "07:08:09.", "070809,", "07.", "0708,")
             for zone in ("", "Z", "+00:00", "-03:30", "+0530", "+02", "+00:00:30", "-013015")]

    def expected(text):
        try:
            read = datetime.fromisoformat(text)
        except ValueError:
            return None
        utc = read.astimezone(timezone.utc).replace(tzinfo=None) if read.tzinfo else read
        return utc.replace(microsecond=utc.microsecond // 1000 * 1000)

    rows = spark.createDataFrame([(t,) for t in texts], "t STRING").select("t", times.parse_iso(F.col("t"))).collect()
    assert {r[0]: r[1] for r in rows} == {t: expected(t) for t in texts}


def test_split_is_complete(spark):
    rows = classify(spark, [value for value, _ in CASES])
    good, bad = validate.valid(rows).count(), validate.rejected(rows).count()
    assert good == sum(code is None for _, code in CASES) and good + bad == len(CASES)


def test_envelope_keeps_bytes(spark):
    rows = classify(spark, [event(), b"\xffbad", None])
    found = deadletter.envelopes(validate.rejected(rows), "group", times.as_of_column(AS_OF))
    first, second = found.orderBy("dlq_id").collect()
    assert base64.b64decode(first.payload.data) == b"\xffbad"
    assert first.dlq_id.endswith(":0:1") and second.payload.data is None
    assert first.source.headers[0].name == "hop"
    assert base64.b64decode(first.source.headers[0].value_base64) == b"north"
    assert base64.b64decode(first.source.key_base64) == b"c0ffe1"
    assert first.source.timestamp_ms == 1_700_000_000_000 and first.source.timestamp_type == 1
    assert first.error.classification == "permanent" and first.attempts == 1
    wire = deadletter.to_messages(found).orderBy("key").first()
    assert bytes(wire.key).decode() == first.dlq_id
    assert json.loads(bytes(wire.value))["payload"]["encoding"] == "base64"


def test_long_base64_is_one_line(spark):
    text = "x" * 500
    row = deadletter.envelopes(
        validate.rejected(classify(spark, [text])), "g", times.as_of_column(AS_OF)).first()
    assert base64.b64encode(text.encode()).decode() == row.payload.data


def test_realtime_check_is_weaker(spark):
    values = [event(icao24="BAD", latitude=999), "not-json", event(icao24=""), event(icao24=0),
              event(icao24=None), event(icao24=5, _id="own"), None, event(icao24=[])]
    rows = validate.realtime_events(messages(spark, values)).orderBy("kafka_offset").collect()
    assert [r.skipped for r in rows] == [False, True, True, True, True, False, True, True]
    assert (rows[0].icao24, rows[0]._id, rows[0].latitude) == ("BAD", "BAD", 999.0)
    assert rows[5]._id == "own"
    assert live.public(validate.realtime_events(messages(spark, values))).columns[0] == "_id"


def test_identity(spark):
    rows = history.with_identity(validate.valid(classify(spark, [event(), event(event_id=...)])))
    ids = [r._id for r in rows.orderBy("kafka_offset").collect()]
    assert ids == ["00000000-0000-4000-8000-000000000001", "positions.test:0:1"]
