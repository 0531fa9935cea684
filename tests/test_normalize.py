import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from airlane.functions import times
from airlane.operators import normalize, validate
from airlane.schemas import MESSAGE_SCHEMA
from airlane.sources import snapshots
from helpers import AS_OF

GOLDEN = ["4BAA12", " THY123 ", "Turkey", 1700000000, 1700000001, 28.75, 41.10, 8500.0, False,
          220.0, 90.0, 0.0, None, 8700.0, "1234", False, 0, 3]


def states(spark, *rows, time=1700000999):
    text = json.dumps({"time": time, "states": list(rows)})
    return snapshots.explode_states(spark.createDataFrame([(text,)], "value STRING"))


def changed(**at):
    row = list(GOLDEN)
    for index, value in at.items():
        row[int(index[1:])] = value
    return row


def test_golden_state(spark):
    row = normalize.normalize_states(states(spark, GOLDEN), AS_OF).first()
    assert (row.icao24, row.callsign, row.origin_country) == ("4baa12", "THY123", "Turkey")
    assert (row.baro_altitude_m, row.geo_altitude_m, row.schema_version) == (8500.0, 8700.0, 1)
    assert (row.longitude, row.latitude, row.on_ground, row.spi) == (28.75, 41.10, False, False)
    assert (row.squawk, row.position_source, row.category) == ("1234", 0, 3)
    assert row.observed_at == datetime(2023, 11, 14, 22, 13, 20)
    assert (row.api_time, row.ingested_at, row.source) == (1700000999, AS_OF, "opensky")


@pytest.mark.parametrize(
    "position, contact, expected",
    [
        (None, 1700000123, datetime(2023, 11, 14, 22, 15, 23)),
        (0, 1700000123, datetime(2023, 11, 14, 22, 15, 23)),
        (0, 0, datetime(2023, 11, 14, 22, 29, 59)),
        (None, None, datetime(2023, 11, 14, 22, 29, 59)),
        (1700000000.5, 1, datetime(2023, 11, 14, 22, 13, 20, 500000)),
    ],
)
def test_observation_time(spark, position, contact, expected):
    rows = states(spark, changed(_3=position, _4=contact))
    assert normalize.normalize_states(rows, AS_OF).first().observed_at == expected


def test_skipped_states(spark):
    rows = states(
        spark, GOLDEN, GOLDEN[:16], GOLDEN[:17], changed(_5=None), changed(_6=None),
        changed(_0=""), changed(_0=None), changed(_0=0), "text", None, {"a": 1},
    )
    assert normalize.counts(rows).first().asDict() == {
        "api_records": 11, "queued": 2, "skipped": 9}
    assert normalize.skipped_states(rows).count() == 9
    kept = normalize.normalize_states(rows, AS_OF).collect()
    assert sorted(row.category is None for row in kept) == [False, True]


@pytest.mark.parametrize("callsign, expected", [("   ", None), ("", None), (None, None),
                                                ("\tA B \n", "A B")])
def test_callsign(spark, callsign, expected):
    row = normalize.normalize_states(states(spark, changed(_1=callsign)), AS_OF).first()
    assert row.callsign == expected


def test_ids_are_stable_and_valid(spark):
    rows = normalize.normalize_states(states(spark, GOLDEN, GOLDEN), AS_OF)
    first = sorted(r.event_id for r in rows.collect())
    assert first == sorted(r.event_id for r in rows.collect())
    assert len(set(first)) == 2
    back = rows.select(
        validate.canonical_uuid(validate.uuid_digits(F.col("event_id"))).alias("u"), "event_id")
    assert all(r.u == r.event_id for r in back.collect())


@pytest.mark.parametrize("payload", ["[1]", "no json", '{"time": 1} x', ""])
def test_payload_must_be_an_object(spark, payload):
    frame = spark.createDataFrame([(payload,)], "value STRING")
    with pytest.raises(Exception, match="not a JSON object"):
        snapshots.explode_states(frame).collect()
    assert snapshots.explode_states(frame, strict=False).count() == 0
    assert snapshots.malformed_snapshots(frame).count() == 1


def test_no_states(spark):
    rows = spark.createDataFrame(
        [('{"time": 1, "states": null}',), ('{"time": 1}',), ('{"time": 1, "states": []}',)],
        "value STRING")
    assert snapshots.explode_states(rows).count() == 0


def test_landed_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"time": 5, "states": [GOLDEN]}, indent=1))
    rows = snapshots.explode_states(snapshots.read_snapshots(spark, str(tmp_path)))
    assert rows.count() == 1


def test_area(spark):
    rows = states(spark, GOLDEN, changed(_5=46.0, _6=43.5), changed(_5=46.1), changed(_6=34.9))
    events = normalize.normalize_states(rows, AS_OF)
    assert normalize.in_area(events, "turkey").count() == 2
    assert normalize.in_area(events, "global").count() == 4
    with pytest.raises(ValueError):
        normalize.in_area(events, "mars")


def test_messages_validate_again(spark):
    events = normalize.normalize_states(states(spark, GOLDEN), AS_OF)
    wire = normalize.to_messages(events)
    row = wire.first()
    assert bytes(row.key) == b"4baa12"
    value = json.loads(bytes(row.value))
    assert len(value) == 23 and value["observed_at"] == "2023-11-14T22:13:20.000+00:00"
    assert "vertical_rate_mps" in value
    log = wire.selectExpr(
        "key", "value", "'t' AS topic", "0 AS partition", "0L AS offset",
        "timestamp'2024-01-01' AS timestamp", "0 AS timestampType",
        "CAST(NULL AS ARRAY<STRUCT<key:STRING,value:BINARY>>) AS headers")
    assert log.schema.names == MESSAGE_SCHEMA.names
    back = validate.validate(log, times.as_of_column(AS_OF)).first()
    assert back.error_code is None and back.event_id == events.first().event_id


def test_non_finite_numbers_fail(spark):
    events = normalize.normalize_states(states(spark, GOLDEN), AS_OF)
    broken = events.withColumn("velocity_mps", F.lit(float("nan")))
    with pytest.raises(Exception, match="velocity_mps is not a finite number"):
        normalize.to_messages(broken).collect()
