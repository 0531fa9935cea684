"""A snapshot with its log positions, and a feed that begins exactly there."""

import json
from datetime import datetime, timedelta, timezone

from airlane.operators import latest, live, retention
from airlane.schemas import MESSAGE_SCHEMA, STORED_SCHEMA
from airlane.sources import log, tables
from airlane.streaming import feed, writer
from helpers import TOPIC, event, record

START = datetime(2024, 1, 10, 12, tzinfo=timezone.utc)
ONCE = {"availableNow": True}


def batch(spark, rows):
    """Messages from ``(partition, offset, aircraft, minutes)``; ``None`` as aircraft is no event."""
    told = []
    for partition, offset, icao24, minutes in rows:
        stamp = (START + timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%SZ")
        body = "no event" if icao24 is None else event(
            icao24=icao24, observed_at=stamp, ingested_at=stamp, callsign=f"{partition}-{offset}",
            event_id=f"00000000-0000-4000-8000-{partition:04d}{offset:08d}")
        told.append((*record(body, offset, partition)[:5], START, 1, []))
    return spark.createDataFrame(told, MESSAGE_SCHEMA)


def write(spark, tmp_path, messages, number):
    log.write_files(messages, f"{tmp_path}/log/batch={number}")
    writer.write_batch(messages, number, f"{tmp_path}/history", f"{tmp_path}/live",
                       writer.dead_letter_files(f"{tmp_path}/dlq"), "g")


def vector(frame):
    return {(r.topic, r.partition): r.next_offset for r in frame.collect()}


FIRST = [(0, 0, "00000a", 0), (0, 1, "00000b", 1), (1, 7, "00000c", 2), (1, 8, None, 0)]
SECOND = [(0, 2, "00000a", 3), (0, 3, None, 0), (1, 9, "00000c", 1)]
#: Between snapshot and connection: a newer and an older row, a new partition, a repeated message.
BETWEEN = [(0, 4, "00000a", 2), (1, 10, "00000b", 9), (2, 0, "00000d", 4), (0, 2, "00000a", 3), (2, 1, None, 0)]


def test_the_feed_begins_where_the_snapshot_ends(spark, tmp_path):
    path = f"{tmp_path}/live"
    assert vector(tables.read_positions(spark, path)) == {}
    write(spark, tmp_path, batch(spark, FIRST), 0)
    write(spark, tmp_path, batch(spark, SECOND), 1)
    assert vector(tables.read_positions(spark, path, 0)) == {(TOPIC, 0): 2, (TOPIC, 1): 9}
    positions = tables.read_positions(spark, path)
    assert vector(positions) == {(TOPIC, 0): 4, (TOPIC, 1): 10}
    snapshot = tables.read_live(spark, path)
    log.write_files(batch(spark, BETWEEN), f"{tmp_path}/log/batch=2")

    seen = []
    feed.start_feed(log.stream_files(spark, f"{tmp_path}/log", 1), lambda rows, _: seen.extend(rows.collect()),
                    f"{tmp_path}/feed", positions=positions, **ONCE).awaitTermination(120)
    assert sorted(r.callsign for r in seen) == ["0-4", "1-10", "2-0"]

    public = live.public(snapshot)
    merged = latest.merge_feed(public, spark.createDataFrame(seen, public.schema)).collect()
    assert {r.icao24: r.callsign for r in merged} == {"00000a": "0-2", "00000b": "1-10", "00000c": "1-7", "00000d": "2-0"}
    # Reading on as a writer does gives the same: nothing lost, nothing older wins.
    write(spark, tmp_path, batch(spark, BETWEEN), 2)
    assert {r.icao24: r.callsign for r in tables.read_live(spark, path).collect()} == {r.icao24: r.callsign for r in merged}
    assert vector(tables.read_positions(spark, path)) == {(TOPIC, 0): 5, (TOPIC, 1): 11, (TOPIC, 2): 2}


def test_positions_never_go_back_and_follow_their_version(spark, tmp_path):
    path = f"{tmp_path}/live"
    write(spark, tmp_path, batch(spark, FIRST), 0)
    write(spark, tmp_path, batch(spark, SECOND), 1)
    write(spark, tmp_path, batch(spark, FIRST), 0)  # a repeated batch
    assert vector(tables.read_positions(spark, path)) == {(TOPIC, 0): 4, (TOPIC, 1): 10}
    kept = tables.versions(spark, path)[-1]
    tables.drop_old_versions(spark, path, keep=1)  # folds it into a base
    assert tables.versions(spark, path) == [kept]
    assert vector(tables.read_positions(spark, path)) == {(TOPIC, 0): 4, (TOPIC, 1): 10}
    assert sorted(p.name for p in (tmp_path / "live" / "positions").iterdir()) == [f"version={kept}"]
    tables.write_live(spark.createDataFrame([], STORED_SCHEMA), path)  # written whole: from the start again
    assert vector(tables.read_positions(spark, path)) == {}


def test_positions_filter_batches_and_name_offsets(spark):
    messages = batch(spark, FIRST + BETWEEN + FIRST)
    none = spark.createDataFrame([], tables.POSITION_SCHEMA)
    assert retention.after_positions(messages, none).count() == len(FIRST + BETWEEN + FIRST)
    some = spark.createDataFrame([(TOPIC, 0, 2), (TOPIC, 1, 9), ("other", 2, 99)], tables.POSITION_SCHEMA)
    kept = retention.after_positions(messages, some)
    assert kept.columns == messages.columns
    assert sorted((r.partition, r.offset) for r in kept.collect()) == [(0, 2), (0, 4), (1, 10), (2, 0), (2, 1)]
    assert json.loads(log.starting_offsets(some, {TOPIC: 3})) == {TOPIC: {"0": 2, "1": 9, "2": -2}}
    both = retention.join_positions(some, spark.createDataFrame([(TOPIC, 0, 1), (TOPIC, 1, 12)], tables.POSITION_SCHEMA))
    assert vector(both) == {(TOPIC, 0): 2, (TOPIC, 1): 12, ("other", 2): 99}
