"""Keyed deduplication and the live table as base and changes: what is read, shuffled and written."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from airlane.operators import latest
from airlane.schemas import MEMBER_SCHEMA, MESSAGE_SCHEMA, STORED_SCHEMA
from airlane.sources import tables
from airlane.streaming import writer
from helpers import event, record

DAY = timedelta(days=1)
START = datetime(2024, 1, 10, 12, tzinfo=timezone.utc)


def at(stamp):
    return stamp.strftime("%Y-%m-%dT%H:%M:%SZ")


def events(spark, rows):
    """Valid events from ``(offset, log time, event)``."""
    told = [(*record(body, offset)[:5], stamp, 1, []) for offset, stamp, body in rows]
    return writer.valid_events(spark.createDataFrame(told, MESSAGE_SCHEMA))


def numbered(n, stamp, **members):
    return event(event_id=f"00000000-0000-4000-8000-{n:012d}", ingested_at=at(stamp), observed_at=at(stamp), **members)


def stored(spark, path):
    return sorted((r.kafka_offset, str(r.ingested_at)) for r in tables.read_table(spark, path).collect())


def opened(spark, path, days, within=2):
    return tables._dates_near(spark, path, days, within)


def test_a_batch_opens_only_dates_that_may_hold_its_ids(spark, tmp_path):
    path = str(tmp_path / "history")
    days = [START + k * DAY for k in range(0, 20, 1)] + [datetime(1970, 1, 2, tzinfo=timezone.utc)]
    writer.write_history(events(spark, [(i, d, numbered(i, d)) for i, d in enumerate(days)]), path)
    assert len(stored(spark, path)) == 21
    # A directory outside the window may hold anything: it is not even opened.
    (tmp_path / "history" / "ingest_date=2024-01-20" / "part-broken.parquet").write_bytes(b"no parquet")
    batch = [(100, START, numbered(100, START)), (101, START, numbered(1, START)),
             (102, START, numbered(102, datetime(1970, 1, 1, tzinfo=timezone.utc))),
             (103, START, numbered(20, datetime(1970, 1, 3, tzinfo=timezone.utc)))]
    writer.write_history(events(spark, batch), path)
    (tmp_path / "history" / "ingest_date=2024-01-20" / "part-broken.parquet").unlink()
    offsets = [o for o, _ in stored(spark, path)]
    assert offsets == [*range(21), 100, 102]  # 101 and 103 repeat stored ids
    near = opened(spark, path, [START.date(), datetime(1970, 1, 1).date()])
    assert [d.isoformat() for d in near] == ["1970-01-01", "1970-01-02", "2024-01-10", "2024-01-11", "2024-01-12"]
    assert opened(spark, path, [None]) == [] and len(opened(spark, path, [], None)) == 22


def test_only_the_batch_is_shuffled(spark, tmp_path, capsys):
    path = str(tmp_path / "history")
    writer.write_history(events(spark, [(i, START, numbered(i, START)) for i in range(50)]), path)
    asked = events(spark, [(60, START, numbered(7, START))]).select(F.col("event_id").alias("_asked"), F.to_date("ingested_at").alias("_day"))
    known = tables._same_window(tables.stored_ids(spark, path, [START.date()]), F.broadcast(asked), 2)
    known.explain("formatted")
    plan = capsys.readouterr().out
    scan = plan[plan.index("Scan parquet"):]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "ReadSchema: struct<_id:string>" in scan and "ingest_date=2024-01-10" in scan
    tree = plan[:plan.index("\n\n")].split("\n")
    scan_at = next(i for i, line in enumerate(tree) if "Scan parquet" in line)
    join_at = next(i for i, line in enumerate(tree) if "BroadcastHashJoin" in line)
    assert not any("Exchange" in line and "Broadcast" not in line for line in tree[join_at:scan_at])


def test_large_batches_are_joined_by_shuffling(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MOST_SENT_IDS", 0)
    path = str(tmp_path / "history")
    rows = events(spark, [(i, START, numbered(i % 5, START)) for i in range(8)])
    writer.write_history(rows, path)
    writer.write_history(rows, path)
    assert [o for o, _ in stored(spark, path)] == [0, 1, 2, 3, 4]
    tables.append_history(tables.read_table(spark, path), path, None)
    assert len(stored(spark, path)) == 5


def test_expiry_counts_every_date(spark, tmp_path):
    path = str(tmp_path / "history")
    days = [datetime(1970, 1, 2, tzinfo=timezone.utc), datetime(1999, 5, 1, tzinfo=timezone.utc), START]
    rows = events(spark, [(i, d, numbered(i, d)) for i, d in enumerate(days)])
    rows = rows.withColumn("_id", F.col("event_id"))
    tables.write_history(rows, path)
    tables.write_history(rows.limit(1).withColumn("ingested_at", F.lit(None).cast("timestamp_ntz")), path)
    assert tables.drop_expired(spark, path, datetime(2024, 1, 10)) == ["1970-01-02", "1999-05-01"]
    assert sorted(str(r.ingested_at) for r in tables.read_table(spark, path).collect()) == ["2024-01-10 12:00:00", "None"]


def whole(spark, state, members, batch, cut):
    """The live table and its members after a batch by rewriting all of it."""
    taken = latest.accepted_after(state, batch).persist()
    merged = latest.fold(taken).select(*state.columns)
    kept = merged.where(F.col("ingested_at").isNull() | (F.col("ingested_at") > F.lit(cut)))
    kept = spark.createDataFrame(kept.collect(), STORED_SCHEMA)
    told = latest.merge_members(members, taken).join(kept.select("icao24"), "icao24", "left_semi")
    return kept, spark.createDataFrame(told.select(*MEMBER_SCHEMA.names).collect(), MEMBER_SCHEMA)


def rows_of(frame):
    return sorted(map(repr, frame.select(*sorted(frame.columns)).collect()))


def test_changes_equal_whole_snapshots(spark, tmp_path):
    """Random batches with ties, nulls, open members and expiry: every version as if written whole."""
    random.seed(8)
    path, seen = str(tmp_path / "live"), {}
    state, members = spark.createDataFrame([], STORED_SCHEMA), spark.createDataFrame([], MEMBER_SCHEMA)
    offset = 0
    for step in range(4):
        now, batch = START + step * timedelta(hours=9), []
        for _ in range(12):
            seen_at = now - timedelta(minutes=random.choice([0, 1, 1, 30, 2000]))
            body = {"icao24": f"0000{random.randrange(8):02x}", "observed_at": at(seen_at), "ingested_at": at(seen_at),
                    **random.choice([{}, {"callsign": None}, {"callsign": f"C{offset}"}, {"squawk": 7700}, {"squawk": "7700"}]),
                    **random.choice([{}, {"crew": offset}, {"note": {"n": step}}])}
            batch.append((offset, now, event(**body)))
            offset += 1
        told = events(spark, batch).persist()
        writer.write_live(told, path, retention_hours=20)
        state, members = whole(spark, state, members, told, now.replace(tzinfo=None) - timedelta(hours=20))
        seen[step] = rows_of(state), rows_of(members)
        assert (rows_of(tables.read_live(spark, path)), rows_of(tables.read_members(spark, path))) == seen[step], step
        writer.write_live(told, path, retention_hours=20)  # a repeated batch
        assert rows_of(tables.read_live(spark, path)) == seen[step][0]
        told.unpersist()
    files = tables.live_files(spark, path)
    assert files.bases and files.changes  # compacted on the way
    for version in (1, 4, 7):
        step = version // 2
        assert (rows_of(tables.read_live(spark, path, version)), rows_of(tables.read_members(spark, path, version))) == seen[step]
    newest = tables.read_live(spark, path)
    dropped = tables.drop_old_versions(spark, path, keep=2)
    assert dropped == list(range(6)) and tables.versions(spark, path) == [6, 7]
    assert rows_of(newest) == seen[3][0] and rows_of(tables.read_members(spark, path)) == seen[3][1]


def test_written_bytes_follow_the_batch(spark, tmp_path):
    path = str(tmp_path / "live")
    many = [(i, START, event(icao24=f"{i:06x}", observed_at=at(START), ingested_at=at(START), note="n" * 50)) for i in range(4000)]
    first = events(spark, many)
    tables.write_live(latest.fold(latest.accepted_after(tables.read_live(spark, path), first)).select(*STORED_SCHEMA.names), path,
                      latest.merge_members(tables.read_members(spark, path), latest.accepted_after(tables.read_live(spark, path), first)))
    later = START + timedelta(minutes=5)
    writer.write_live(events(spark, [(9000 + i, later, event(icao24=f"{i:06x}", observed_at=at(later), ingested_at=at(later)))
                                     for i in range(3)]), path)
    files = tables.live_files(spark, path)
    (name, _), = files.changes.values()
    assert spark.read.parquet(f"{path}/{name}").count() == 3
    assert spark.read.parquet(f"{path}/members/{name}").count() == 3
    assert tables._bytes(spark, f"{path}/{name}") < 0.2 * tables._bytes(spark, f"{path}/version=0")
    assert tables.read_live(spark, path).count() == 4000 and tables.read_members(spark, path).count() == 4000
    assert tables.compact_live(spark, path) is None
    assert tables.compact_live(spark, path, most=1, least=1) == 1
    assert tables.live_files(spark, path).of() == (1, [])
    assert tables.read_live(spark, path).where(F.col("observed_at") == F.lit(later.replace(tzinfo=None))).count() == 3


def test_uncommitted_changes_are_not_read(spark, tmp_path):
    path = str(tmp_path / "live")
    told = events(spark, [(0, START, event(observed_at=at(START), ingested_at=at(START)))])
    writer.write_live(told, path)
    (tmp_path / "live" / "changes=1").mkdir()
    assert tables.versions(spark, path) == [0] and tables.read_live(spark, path).count() == 1
    writer.write_live(told, path)
    assert tables.versions(spark, path) == [0, 1] and not tables.is_empty(spark, path)
    writer.write_live(told.limit(0), path)
    assert tables.versions(spark, path) == [0, 1]
