"""Streaming jobs on a file-backed log with the log reader's columns."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from airlane.operators import history, latest, validate
from airlane.plans import views
from airlane.schemas import MESSAGE_SCHEMA, PUBLIC_COLUMNS
from airlane.sources import log, tables
from airlane.streaming import feed, writer
from helpers import event, record

NOW = datetime.now().strftime("%Y-%m-%dT%H:%M:%SZ")
NEW = event(observed_at=NOW, ingested_at=NOW, on_ground=None)
OLD = event(event_id="00000000-0000-4000-8000-000000000003", latitude=1.0, on_ground=True,
            observed_at="2000-01-01T00:00:00Z", ingested_at=NOW)
ONCE = {"availableNow": True}


def deliver(spark, path, first_offset, *values):
    rows = [record(v, first_offset + i) for i, v in enumerate(values)]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


class Pipeline:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.log = f"{root}/log"

    def run(self):
        source = log.stream_files(self.spark, self.log, 1)
        query = writer.start_writer(
            source, f"{self.root}/history", f"{self.root}/live",
            writer.dead_letter_files(f"{self.root}/dlq"), f"{self.root}/c", "group", **ONCE)
        query.awaitTermination(120)
        assert query.exception() is None

    def history(self):
        return tables.read_table(self.spark, f"{self.root}/history").collect()

    def live(self):
        return tables.read_live(self.spark, f"{self.root}/live").collect()

    def dead(self):
        return self.spark.read.parquet(f"{self.root}/dlq").collect()


@pytest.fixture
def pipeline(spark, tmp_path):
    return Pipeline(spark, str(tmp_path))


def test_acceptance(spark, pipeline):
    """A duplicate, a malformed and an old message: history 2, live 1 at its newest, dead 1."""
    deliver(spark, pipeline.log, 0, NEW, NEW, "not-json")
    pipeline.run()
    assert len(pipeline.history()) == 1 and len(pipeline.live()) == 1
    dead = pipeline.dead()
    assert len(dead) == 1
    assert json.loads(bytes(dead[0].value))["dlq_id"].endswith(":0:2")

    deliver(spark, pipeline.log, 3, NEW, OLD)  # a redelivery in a later batch, and a late row
    pipeline.run()
    assert sorted(r._id[-1] for r in pipeline.history()) == ["1", "3"]
    (row,) = pipeline.live()
    assert row.observed_at.year != 2000 and row.latitude == 52.5 and row._id == "c0ffe1"
    assert len(pipeline.dead()) == 1


def test_live_merges_across_batches(spark, pipeline):
    later = datetime.now().strftime("%Y-%m-%dT%H:%M:%S.900Z")
    deliver(spark, pipeline.log, 0, event(observed_at=NOW, ingested_at=NOW, callsign="A",
                                          squawk="7", on_ground=True))
    pipeline.run()
    deliver(spark, pipeline.log, 1, event(observed_at=later, ingested_at=later, callsign=None))
    pipeline.run()
    (row,) = pipeline.live()
    assert (row.callsign, row.squawk, row.on_ground, row.kafka_offset) == (None, "7", True, 1)


def test_repeated_batch_changes_nothing(spark, tmp_path):
    past, path, dlq = (str(tmp_path / n) for n in ("history", "live", "dlq"))
    first = spark.createDataFrame([record(NEW, 0), record("x", 1)], MESSAGE_SCHEMA)
    second = spark.createDataFrame([record(OLD, 2), record("y", 3)], MESSAGE_SCHEMA)
    sink = writer.dead_letter_files(dlq)
    for batch_id, batch in [(0, first), (1, second)]:
        writer.write_batch(batch, batch_id, past, path, sink, "g")

    def state():
        return (tables.read_live(spark, path).collect(), spark.read.parquet(dlq).count(),
                tables.read_table(spark, past).count())

    once = state()
    writer.write_batch(second, 1, past, path, sink, "g")
    assert state() == once and once[1:] == (2, 2)
    assert tables.versions(spark, path) == [0, 1, 2]
    assert tables.drop_old_versions(spark, path, keep=1) == [0, 1]
    assert tables.read_live(spark, path).count() == 1


def test_failed_dead_letter_stops_the_batch(spark, tmp_path):
    deliver(spark, str(tmp_path / "log"), 0, NEW, "not-json")

    def refuse(messages, batch_id):
        raise RuntimeError("dead letters unavailable")

    start = lambda sink: writer.start_writer(
        log.stream_files(spark, str(tmp_path / "log")), str(tmp_path / "history"),
        str(tmp_path / "live"), sink, str(tmp_path / "c"), "g", **ONCE)
    with pytest.raises(Exception, match="dead letters unavailable"):
        start(refuse).awaitTermination(120)
    assert tables.versions(spark, str(tmp_path / "live")) == []
    start(writer.dead_letter_files(str(tmp_path / "dlq"))).awaitTermination(120)
    assert tables.read_live(spark, str(tmp_path / "live")).count() == 1
    assert spark.read.parquet(str(tmp_path / "dlq")).count() == 1


def test_stream_equals_batch(spark, tmp_path):
    """Live and history of a log in several micro-batches match the batch operators."""
    rows = views.messages(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "log")
    for part in range(3):
        step = F.least(F.floor(F.col("offset") / 700), F.lit(2)) == part
        rows.where(step).coalesce(1).sortWithinPartitions("offset").write.mode(
            "append").parquet(path)
    as_of = views.messages_as_of(spark, "/root/testdata/sf0.001")
    events = validate.valid(validate.validate(rows, as_of))
    writer.start_writer(log.stream_files(spark, path, 1), str(tmp_path / "history"),
                        str(tmp_path / "live"), writer.dead_letter_files(str(tmp_path / "dlq")),
                        str(tmp_path / "c"), "g", live_retention_hours=10**6,
                        **ONCE).awaitTermination(200)
    assert len(tables.versions(spark, str(tmp_path / "live"))) == 3
    columns = ["icao24", "observed_at", "callsign", "baro_altitude_m", "on_ground",
               "kafka_offset", "velocity_mps"]
    found = tables.read_live(spark, str(tmp_path / "live")).select(*columns)
    expected = latest.live_merged(events).select(*columns)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))

    found = tables.read_members(spark, str(tmp_path / "live")).select("icao24", "name", "json")
    expected = latest.merged_members(events).select("icao24", "name", "json")
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    assert {r.name for r in found.collect()} >= {"note"}

    found = tables.read_table(spark, str(tmp_path / "history")).select("_id", "kafka_offset")
    expected = history.history(events).select("_id", "kafka_offset")
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))


def test_history_keeps_every_event(spark, tmp_path):
    """A partition days behind and a clock in the future lose nothing; repeating a batch adds nothing."""
    path, day = str(tmp_path / "history"), timedelta(days=1)
    start = datetime(2024, 1, 10, tzinfo=timezone.utc)
    shifts = [start, start + 300 * day, start - 3 * day, start - 3 * day]
    rows = []
    for i, stamp in enumerate(shifts):
        body = event(event_id=f"00000000-0000-4000-8000-00000000010{min(i, 2)}", ingested_at=None)
        rows.append((*record(body, i, i % 2)[:5], stamp, 1, []))
    batches = [spark.createDataFrame([r], MESSAGE_SCHEMA) for r in rows]
    for batch in [*batches, batches[1], batches[3]]:
        writer.write_history(writer.valid_events(batch), path)
    found = tables.read_table(spark, path).orderBy("kafka_offset").collect()
    assert [r.kafka_offset for r in found] == [0, 1, 2]
    assert [r.ingested_at for r in found] == [s.replace(tzinfo=None) for s in shifts[:3]]
    assert tables.drop_expired(spark, path, datetime(2024, 1, 8)) == ["2024-01-07"]
    assert tables.read_table(spark, path).count() == 2


def test_new_checkpoint_goes_on_from_the_path(spark, tmp_path):
    """A writer whose batch numbers start again sees the earlier state, and readers see its output."""
    path, later = str(tmp_path / "live"), datetime.now() + timedelta(seconds=5)
    stamp = later.strftime("%Y-%m-%dT%H:%M:%SZ")
    first = event(observed_at=NOW, ingested_at=NOW, callsign="A", pilot={"n": 1}, squawk=7700, spi="no")
    second = event(observed_at=stamp, ingested_at=stamp, crew=2, spi=True)
    for body in (first, second):
        batch = spark.createDataFrame([record(body)], MESSAGE_SCHEMA)
        writer.write_live(writer.valid_events(batch), path)
        known = tables.versions(spark, path)
    (row,) = tables.read_live_documents(spark, path).collect()
    assert known == [0, 1] and (row.callsign, row.spi) == ("A", True)
    assert {k: json.loads(v) for k, v in row.extra.items()} == {"pilot": {"n": 1}, "crew": 2}


def test_latest_states_in_complete_mode(spark, tmp_path):
    path = str(tmp_path / "log")
    deliver(spark, path, 0, NEW, OLD, event(icao24="00000b", observed_at=NOW))
    states = writer.latest_states(log.stream_files(spark, path), ["observed_at", "latitude"])
    query = states.writeStream.format("memory").queryName("states").outputMode("complete").trigger(
        **ONCE).start()
    query.awaitTermination(120)
    found = {r.icao24: r.latitude for r in spark.table("states").collect()}
    assert found == {"c0ffe1": 52.5, "00000b": 52.5}


def test_feed_skips_bad_rows_only(spark, tmp_path):
    path = str(tmp_path / "log")
    deliver(spark, path, 10, NEW, "not-json", event(icao24="00000b"))
    published, reported = [], []

    def publish(rows, batch_id):
        assert tuple(rows.columns) == PUBLIC_COLUMNS
        published.extend(r.icao24 for r in rows.collect())

    feed.start_feed(log.stream_files(spark, path), publish, str(tmp_path / "c"),
                    report=lambda counters, batch_id: reported.append(counters),
                    **ONCE).awaitTermination(120)
    assert sorted(published) == ["00000b", "c0ffe1"]
    assert [(c["received"], c["published"], c["skipped"]) for c in reported] == [(3, 2, 1)]
    assert reported[0]["newest_ingested_at"].strftime("%Y-%m-%dT%H:%M:%SZ") == NOW


def test_feed_batch_counters(spark):
    batch = spark.createDataFrame(
        [record(NEW, 10), record("not-json", 11), record(NEW, 12)], MESSAGE_SCHEMA)
    rows, counters = feed.public_batch(batch)
    assert rows.count() == 2
    seen = counters.first()
    assert (seen.received, seen.published, seen.skipped) == (3, 2, 1)
    rows, _ = feed.public_batch(batch, coalesce=True)
    assert [r.kafka_offset for r in rows.collect()] == [12]
    assert [(r.partition, r.next_offset) for r in feed.resume_positions(batch).collect()] == [
        (0, 13)]


def test_progress_counters(spark, tmp_path):
    path = str(tmp_path / "log")
    deliver(spark, path, 0, NEW, "not-json")
    counters = feed.ProgressCounters()
    spark.streams.addListener(counters)
    try:
        query = feed.observed_feed(log.stream_files(spark, path)).writeStream.format(
            "noop").trigger(**ONCE).start()
        query.awaitTermination(120)
        progress = [p for p in query.recentProgress if p.observedMetrics]
        seen = progress[0].observedMetrics["feed"]
        assert (seen.received, seen.skipped) == (2, 1)
    finally:
        spark.streams.removeListener(counters)


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        log.stream_kafka(spark, "localhost:9", "t")
