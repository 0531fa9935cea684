import gzip
import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from airlane.schemas import HISTORY_SCHEMA, STORED_SCHEMA
from airlane.sources import archive, tables


def rows(spark, *ids):
    full = []
    for i, name in enumerate(ids):
        row = {f.name: None for f in STORED_SCHEMA}
        row.update({"_id": name, "icao24": "c0ffe1", "latitude": 52.5, "kafka_offset": i,
                    "on_ground": None if i else False,
                    "observed_at": datetime(2024, 1, 1, 0, 0, 0, 123000)})
        full.append(row)
    return spark.createDataFrame(full, STORED_SCHEMA)


@pytest.fixture
def exported(spark, tmp_path):
    both = {"raw_positions": rows(spark, "a", "b", "c"), "live_positions": rows(spark, "c0ffe1")}
    path = str(tmp_path / "archive")
    archive.export_archive(both, path, "flights")
    return path, both


def targets(tmp_path):
    return {n: str(tmp_path / "restored" / n) for n in archive.COLLECTIONS}


def test_round_trip(spark, tmp_path, exported):
    path, both = exported
    archive.import_archive(spark, path, targets(tmp_path))
    for name, where in targets(tmp_path).items():
        read = tables.read_live if name == "live_positions" else tables.read_table
        back = read(spark, where)
        assert back.schema == both[name].schema
        assert sorted(map(repr, back.collect())) == sorted(map(repr, both[name].collect()))
    manifest = archive.read_manifest(spark, path)
    assert manifest["rows"] == {"raw_positions": 3, "live_positions": 1}


def test_filled_target_is_refused_unless_replaced(spark, tmp_path, exported):
    path, _ = exported
    where = targets(tmp_path)
    tables.write_history(rows(spark, "old"), where["raw_positions"])
    tables.write_live(rows(spark, "old"), where["live_positions"])
    with pytest.raises(ValueError, match="not empty"):
        archive.import_archive(spark, path, where)
    assert [r._id for r in tables.read_table(spark, where["raw_positions"]).collect()] == ["old"]
    archive.import_archive(spark, path, where, replace=True)
    found = {r._id for r in tables.read_table(spark, where["raw_positions"]).collect()}
    assert found == {"a", "b", "c"}
    assert [r._id for r in tables.read_live(spark, where["live_positions"]).collect()] == ["c0ffe1"]


@pytest.mark.parametrize("line", ['{"collection":"other","document":{}}', "not json",
                                  '{"collection":"raw_positions"}', '{"document":{}}'])
def test_invalid_lines_change_nothing(spark, tmp_path, exported, line):
    path, _ = exported
    with gzip.open(Path(path) / "documents" / "part-extra.txt.gz", "wt") as extra:
        extra.write(line + "\n")
    with pytest.raises(ValueError, match="invalid records"):
        archive.import_archive(spark, path, targets(tmp_path))
    assert not (tmp_path / "restored").exists()


def test_missing_rows_are_noticed(spark, tmp_path, exported):
    path, _ = exported
    extra = {"collection": "raw_positions", "document": {"_id": "d", "icao24": "c0ffe1"}}
    with gzip.open(Path(path) / "documents" / "part-extra.txt.gz", "wt") as out:
        out.write(json.dumps(extra) + "\n")
    with pytest.raises(ValueError, match="manifest says"):
        archive.import_archive(spark, path, targets(tmp_path))


def test_manifest_is_required(spark, tmp_path):
    (tmp_path / "documents").mkdir()
    with pytest.raises(ValueError, match="no archive manifest"):
        archive.import_archive(spark, str(tmp_path), targets(tmp_path))
    (tmp_path / "manifest").mkdir()
    (tmp_path / "manifest" / "part-0.txt").write_text('{"format":"other"}\n')
    with pytest.raises(ValueError, match="unsupported"):
        archive.import_archive(spark, str(tmp_path), targets(tmp_path))


def test_restored_tables_go_on(spark, tmp_path):
    """After an import, reads and the writer see the restored rows, open members included."""
    from airlane.operators import history
    from airlane.schemas import MESSAGE_SCHEMA
    from airlane.streaming import writer
    from helpers import event, record

    body = event(callsign="A", note={"n": 1})
    batch = lambda b, offset: spark.createDataFrame([record(b, offset)], MESSAGE_SCHEMA)
    events = writer.valid_events(batch(body, 0))
    old = str(tmp_path / "old")
    writer.write_live(events, old, 10**6)
    full = {"raw_positions": history.history(events).select(*STORED_SCHEMA.names, "extra"),
            "live_positions": tables.read_live_documents(spark, old)}
    archive.export_archive(full, str(tmp_path / "archive"), "flights")
    where = targets(tmp_path)
    archive.import_archive(spark, str(tmp_path / "archive"), where)
    assert {p.name for p in Path(where["raw_positions"]).glob("ingest_date=*")} == {"ingest_date=2024-01-01"}
    (row,) = tables.read_table(spark, where["raw_positions"], HISTORY_SCHEMA).collect()
    assert json.loads(row.extra["note"]) == {"n": 1}

    later = event(event_id="00000000-0000-4000-8000-000000000002", observed_at="2024-01-01T00:01Z")
    for offset, again in enumerate((body, later), 5):
        new = writer.valid_events(batch(again, offset))
        writer.write_history(new, where["raw_positions"])
        writer.write_live(new, where["live_positions"], 10**6)
    assert tables.read_table(spark, where["raw_positions"]).count() == 2
    (row,) = tables.read_live_documents(spark, where["live_positions"]).collect()
    assert (row.callsign, row.kafka_offset, json.loads(row.extra["note"])) == ("A", 6, {"n": 1})


def test_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "history")
    day = rows(spark, "a", "b").withColumn("ingested_at", F.expr("TIMESTAMP_NTZ '2024-01-01'"))
    for _ in range(2):
        tables.append_history(day, path)
    assert tables.read_table(spark, path).count() == 2


def test_history_is_appended_by_date(spark, tmp_path):
    path = str(tmp_path / "history")
    day = rows(spark, "a", "b").withColumn("ingested_at", F.expr("TIMESTAMP_NTZ '2024-01-01'"))
    extra = F.create_map(F.lit("note"), F.lit('"n"'))
    tables.append_history(day.withColumn("extra", extra), path)
    later = rows(spark, "c").withColumn("ingested_at", F.expr("TIMESTAMP_NTZ '2024-01-02'"))
    tables.append_history(later.withColumn("extra", extra), path)
    assert {p.name for p in Path(path).glob("ingest_date=*")} == {
        "ingest_date=2024-01-01", "ingest_date=2024-01-02"}
    back = tables.read_table(spark, path, HISTORY_SCHEMA)
    assert {(r._id, str(r.ingest_date), r.extra["note"]) for r in back.collect()} == {
        ("a", "2024-01-01", '"n"'), ("b", "2024-01-01", '"n"'), ("c", "2024-01-02", '"n"')}


def test_existing_archive_is_kept(spark, exported):
    path, both = exported
    with pytest.raises(Exception, match="already exists"):
        archive.export_archive(both, path, "flights")
