"""Rewriting closed dates: same rows for every reader, disjoint aircraft ranges, nothing lost on the way."""

from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from airlane.schemas import HISTORY_SCHEMA, STORED_SCHEMA
from airlane.sources import compaction, manifest, storage, tables

DAY = date(2024, 1, 10)
NOON = datetime(2024, 1, 10, 12)
LATER, EARLIER = datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(hours=1), datetime(2000, 1, 1)


def batch(spark, start, n=40, day=NOON, hot=False):
    """History rows of one micro-batch: aircraft spread over all files, a third of them of one aircraft when hot."""
    rows = [{"_id": f"id-{start + i:06d}", "icao24": "0000aa" if hot and i % 3 == 0 else f"{(start + i) * 7919 % 4096:06x}",
             "observed_at": day + timedelta(seconds=i % 7), "ingested_at": day, "kafka_offset": start + i,
             "extra": {"note": f'"{start + i}"'}} for i in range(n)]
    schema = [f for f in HISTORY_SCHEMA if f.name != "ingest_date"]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], type(HISTORY_SCHEMA)(schema))


def stored(spark, path, schema=HISTORY_SCHEMA):
    return sorted(map(str, tables.read_table(spark, path, schema).collect()))


def filled(spark, tmp_path, batches=4, **how):
    path = str(tmp_path / "history")
    for k in range(batches):
        tables.append_history(batch(spark, 100 * k, **how), path)
    return path


def parts(path, directory="ingest_date=2024-01-10"):
    return sorted(Path(path, directory).glob("part-*.parquet")), sorted(Path(path, "_compacted", directory).glob("part-*.parquet"))


@pytest.mark.parametrize("hot", [False, True])
def test_aircraft_ranges_of_rewritten_files_do_not_overlap(spark, tmp_path, hot):
    path = filled(spark, tmp_path, hot=hot)
    before = stored(spark, path)
    size = sum(f.stat().st_size for f in parts(path)[0])
    assert compaction.compact_closed(spark, path, DAY) == []  # the date is not closed yet
    assert compaction.compact_closed(spark, path, DAY + timedelta(days=1), file_bytes=size // 4) == ["2024-01-10"]
    ranges = []
    for file in parts(path)[1]:
        told = pq.read_metadata(file)
        at = told.schema.names.index("icao24")
        ranges += [(s.min, s.max) for s in (told.row_group(g).column(at).statistics for g in range(told.num_row_groups))]
    assert len(ranges) >= 3
    for (_, high), (low, _) in zip(sorted(ranges), sorted(ranges)[1:]):
        assert high <= low  # one aircraft may end a file and begin the next
    assert stored(spark, path) == before and len(stored(spark, path, STORED_SCHEMA)) == 160
    assert compaction.compact_closed(spark, path, DAY + timedelta(days=1)) == []  # nothing new to fold


def test_readers_and_appends_meanwhile_lose_nothing(spark, tmp_path, monkeypatch):
    path = filled(spark, tmp_path, 2)
    opened = tables.read_table(spark, path)
    commit = manifest.commit

    def late(*args):
        tables.append_history(batch(spark, 500, 5), path)  # lands between the rewriting and the switch
        commit(*args)

    monkeypatch.setattr(manifest, "commit", late)
    assert compaction.compact_date(spark, path, DAY)
    assert opened.count() == 80 and len(stored(spark, path)) == 85
    assert compaction.drop_replaced(spark, path, EARLIER) == 0 and opened.count() == 80
    monkeypatch.setattr(manifest, "commit", commit)
    gone = len(parts(path)[0]) - 1
    assert compaction.drop_replaced(spark, path, LATER) >= gone >= 1
    assert len(stored(spark, path)) == 85 and len(parts(path)[0]) == 1


def test_ids_in_rewritten_files_are_known(spark, tmp_path):
    path = filled(spark, tmp_path, 3)
    compaction.compact_date(spark, path, DAY)
    compaction.drop_replaced(spark, path, LATER)
    tables.append_history(batch(spark, 0, 45), path)  # 40 of them are stored
    assert len(stored(spark, path)) == 125
    assert compaction.compact_date(spark, path, DAY)
    tables.append_history(batch(spark, 0, 45), path)
    assert len(stored(spark, path)) == 125
    compaction.drop_replaced(spark, path, LATER)
    assert len(stored(spark, path)) == 125 and manifest.numbers(spark, path) == {"ingest_date=2024-01-10": [2]}


def test_interrupted_rewriting_changes_nothing(spark, tmp_path, monkeypatch):
    path = filled(spark, tmp_path, 2)
    before = stored(spark, path)
    with monkeypatch.context() as broken:
        broken.setattr(manifest, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            compaction.compact_date(spark, path, DAY)
    assert stored(spark, path) == before and parts(path)[1]
    assert compaction.compact_date(spark, path, DAY) and stored(spark, path) == before
    compaction.drop_replaced(spark, path, LATER)  # takes the files of the broken one, too
    assert stored(spark, path) == before and len(parts(path)[1]) == 1 and not parts(path)[0]
    with pytest.raises(FileExistsError):
        manifest.commit(spark, path, tables.date_directory(DAY), manifest.Manifest(1, [], []))


def test_rewritten_dates_expire(spark, tmp_path):
    path = filled(spark, tmp_path, 2)
    tables.append_history(batch(spark, 900, day=NOON + timedelta(days=3)), path)
    tables.append_history(batch(spark, 950, 3).withColumn("ingested_at", F.lit(None).cast("timestamp_ntz")), path)
    assert compaction.compact_closed(spark, path, date(2024, 2, 1)) == ["2024-01-10"]
    assert tables.drop_expired(spark, path, datetime(2024, 1, 13)) == ["2024-01-10"]
    assert len(stored(spark, path)) == 43 and not parts(path)[1] and manifest.numbers(spark, path) == {}
    assert not storage.exists(spark, f"{path}/ingest_date=2024-01-10")


def test_filters_reach_both_kinds_of_files(spark, tmp_path, capsys):
    path = filled(spark, tmp_path, 2)
    compaction.compact_date(spark, path, DAY)
    tables.append_history(batch(spark, 700, 3), path)
    tables.read_table(spark, path).where("icao24 = '0000aa'").select("icao24", "observed_at").explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("EqualTo(icao24,0000aa)") == 2
    assert plan.count("ReadSchema: struct<icao24:string,observed_at:timestamp_ntz>") == 2
