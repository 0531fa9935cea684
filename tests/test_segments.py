"""Segments of the stored log: whole files go, the newest bytes stay, readers see whole partitions' ends."""

import random
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from airlane.operators import retention
from airlane.schemas import MESSAGE_SCHEMA
from airlane.sources import segments

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
NOW = datetime(2024, 1, 1, 12)


def log(spark, rows):
    """Messages from ``(topic, partition, offset, hours, size)``; the value has that size."""
    return spark.createDataFrame([(b"", b"x" * n, t, p, o, T0 + timedelta(hours=h), 1, []) for t, p, o, h, n in rows], MESSAGE_SCHEMA)


def stored(spark, path):
    return sorted((r.topic, r.partition, r.offset) for r in segments.read(spark, path).select("topic", "partition", "offset").collect())


def data(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).glob("append=*/**/*.parquet"))


def test_size_retention_frees_whole_files_and_keeps_the_newest_bytes(spark, tmp_path):
    pick, path = random.Random(4), str(tmp_path / "log")
    rows = [("a:b/c d", pick.choice([0, 0, 1]), o, 0, pick.randrange(1, 40)) for o in range(240)]
    for number in range(4):
        segments.append(log(spark, rows[60 * number:60 * number + 60]), path, number, F.octet_length("value"), offsets=20)
    assert stored(spark, path) == sorted(r[:3] for r in rows)
    opened = segments.read(spark, path)
    before, told = data(path), segments.segments(spark, path).collect()
    assert len(before) == len(told) and sum(s.rows for s in told) == 240 and sum(s.bytes for s in told) == sum(r[4] for r in rows)
    budget = 900
    starts = segments.retain(spark, path, NOW, budget)
    assert opened.count() == 240 and data(path) == before  # nothing is deleted yet
    sized = log(spark, rows).withColumn("size", F.octet_length("value").cast("bigint"))
    exact = {(r.topic, r.partition, r.offset) for r in retention.retain_by_size(sized, budget).collect()}
    kept = stored(spark, path)
    assert exact < set(kept) < {r[:3] for r in rows}
    for place, start in starts.items():
        oldest = min((s for s in told if (s.topic, s.partition) == place and s.last >= start), key=lambda s: s.first)
        assert oldest.first == start  # whole segments only
        assert {k for k in kept if k[:2] == place and k[2] > oldest.last} <= exact  # one segment more at most
    assert segments.free(spark, path) > 0
    left = data(path)
    assert set(left) < set(before) and len(left) == sum(s.last >= starts[s.topic, s.partition] for s in told)
    assert stored(spark, path) == kept and segments.free(spark, path) == 0
    assert 0 not in segments.appends(spark, path)  # its last file went
    assert segments.retain(spark, path, NOW, budget) == starts and segments.retain(spark, path, NOW, 10**9) == starts


def test_age_or_size_whichever_first(spark, tmp_path):
    path = str(tmp_path / "log")
    segments.append(log(spark, [("t", 0, i, i, 10) for i in range(10)]), path, 0, F.octet_length("value"), offsets=2)
    assert segments.retain(spark, path, NOW, 10**6, 100) == {("t", 0): 0}
    assert segments.retain(spark, path, NOW, 10**6, 7) == {("t", 0): 4}  # offsets 4 and 5: one of them is young
    assert segments.retain(spark, path, NOW, 35, 100) == {("t", 0): 6}
    assert stored(spark, path) == [("t", 0, o) for o in range(6, 10)]
    assert segments.retain(spark, path, NOW + timedelta(hours=99), 35, 1) == {("t", 0): 10}
    assert stored(spark, path) == [] and segments.free(spark, path) > 0 and data(path) == []
    segments.append(log(spark, [("t", 0, 10, 0, 5), ("t", 1, 3, 0, 5)]), path, 1)
    assert stored(spark, path) == [("t", 0, 10), ("t", 1, 3)]


def test_repeated_and_broken_appends(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    first = log(spark, [("t", 0, i, 0, 3) for i in range(5)])
    for _ in range(2):
        segments.append(first, path, 0)
    assert len(stored(spark, path)) == 5
    segments.append(log(spark, [("t", 0, i, 0, 3) for i in range(5, 9)]), path, 1)
    (Path(path) / "_segments" / "append=1" / "_SUCCESS").unlink()  # as if the append had not committed
    assert len(stored(spark, path)) == 5 and segments.segments(spark, path).agg(F.sum("rows")).first()[0] == 5
    segments.append(first.limit(0), path, 2)  # an empty batch
    assert len(stored(spark, path)) == 5


@pytest.mark.parametrize("budget", [0, 1])
def test_edges(spark, tmp_path, budget):
    path = str(tmp_path / "log")
    assert stored(spark, path) == [] and segments.retain(spark, path, NOW) == {} and segments.free(spark, path) == 0
    nulls = spark.createDataFrame([(None, None, "t", 0, 0, T0, 1, None), (b"k", None, "t", 0, 1, T0, 1, None)], MESSAGE_SCHEMA)
    segments.append(nulls, path, 0, offsets=1)
    assert sorted(s.bytes for s in segments.segments(spark, path).collect()) == [0, 1]
    assert segments.retain(spark, path, NOW, budget) == {("t", 0): 2 - budget}
