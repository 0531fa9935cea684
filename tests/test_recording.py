"""Counter summaries: they merge associatively, give what the samples give, and are stored span by span."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest

from airlane.operators import metrics, recording

T0 = datetime(2024, 1, 1)
SCHEMA = "ts TIMESTAMP_NTZ, metric STRING, labels MAP<STRING,STRING>, value DOUBLE"


def samples(spark, rows):
    told = [(T0 + timedelta(seconds=s), "c", labels, None if v is None else float(v)) for s, labels, v in rows]
    return spark.createDataFrame(told, SCHEMA)


def some(seed, n=500, until=4 * 3600):
    """Restarting counters; one series holds a third of the samples, gaps span windows."""
    pick = random.Random(seed)
    at = [s for s in sorted(pick.sample(range(until), n)) if not 5000 < s < 9000]
    return [(s, {"p": "hot"} if pick.random() < 0.34 else {"p": pick.choice("abc"), "q": "x"}, pick.randrange(60)) for s in at]


def told(frame):
    return sorted((str(r.series), r.slot_start, r.first_ts, r.first, r.last_ts, r.last, r.growth) for r in frame.collect())


def grown(frame):
    return sorted((sorted(r.labels.items()), r.window_start, r.increase) for r in frame.collect())


@pytest.mark.parametrize("window, chunk", [(5, 1440), (60, 60), (5, 5)])
def test_windows_from_summaries_equal_windows_from_samples(spark, window, chunk):
    rows = samples(spark, some(window + chunk)).repartition(5).persist()
    kept = recording.summaries(rows)
    assert grown(recording.increases(kept, window, chunk)) == grown(metrics.increases(rows, window))
    assert grown(recording.increases(recording.merge(kept, 5), window, chunk)) == grown(metrics.increases(rows, window))


def test_merge_is_associative(spark):
    rows = samples(spark, some(1)).persist()
    minutes = recording.summaries(rows).persist()
    hours = told(recording.merge(minutes, 60))
    assert hours == told(recording.merge(recording.merge(minutes, 5), 60)) == told(recording.merge(recording.merge(minutes, 20), 60))
    assert hours == told(recording.summaries(rows, 60))


def test_spans_are_recorded_alone_and_replaced(spark, tmp_path, capsys):
    rows, path, raw = some(2, 200, 1800), str(tmp_path / "rules"), str(tmp_path / "samples")
    late = (601, {"p": "late"}, 7)
    samples(spark, rows).write.parquet(raw)
    told_by = lambda: spark.read.schema(SCHEMA).parquet(raw)
    at = lambda m: T0 + timedelta(minutes=m)
    for minute in (0, 10, 20):
        recording.record(told_by(), path, at(minute), at(minute + 10))
    assert grown(recording.increases(recording.recorded(spark, path))) == grown(metrics.increases(told_by()))
    samples(spark, [late]).write.mode("append").parquet(raw)
    for _ in range(2):
        recording.record(told_by(), path, at(10), at(20))
    assert grown(recording.increases(recording.recorded(spark, path))) == grown(metrics.increases(told_by()))
    (Path(path) / f"span={recording._ms(at(0))}_{recording._ms(at(10))}" / "part-broken.parquet").write_bytes(b"no parquet")
    assert {r.slot_start for r in recording.recorded(spark, path, at(20), at(25)).collect()} >= {at(20)}  # others stay closed
    recording.summaries(told_by().where("ts >= TIMESTAMP_NTZ'2024-01-01 00:10:00'")).explain("formatted")
    assert "GreaterThanOrEqual(ts,2024-01-01T00:10)" in capsys.readouterr().out
    with pytest.raises(ValueError, match="overlaps"):
        recording.record(told_by(), path, at(5), at(15))
    with pytest.raises(ValueError, match="whole slots"):
        recording.record(told_by(), path, at(30), at(30) + timedelta(seconds=30))


def test_edges(spark, tmp_path):
    rows = samples(spark, [(0, {"p": "a"}, None), (5, {"p": "a"}, 3), (5, {"p": "a"}, 3), (70, {"p": "a"}, 3), (9, None, 4)])
    assert sorted((r.first, r.last, r.growth) for r in recording.summaries(rows).collect()) == [(3, 3, 0), (3, 3, 0), (4, 4, 0)]
    assert recording.increases(recording.recorded(spark, str(tmp_path / "none"))).count() == 0
    assert recording.merge(recording.summaries(rows.limit(0)), 5).count() == 0
