import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from airlane.operators import metrics, retention

T0 = datetime(2024, 1, 1)


def samples(spark, rows, metric="c"):
    return spark.createDataFrame(
        [(T0 + timedelta(seconds=s), metric, labels, float(v)) for s, labels, v in rows],
        "ts TIMESTAMP_NTZ, metric STRING, labels MAP<STRING,STRING>, value DOUBLE")


def test_increase_counts_restarts(spark):
    rows = samples(spark, [(0, {"p": "a"}, 10), (60, {"p": "a"}, 15), (120, {"p": "a"}, 3),
                           (310, {"p": "a"}, 8), (0, {"p": "b"}, 100), (400, {"p": "b"}, 101)])
    found = {(r.p, r.window_start): r.increase
             for r in metrics.increase_by(rows, ["p"], 5).collect()}
    five = T0 + timedelta(minutes=5)
    assert found == {("a", T0): 8.0, ("a", five): 5.0, ("b", T0): 0.0, ("b", five): 1.0}


@pytest.mark.parametrize("chunk", [1, 2, 72])
def test_increase_against_fold(spark, chunk):
    pick = random.Random(chunk)
    rows = [(s, {"p": pick.choice("ab"), "q": "x"}, pick.randrange(50)) for s in
            sorted(pick.sample(range(9000), 400))]
    expected, last = {}, {}
    for s, labels, v in rows:
        key = (labels["p"], T0 + timedelta(seconds=s // 300 * 300))
        before = last.get(labels["p"])
        grown = 0 if before is None else v if v < before else v - before
        expected[key] = expected.get(key, 0) + grown
        last[labels["p"]] = v
    found = metrics.increases(samples(spark, rows).repartition(4), 5, windows_per_chunk=chunk)
    assert {(r.labels["p"], r.window_start): r.increase for r in found.collect()} == expected


def test_label_order_is_no_identity(spark):
    rows = samples(spark, [(0, {"a": "1", "b": "2"}, 1), (10, {"b": "2", "a": "1"}, 4)])
    assert metrics.increase_by(rows, []).first().increase == 3.0


def test_matchers(spark):
    rows = samples(spark, [(0, {"pod": "job-init-1", "c": ""}, 1), (0, {"pod": "job-init"}, 1),
                           (0, {"pod": "api"}, 1), (0, {}, 1)])
    pick = lambda **m: metrics.select_series(rows, "c", **m).count()
    assert pick(not_matching={"pod": "job-init-.*"}) == 3
    assert pick(not_matching={"pod": "init"}) == 4
    assert pick(equals={"pod": ""}) == 1
    assert pick(not_equals={"c": ""}) == 0
    assert metrics.select_series(rows, "other").count() == 0


def test_latest_within_lookback(spark):
    rows = samples(spark, [(0, {"p": "a"}, 9), (290, {"p": "a"}, 1), (0, {"p": "b"}, 5),
                           (301, {"p": "c"}, 7)])
    now = T0 + timedelta(seconds=300)
    found = metrics.latest_samples(rows, now).collect()
    assert {r.labels["p"]: r.value for r in found} == {"a": 1.0}


def buckets(spark, *rows):
    return spark.createDataFrame(rows, "g STRING, le STRING, rate DOUBLE")


@pytest.mark.parametrize("rows, expected", [
    ([("0.1", 0.0), ("0.5", 10.0), ("+Inf", 10.0)], 0.1 + 0.4 * 0.95),
    ([("0.1", 10.0), ("+Inf", 10.0)], 0.095),
    ([("0.1", 1.0), ("0.5", 2.0), ("+Inf", 100.0)], 0.5),
    ([("0.1", 0.0), ("+Inf", 0.0)], None),
    ([("0.1", 5.0), ("0.5", 5.0)], None),
    ([("0.1", 5.0), ("0.5", 4.0), ("+Inf", 5.0)], 0.095),
])
def test_quantile(spark, rows, expected):
    frame = buckets(spark, *(("x", le, v) for le, v in rows))
    found = metrics.histogram_quantile(0.95, frame, ["g"]).first().quantile
    assert found == (pytest.approx(expected) if expected is not None else None)


def test_latency_buckets_are_cumulative(spark):
    rows = spark.createDataFrame(
        [("GET", "/a", d) for d in (0.05, 0.2, 3.0, 11.0)],
        "method STRING, route STRING, duration_s DOUBLE")
    found = {r.le: r.cumulative_count for r in metrics.latency_histogram(rows).collect()}
    assert found == {"0.05": 1, "0.1": 1, "0.25": 2, "0.5": 2, "1.0": 2, "2.5": 2, "5.0": 3,
                     "10.0": 3, "+Inf": 4}


def test_ratio_and_busy(spark):
    a = samples(spark, [(0, {}, 25), (1, {}, 1), (2, {}, 1)], "a")
    b = samples(spark, [(0, {}, 100), (1, {}, 0)], "b")
    found = {r.ts: r.percent
             for r in metrics.percent_used(a.union(b), "a", "b", ["ts"]).collect()}
    assert found == {T0: 75.0, T0 + timedelta(seconds=1): None}
    a = samples(spark, [(0, {"d": "x"}, 10), (0, {"d": "y"}, 90)], "a")
    b = samples(spark, [(0, {"d": "x"}, 100), (0, {"d": "y"}, 100)], "b")
    assert sorted(r.percent for r in metrics.percent_used(a.union(b), "a", "b").collect()) == pytest.approx([10, 90])
    with pytest.raises(Exception, match="several series"):
        metrics.percent_used(a.union(b), "a", "b", ["ts"]).collect()
    idle = samples(spark, [(0, {"i": "n"}, 0), (240, {"i": "n"}, 150)])
    assert metrics.percent_busy(idle, ["i"]).first().percent == 50.0


def log(spark, rows):
    return spark.createDataFrame(
        [("t", p, o, T0 + timedelta(hours=h), n) for p, o, h, n in rows],
        "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP_NTZ, size BIGINT")


@pytest.mark.parametrize("chunk", [1, 7, 1000])
@pytest.mark.parametrize("budget", [0, 99, 1000, 10**9])
def test_size_retention_against_fold(spark, chunk, budget):
    pick = random.Random(chunk)
    rows = [(pick.choice([0, 0, 1]), o, 0, pick.randrange(1, 40)) for o in range(150)]
    expected, used = set(), {}
    for p, o, _, size in reversed(rows):
        used[p] = used.get(p, 0) + size
        if used[p] <= budget:
            expected.add(o)
    found = retention.retain_by_size(log(spark, rows), budget, chunk_size=chunk)
    assert {r.offset for r in found.collect()} == expected


def test_size_retention_joins_nothing(spark):
    """Old rows leave by a filter on the scan: only the last range of a partition is ordered."""
    kept = retention.retain_by_size(log(spark, [(0, i, i, 10) for i in range(10)]), 45, chunk_size=2)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.splitlines()[1].startswith(":- Filter")


def test_age_or_size_whichever_first(spark):
    rows = log(spark, [(0, i, i, 10) for i in range(10)])
    now = T0 + timedelta(hours=9)
    kept = lambda h, b: retention.retain_log(rows, now, h, b).count()
    assert (kept(100, 10**6), kept(2, 10**6), kept(100, 45), kept(2, 25)) == (10, 3, 4, 2)


def test_age_retention(spark):
    rows = spark.createDataFrame(
        [(1, T0), (2, T0 + timedelta(milliseconds=1)), (3, None)],
        "id INT, ingested_at TIMESTAMP_NTZ")
    kept = retention.retain_by_age(rows, T0 + timedelta(hours=48))
    assert sorted(r.id for r in kept.collect()) == [2, 3]


def test_next_offsets(spark):
    rows = log(spark, [(0, 3, 0, 1), (0, 5, 0, 1), (1, 2, 0, 1)])
    found = retention.next_offsets(rows, "topic", "partition", "offset").collect()
    assert {(r.partition, r.next_offset) for r in found} == {(0, 6), (1, 3)}


def test_lag(spark):
    committed = spark.createDataFrame(
        [("t", 0, 5), ("t", 1, -1), ("t", 2, 9)],
        "topic STRING, partition INT, committed_offset BIGINT")
    newest = spark.createDataFrame(
        [("t", 0, 8), ("t", 1, 4), ("t", 2, 7), ("u", 0, 50)],
        "topic STRING, partition INT, latest_offset BIGINT")
    lag = retention.consumer_lag(committed, newest)
    assert {r.partition: r.lag for r in lag.collect()} == {0: 3, 1: 4, 2: 0}
    assert retention.total_lag(lag).first().asDict() == {"total_lag": 7, "partitions": 3}
    assert retention.total_lag(lag.limit(0)).first().total_lag == 0


def test_request_counts(spark):
    rows = spark.createDataFrame(
        [("GET", "/a", "200")] * 3 + [("GET", "/a", "500")],
        "method STRING, route STRING, status_code STRING")
    found = {r.status_code: r.requests for r in metrics.request_counts(rows).collect()}
    assert found == {"200": 3, "500": 1}
    assert metrics.by_label(samples(spark, [(0, {}, 2), (0, {}, 3)]), [], F.sum).first()[0] == 5.0


def test_ratio_of_repeated_events(spark, tmp_path):
    """Events of one time and route, of one series, and whole events that repeat: a row each, with its own value."""
    import __spark_entry__ as entry

    second = T0 + timedelta(seconds=1)
    rows = [(1, T0, 4, "view", 5.0), (2, T0, 4, "view", 7.0), (2, T0, 4, "view", 7.0), (2, T0, 8, "view", 7.0),
            (3, T0, 5, "view", 1.0), (None, T0, 5, "view", 1.5), (4, T0, 5, "click", 1.0), (5, second, 5, "view", 9.0)]
    events = spark.createDataFrame([(*row, '{"k": 1}') for row in rows],
                                   "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING")
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    found = entry.queries()["metric_ratio"](spark, str(tmp_path))
    assert found.columns == ["ts", "route", "percent"]
    assert sorted(map(tuple, found.collect())) == sorted(
        (ts, route, round(100 * (1 - v / (v * 1000 + 1)), 9)) for _, ts, _, route, v in rows)
