"""Latest-state rules against sequential folds, with chunks small enough to matter."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from airlane.operators import history, latest, sequence
from airlane.schemas import OPTIONAL_FIELDS

T0 = datetime(2024, 1, 1)
FIELDS = ["callsign", "origin_country"]


def random_events(n, seed, keys=6):
    """Events of a few aircraft, one of them holding a third, with many equal times."""
    pick = random.Random(seed)
    rows = []
    for offset in range(n):
        key = "aaaaaa" if pick.random() < 1 / 3 else f"00000{pick.randrange(keys)}"
        has = {f: pick.random() < 0.6 for f in FIELDS}
        value = {f: pick.choice([None, f"{f}{offset}"]) if has[f] else None for f in FIELDS}
        rows.append({
            "icao24": key, "observed_at": T0 + timedelta(seconds=pick.randrange(n // 2)),
            "ingested_at": T0, "latitude": float(offset), "longitude": 0.0,
            "kafka_topic": "t", "kafka_partition": 0, "kafka_offset": offset,
            "present": {f: has.get(f, False) for f in OPTIONAL_FIELDS}, **value,
        })
    return rows


SCHEMA = (
    "icao24 STRING, observed_at TIMESTAMP_NTZ, ingested_at TIMESTAMP_NTZ, latitude DOUBLE, "
    "longitude DOUBLE, kafka_topic STRING, kafka_partition INT, kafka_offset BIGINT, present "
    f"STRUCT<{','.join(f + ': BOOLEAN' for f in OPTIONAL_FIELDS)}>, callsign STRING, "
    "origin_country STRING"
)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def fold_replace(rows):
    state = {}
    for row in rows:
        if row["icao24"] not in state or (
            state[row["icao24"]]["observed_at"] < row["observed_at"]
        ):
            state[row["icao24"]] = row
    return state


def fold_merge(rows):
    state = {}
    for row in rows:
        old = state.get(row["icao24"])
        if old is None or old["observed_at"] < row["observed_at"]:
            new = dict(old or dict.fromkeys(FIELDS))
            new.update({k: row[k] for k in ("observed_at", "latitude", "kafka_offset")})
            new.update({f: row[f] for f in FIELDS if row["present"][f]})
            state[row["icao24"]] = new
    return state


@pytest.mark.parametrize("seed", [1, 2])
def test_replace_rule(spark, seed):
    rows = random_events(600, seed)
    found = {r.icao24: r.kafka_offset for r in latest.live(frame(spark, rows)).collect()}
    assert found == {k: v["kafka_offset"] for k, v in fold_replace(rows).items()}


@pytest.mark.parametrize("seed, chunk", [(1, 7), (2, 50), (3, 10_000)])
def test_merge_rule(spark, seed, chunk):
    rows = random_events(600, seed)
    merged = latest.live_merged(frame(spark, rows), FIELDS, chunk).collect()
    found = {r.icao24: {k: r[k] for k in ("observed_at", "latitude", "kafka_offset", *FIELDS)}
             for r in merged}
    assert found == fold_merge(rows)


def test_late_events(spark):
    rows = random_events(500, 4)
    newest, late = {}, set()
    for row in rows:
        before = newest.get(row["icao24"])
        if before is not None and row["observed_at"] < before:
            late.add(row["kafka_offset"])
        newest[row["icao24"]] = max(before or row["observed_at"], row["observed_at"])
    found = history.late_events(frame(spark, rows), 13).collect()
    assert {r.kafka_offset for r in found} == late


@pytest.mark.parametrize("aggregate, python", [(F.max, max), (F.min, min), (F.sum, sum)])
def test_running_before(spark, aggregate, python):
    pick = random.Random(5)
    rows = [(pick.choice("ab"), i, pick.randrange(100)) for i in range(300)]
    data = spark.createDataFrame(rows, "k STRING, i BIGINT, v BIGINT").withColumn(
        "c", sequence.offset_chunk(F.col("i"), 9))
    for descending in (False, True):
        order = [F.desc("i") if descending else F.asc("i")]
        found = sequence.running_before(
            data, ["k"], ["c"], order, F.col("v"), aggregate, "before", descending)
        for k, i, before in [(r.k, r.i, r.before) for r in found.collect()]:
            seen = [v for k2, j, v in rows
                    if k2 == k and (j > i if descending else j < i)]
            assert before == (python(seen) if seen else None)


def test_previous_row(spark):
    pick = random.Random(6)
    rows = [(pick.choice("ab"), i, pick.choice([None, i])) for i in range(200)]
    data = spark.createDataFrame(rows, "k STRING, i BIGINT, v BIGINT").withColumn(
        "c", sequence.offset_chunk(F.col("i"), 7))
    found = sequence.previous(data, ["k"], ["c"], ["i"], ["i", "v"], "p").collect()
    for row in found:
        before = [(i, v) for k, i, v in rows if k == row.k and i < row.i]
        assert (tuple(row.p) if row.p else None) == (before[-1] if before else None)


def test_first_arrival_wins(spark):
    rows = [("a", 0, 5, "late"), ("a", 0, 2, "first"), ("b", 1, 9, "only")] + [
        ("a", 0, 100 + i, "copy") for i in range(200)]
    data = spark.createDataFrame(
        rows, "_id STRING, kafka_partition INT, kafka_offset BIGINT, what STRING")
    found = {r._id: r.what for r in history.first_arrivals(data).collect()}
    assert found == {"a": "first", "b": "only"}


def updates(spark, *rows):
    return spark.createDataFrame(
        rows, "icao24 STRING, observed_at TIMESTAMP_NTZ, kafka_offset BIGINT, source STRING")


@pytest.mark.parametrize("current, update, accepted", [
    ((T0, 100), (T0 - timedelta(minutes=1), 99), False),
    ((T0, 100), (T0, 101), True),
    ((T0, 100), (T0, 100), True),
    ((T0, 100), (T0, 99), False),
    ((T0, 100), (T0 + timedelta(seconds=1), 1), True),
    ((None, 5), (None, 5), True),
    ((None, None), (None, 0), True),
    ((T0, 1), (None, 9), False),
])
def test_feed_rule(spark, current, update, accepted):
    merged = latest.merge_feed(
        updates(spark, ("a", *current, "snapshot")), updates(spark, ("a", *update, "update")))
    assert merged.first().source == ("update" if accepted else "snapshot")


def test_feed_without_snapshot_row(spark):
    merged = latest.merge_feed(updates(spark), updates(spark, ("a", None, None, "update")))
    assert merged.count() == 1


def test_unknown_tie_rule():
    with pytest.raises(ValueError):
        latest.recency("middle")


def test_carry_and_window_share_one_shuffle(spark):
    """Of the wide rows: one exchange by key and chunk, however the carry is joined."""
    from airlane.operators.sequence import running_before

    rows = spark.range(1000).selectExpr("id % 7 AS k", "id DIV 100 AS c", "id AS o", "repeat('x', 50) AS wide", "id AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = running_before(rows, ["k"], ["c"], [F.col("o")], F.col("v"), F.max, "before")
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Rows, the chunk summaries, their window and its join: the rows are dealt once.
    assert plan.count("Exchange hashpartitioning(_key") == 2
    assert plan.index("Window") < plan.index("SortMergeJoin") < plan.index("Exchange")


@pytest.mark.parametrize("name", ["export_rows", "table_counts"])
def test_both_tables_share_one_parse(spark, tmp_path, name):
    """Messages are parsed before the two tables part, once; each message of the small log still counts in both."""
    import __spark_entry__ as entry

    events = spark.createDataFrame(
        [(i, datetime(2024, 1, 1, 0, i), i % 2, "view", 1.0, '{"k": 1}') for i in range(20, 30)],
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING")
    events.write.parquet(f"{tmp_path}/events.parquet")
    found = entry.queries()[name](spark, str(tmp_path))
    assert "parseJson" not in found._jdf.queryExecution().optimizedPlan().toString()
    if name == "table_counts":
        assert {r.table: r.rows for r in found.collect()} == {"raw_positions": 10, "live_positions": 2, "*": 12}
    else:
        newest = {(r.collection, r._id, r.kafka_offset, r.observed_at) for r in found.collect()}
        assert len(newest) == 12 and ("live_positions", "000001", 58, "2024-01-01T00:29:00.000") in newest
