"""Queries over metric samples derived from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from airlane.operators import metrics, recording
from airlane.plans import views
from airlane.plans.registry import query
from airlane.sources import tables

_AS_OF = "(SELECT max(ts) FROM events)"

#: Growth of the counter per series and window, with restarts, over five minutes.
_INCREASES = """
labelled AS (
    SELECT ts, event_type AS route,
           CASE WHEN user_id % 10 = 0 THEN '500' ELSE '200' END AS status_code,
           'pod-' || CAST(user_id % 4 AS VARCHAR) AS pod,
           {counter} AS v
    FROM events),
stepped AS (
    SELECT *, lag(v) OVER (PARTITION BY route, status_code, pod ORDER BY ts) AS before
    FROM labelled),
grown AS (
    SELECT time_bucket(INTERVAL {minutes} MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start,
           route, status_code, pod,
           CASE WHEN before IS NULL THEN 0 WHEN v < before THEN v ELSE v - before END AS growth
    FROM stepped)
"""


def _counter(spark, sf_dir):
    return metrics.select_series(views.samples(spark, sf_dir), "http_requests_total")


@query(
    f"""
WITH labelled AS (
    SELECT ts, value, event_type AS route, user_id % 10 = 0 AS failed, user_id % 4 AS pod
    FROM events WHERE ts > {_AS_OF} - INTERVAL 1 DAY),
newest AS (
    SELECT *, row_number() OVER (PARTITION BY route, failed, pod ORDER BY ts DESC) AS rn
    FROM labelled)
SELECT max(value) AS value FROM newest WHERE rn = 1
"""
)
def metric_latest_max(spark, sf_dir):
    """Greatest current value of a gauge over its series."""
    gauge = metrics.select_series(views.samples(spark, sf_dir), "freshness_seconds")
    as_of = views.newest(views.table(spark, sf_dir, "events"), "ts")
    return metrics.by_label(metrics.latest_samples(gauge, as_of, 1440), [], F.max)


@query(
    f"""
WITH labelled AS (
    SELECT ts, value * 1000 + 1 AS value, event_type AS route, user_id % 10 = 0 AS failed,
           user_id % 4 AS pod
    FROM events WHERE ts > {_AS_OF} - INTERVAL 1 DAY),
newest AS (
    SELECT *, row_number() OVER (PARTITION BY route, failed, pod ORDER BY ts DESC) AS rn
    FROM labelled)
SELECT 'pod-' || CAST(pod AS VARCHAR) AS pod, round(sum(value), 6) AS value
FROM newest WHERE rn = 1 GROUP BY 1
"""
)
def gauge_sum_by_pod(spark, sf_dir):
    """Current sum of a gauge per pod."""
    gauge = metrics.select_series(views.samples(spark, sf_dir), "memory_bytes")
    as_of = views.newest(views.table(spark, sf_dir, "events"), "ts")
    current = metrics.latest_samples(gauge, as_of, 1440)
    return metrics.by_label(current, ["pod"], F.sum).select(
        "pod", F.round("value", 6).alias("value")
    )


@query(
    f"""
WITH {_INCREASES.format(counter=views.COUNTER, minutes=5)}
SELECT window_start, route, status_code, round(sum(growth) / 300, 9) AS rate
FROM grown GROUP BY ALL
"""
)
def counter_rate_by_label(spark, sf_dir):
    """Request rate per route and status in five-minute windows."""
    rows = metrics.rate_by(_counter(spark, sf_dir), ["route", "status_code"])
    return rows.withColumn("rate", F.round("rate", 9))


@query(
    f"""
WITH {_INCREASES.format(counter=views.COUNTER, minutes=60)}
SELECT window_start, pod, sum(growth) AS increase FROM grown GROUP BY ALL
"""
)
def counter_increase_1h(spark, sf_dir):
    """Counter growth per pod in one-hour windows."""
    return metrics.increase_by(_counter(spark, sf_dir), ["pod"], 60)


@query(
    f"""
WITH {_INCREASES.format(counter=views.COUNTER, minutes=5)}
SELECT window_start, route, status_code, round(sum(growth) / 300, 9) AS rate
FROM grown GROUP BY ALL
"""
)
def recorded_rate_by_label(spark, sf_dir):
    """Request rate in five-minute windows, from stored minute summaries."""
    kept = tables.staged(recording.summaries(_counter(spark, sf_dir)), "minutes")
    rows = metrics.by_label(recording.rates(kept), ["route", "status_code"], F.sum, "rate", ["window_start"])
    return rows.withColumn("rate", F.round("rate", 9))


@query(
    f"""
WITH {_INCREASES.format(counter=views.COUNTER, minutes=60)}
SELECT window_start, pod, sum(growth) AS increase FROM grown GROUP BY ALL
"""
)
def recorded_increase_1h(spark, sf_dir):
    """Counter growth per pod in one-hour windows, from minute summaries merged to ten minutes."""
    kept = tables.staged(recording.summaries(_counter(spark, sf_dir)), "minutes")
    grown = recording.increases(recording.merge(kept, 10), 60)
    return metrics.by_label(grown, ["pod"], F.sum, "increase", ["window_start"])


@query(
    f"""
WITH {_INCREASES.format(counter=views.COUNTER, minutes=5)},
series AS (
    SELECT window_start, route, status_code, pod, sum(growth) / 300 AS rate
    FROM grown GROUP BY ALL)
SELECT window_start, pod, round(100 * (1 - avg(rate)), 6) AS percent FROM series GROUP BY ALL
"""
)
def cpu_busy_percent(spark, sf_dir):
    """Busy share per pod from an idle counter."""
    rows = metrics.percent_busy(_counter(spark, sf_dir), ["pod"])
    return rows.withColumn("percent", F.round("percent", 6))


@query(
    f"""
WITH {views.BUCKETS_SQL},
labelled AS (
    SELECT ts, event_type AS route, i, le, floor({views.COUNTER} * share / 100) AS v
    FROM events CROSS JOIN bounds),
stepped AS (
    SELECT *, lag(v) OVER (PARTITION BY route, le ORDER BY ts) AS before FROM labelled),
grown AS (
    SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start, i, le,
           CASE WHEN before IS NULL THEN 0 WHEN v < before THEN v ELSE v - before END AS growth
    FROM stepped),
summed AS (
    SELECT window_start, i, CASE WHEN le = '+Inf' THEN NULL ELSE CAST(le AS DOUBLE) END AS upper,
           sum(growth) AS cum_raw FROM grown GROUP BY ALL),
monotone AS (
    SELECT *, max(cum_raw) OVER (PARTITION BY window_start ORDER BY i) AS cum FROM summed),
shaped AS (
    SELECT *, lag(cum, 1, 0) OVER w AS below, lag(upper, 1, 0) OVER w AS lower,
           max(cum) OVER (PARTITION BY window_start) AS total
    FROM monotone WINDOW w AS (PARTITION BY window_start ORDER BY i)),
hit AS (
    SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY i) AS rn
    FROM shaped WHERE total > 0 AND cum >= 0.95e0 * total)
SELECT s.window_start,
       round(CASE WHEN h.upper IS NULL THEN h.lower
             ELSE h.lower + (h.upper - h.lower) * (0.95e0 * h.total - h.below)
                  / (h.cum - h.below) END, 6) AS quantile
FROM (SELECT DISTINCT window_start FROM summed) s
LEFT JOIN (SELECT * FROM hit WHERE rn = 1) h USING (window_start)
"""
)
def histogram_p95(spark, sf_dir):
    """95th percentile of latency per window from cumulative bucket counters."""
    growth = metrics.increase_by(views.bucket_samples(spark, sf_dir), ["le"], 5)
    rows = metrics.histogram_quantile(0.95, growth, ["window_start"], "increase")
    return rows.withColumn("quantile", F.round("quantile", 6))


@query(
    """
WITH counted AS (
    SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start,
           count(*) AS events
    FROM events GROUP BY 1)
SELECT window_start, events, CAST(events AS DOUBLE) / 300e0 AS rate FROM counted
"""
)
def throughput_5m(spark, sf_dir):
    """Processed events per second in five-minute windows."""
    return metrics.throughput(views.table(spark, sf_dir, "events"))


@query(
    """
SELECT ts, event_type AS route, 'pod-' || CAST(user_id % 4 AS VARCHAR) AS pod, value
FROM events WHERE event_type = 'click' AND user_id % 4 NOT IN (1, 2)
"""
)
def metric_label_filter(spark, sf_dir):
    """Samples by an exact and a negated pattern matcher."""
    rows = metrics.select_series(
        views.samples(spark, sf_dir), "freshness_seconds",
        equals={"route": "click"}, not_matching={"pod": "pod-[12]"},
    )
    return rows.select(
        "ts", metrics.label("route").alias("route"), metrics.label("pod").alias("pod"), "value"
    )


@query(
    """
SELECT ts, event_type AS route, round(100 * (1 - value / (value * 1000 + 1)), 9) AS percent
FROM events
"""
)
def metric_ratio(spark, sf_dir):
    """Percentage from two gauges of the same scrape, one row per scrape however many share series and time."""
    rows = views.samples(spark, sf_dir).withColumn("route", metrics.label("route"))
    percent = metrics.percent_used(rows, "freshness_seconds", "memory_bytes", ["ts", "route", "scrape"])
    return percent.select("ts", "route", F.round("percent", 9).alias("percent"))


_REQUESTS_SQL = """
requests AS (
    SELECT CASE WHEN user_id % 5 = 0 THEN 'POST' ELSE 'GET' END AS method, event_type AS route,
           CASE WHEN user_id % 10 = 0 THEN '500' ELSE '200' END AS status_code,
           value / 5e1 AS duration_s
    FROM events)
"""


@query(
    f"""
WITH {_REQUESTS_SQL},
bounds(le, upper) AS (VALUES ('0.05', 0.05e0), ('0.1', 0.1e0), ('0.25', 0.25e0), ('0.5', 0.5e0),
    ('1.0', 1e0), ('2.5', 2.5e0), ('5.0', 5e0), ('10.0', 1e1), ('+Inf', CAST('inf' AS DOUBLE)))
SELECT method, route, le, count(*) FILTER (WHERE duration_s <= upper) AS cumulative_count,
       count(*) AS count, round(sum(duration_s), 6) AS sum
FROM requests CROSS JOIN bounds GROUP BY method, route, le
"""
)
def latency_histogram(spark, sf_dir):
    """Cumulative latency buckets per method and route."""
    rows = metrics.latency_histogram(views.requests(spark, sf_dir))
    return rows.withColumn("sum", F.round("sum", 6))


@query(
    f"""
WITH {_REQUESTS_SQL}
SELECT method, route, status_code, count(*) AS requests FROM requests GROUP BY ALL
"""
)
def request_counts(spark, sf_dir):
    """Requests per method, route and status."""
    return metrics.request_counts(views.requests(spark, sf_dir))
