"""Streaming queries (X1-X5) and their batch twins on ``events``.

Batch twins run the same window operators on the table and are checked against
SQL; the streaming queries read the table as a file stream, run with a watermark
until all available input is processed, and are checked on rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import trunc_ntz
from ..session import cut_lineage, table
from ..streaming.live import running_max_flags
from ..streaming.signals import flag_stream, read_stream, run_to_files, session_counts, signal_windows
from .registry import query

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@query("tumbling_mean_abs", """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type,
       count(*) AS n, round(avg(abs(value)), 9) AS mean_abs_value FROM events GROUP BY 1, 2, 3""")
def tumbling_mean_abs_q(spark, sf):
    """X1 batch twin: hourly tumbling windows per event type, mean |value|."""
    out = signal_windows(table(spark, sf, "events"), "ts", ["value"], "1 hour", keys=["event_type"])
    return out.withColumn("mean_abs_value", F.round("mean_abs_value", 9))


@query("sliding_mean_abs", """
SELECT w AS window_start, w + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n,
       round(avg(abs(value)), 9) AS mean_abs_value
FROM (SELECT event_type, value, time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS w
      FROM events, generate_series(0, 3) g(k)) GROUP BY 1, 2, 3""")
def sliding_mean_abs_q(spark, sf):
    """X2 batch twin: 1-hour windows sliding by 15 minutes."""
    out = signal_windows(table(spark, sf, "events"), "ts", ["value"], "1 hour", "15 minutes", keys=["event_type"])
    return out.withColumn("mean_abs_value", F.round("mean_abs_value", 9))


@query("session_counts", """
WITH e AS (SELECT user_id, ts, event_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
s AS (SELECT user_id, ts, sum(CASE WHEN prev IS NULL OR ts - prev >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n
FROM s GROUP BY user_id, sid""")
def session_counts_q(spark, sf):
    """X3 batch twin: per-user sessions with a 30-minute gap (gaps and islands)."""
    return session_counts(table(spark, sf, "events"), "ts", "user_id", "30 minutes")


@query("stream_tumbling", """
SELECT * FROM (
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type,
         count(*) AS n, round(avg(abs(value)), 9) AS mean_abs_value FROM events GROUP BY 1, 2, 3)
WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def stream_tumbling_q(spark, sf):
    """X1/X5 streaming: the event table as a file stream, hourly windows with a
    10-minute watermark, append mode; windows still open behind the final watermark
    are not emitted."""
    s = read_stream(spark, sf, EVENT_SCHEMA, glob="events.parquet")
    w = signal_windows(s, "ts", ["value"], "1 hour", keys=["event_type"], watermark="10 minutes")
    return run_to_files(w, "stream-tumbling").withColumn("mean_abs_value", F.round("mean_abs_value", 9))


def _thresholds(spark, sf):
    """Per event type: 1.05 x the largest hourly mean |value| of the training period."""
    ev = table(spark, sf, "events").filter(F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz"))
    hourly = ev.groupBy("event_type", trunc_ntz("ts", "hour").alias("h")).agg(F.avg(F.abs("value")).alias("s"))
    return hourly.groupBy("event_type").agg((F.max("s") * 1.05).alias("threshold"))


_ANOMALY_SQL = """
WITH h AS (SELECT event_type, avg(abs(value)) AS s FROM events WHERE ts < TIMESTAMP '2024-01-21'
           GROUP BY event_type, date_trunc('hour', ts)),
t AS (SELECT event_type, max(s) * 1.05 AS threshold FROM h GROUP BY 1)
SELECT e.event_id, e.event_type, COALESCE(e.value > t.threshold, false) AS anomaly
FROM events e LEFT JOIN t ON e.event_type = t.event_type"""


@query("stream_anomaly_batch", _ANOMALY_SQL)
def stream_anomaly_batch_q(spark, sf):
    """X4 batch twin: the same static-threshold flag over the table."""
    ev = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    return flag_stream(ev, _thresholds(spark, sf), "event_type", "value").select("event_id", "event_type", "anomaly")


@query("stream_anomaly", _ANOMALY_SQL)
def stream_anomaly_q(spark, sf):
    """Live flag: each streamed event joined to its type's static threshold. The
    threshold table is stored once (lineage cut), so every micro-batch joins a small
    stored table instead of re-aggregating the training period."""
    s = read_stream(spark, sf, EVENT_SCHEMA, glob="events.parquet")
    thresholds = cut_lineage(_thresholds(spark, sf))
    flagged = flag_stream(s.select("event_id", "ts", "event_type", "value"), thresholds, "event_type", "value")
    return run_to_files(flagged, "stream-anomaly").select("event_id", "event_type", "anomaly")


@query("stream_running_max", """
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) > INTERVAL 30 MINUTE
                          THEN 1 ELSE 0 END AS pause FROM events),
s AS (SELECT *, sum(pause) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS part FROM g),
m AS (SELECT *, max(value) OVER (PARTITION BY event_type, part ORDER BY ts, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s)
SELECT event_id, event_type, value, 1.05 * before AS threshold, coalesce(value > 1.05 * before, false) AS anomaly FROM m""")
def stream_running_max_q(spark, sf):
    """Live flag with state: each event against 1.05 x its type's largest earlier value, forgotten
    after a pause of 30 minutes."""
    s = read_stream(spark, sf, EVENT_SCHEMA, glob="events.parquet")
    flags = running_max_flags(s, "ts", "event_type", "value", "event_id", forget="30 minutes")
    out = run_to_files(flags, "stream-running-max")
    return out.select(F.col("row_id").alias("event_id"), F.col("channel").alias("event_type"),
                      F.col("score").alias("value"), "threshold", "anomaly")
