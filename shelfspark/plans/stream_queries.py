"""Streaming queries: each runs its stream over the whole table to the end and returns the written rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.plans.registry import query, rounded
from shelfspark.plans.standins import AUDIT_SQL, RAW_SQL, REQUESTS_SQL, sales_raw, table
from shelfspark.session import run_folder
from shelfspark.streaming import jobs, lockout, windows


def event_stream(spark, sf):
    """``events`` as a stream of files; times become instants."""
    events = jobs.file_stream(spark, sf, "events.parquet", table(spark, sf, "events").schema)
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def as_requests(events):
    return events.select(
        "ts", F.col("event_type").alias("endpoint"), F.col("value").alias("duration"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
    )


def as_log(events):
    return events.select(
        "ts", F.when(F.col("event_type") == "error", "login_failed").otherwise(F.col("event_type")).alias("event_type"),
        F.col("user_id").cast("string").alias("ip_address"),
    )


def event_table(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


HOURLY_SQL = "WITH " + REQUESTS_SQL + """, w AS (
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, endpoint, status,
         count(*) AS requests, round(sum(duration), 4) AS duration_sum FROM requests GROUP BY ALL)
SELECT * FROM w WHERE window_end <= (SELECT max(ts) FROM requests) - INTERVAL 1 HOUR"""


@query("stream_request_rollup", HOURLY_SQL)
def stream_request_rollup(spark, sf):
    return rounded(jobs.drain(windows.request_windows(as_requests(event_stream(spark, sf))), "request-rollup"))


@query("request_windows_batch", HOURLY_SQL)
def request_windows_batch(spark, sf):
    return rounded(windows.request_windows_batch(as_requests(event_table(spark, sf))))


SLIDING_SQL = "WITH " + AUDIT_SQL + """, w AS (
  SELECT date_trunc('hour', created_at) - to_hours(CAST(i AS INTEGER)) AS window_start, ip_address, count(*) AS attempts
  FROM audit, generate_series(0, 23) g(i) WHERE event_type = 'login_failed' GROUP BY 1, 2 HAVING count(*) >= 3)
SELECT window_start, window_start + INTERVAL 24 HOUR AS window_end, ip_address, attempts FROM w
WHERE window_start + INTERVAL 24 HOUR <= (SELECT max(created_at) FROM audit {only}) - INTERVAL 1 HOUR"""


@query("stream_suspicious", SLIDING_SQL.format(only=""))
def stream_suspicious(spark, sf):
    return jobs.drain(windows.suspicious_windows(as_log(event_stream(spark, sf))), "suspicious")


@query("suspicious_windows_batch", SLIDING_SQL.format(only=""))
def suspicious_windows_batch(spark, sf):
    return windows.suspicious_windows_batch(as_log(event_table(spark, sf)))


SESSION_SQL = """WITH e AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
n AS (SELECT *, sum(CASE WHEN before IS NULL OR ts - before > INTERVAL 60 MINUTE THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 60 MINUTE AS session_end, count(*) AS events FROM n
GROUP BY user_id, s HAVING max(ts) + INTERVAL 60 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""


@query("stream_sessions", SESSION_SQL)
def stream_sessions(spark, sf):
    return jobs.drain(windows.sessions(event_stream(spark, sf)), "sessions")


@query("sessions_batch", SESSION_SQL)
def sessions_batch(spark, sf):
    return windows.sessions_batch(event_table(spark, sf))


# Failures are rare in the given events, so the stand-in locks early and for long.
RULES = lockout.Rules(max_attempts=3, lock_minutes=720, reset_minutes=4320)


# One step per attempt number, all accounts at once.
LOCKOUT_SQL = f"""
WITH RECURSIVE tries AS (
  SELECT user_id, epoch_us(ts) AS us, event_type = 'error' AS failed,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type = 'error') AS n
  FROM events WHERE event_type IN ('error', 'signup')),
steps AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS us, 0 AS attempts, CAST(-4e18 AS BIGINT) AS last_failed,
         CAST(-4e18 AS BIGINT) AS locked_until, false AS locks FROM tries
  UNION ALL
  SELECT user_id, n, us, CASE WHEN refused THEN attempts WHEN failed THEN now ELSE 0 END,
         CASE WHEN refused THEN last_failed WHEN failed THEN us ELSE CAST(-4e18 AS BIGINT) END,
         CASE WHEN refused THEN locked_until WHEN NOT failed THEN CAST(-4e18 AS BIGINT)
              WHEN now >= {RULES.max_attempts} THEN us + {RULES.lock_minutes} * 60000000::BIGINT ELSE locked_until END,
         NOT refused AND failed AND now >= {RULES.max_attempts}
  FROM (SELECT t.user_id, t.n, t.us, t.failed, t.us < s.locked_until AS refused, s.attempts, s.last_failed, s.locked_until,
               CASE WHEN s.last_failed < t.us - {RULES.reset_minutes} * 60000000::BIGINT THEN 1 ELSE s.attempts + 1 END AS now
        FROM steps s JOIN tries t ON t.user_id = s.user_id AND t.n = s.n + 1))
SELECT user_id, make_timestamp(us) AS locked_at, make_timestamp(locked_until) AS locked_until, attempts FROM steps WHERE locks
"""


@query("stream_lockout", LOCKOUT_SQL)
def stream_lockout(spark, sf):
    return jobs.drain(lockout.lock_stream(lockout.attempts(event_stream(spark, sf)), RULES), "lockout")


@query("lockout_batch", LOCKOUT_SQL)
def lockout_batch(spark, sf):
    return lockout.lock_batch(lockout.attempts(event_table(spark, sf)), RULES)


# the end of each lock that a later attempt or the last watermark has passed
LOCK_EVENTS_SQL = LOCKOUT_SQL.replace(
    "SELECT user_id, make_timestamp(us) AS locked_at, make_timestamp(locked_until) AS locked_until, attempts FROM steps WHERE locks",
    """, locked AS (SELECT user_id, make_timestamp(us) AS happened_at, make_timestamp(locked_until) AS locked_until, attempts FROM steps WHERE locks),
ended AS (SELECT locked.* FROM locked WHERE locked_until <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events WHERE event_type IN ('error', 'signup'))
          OR EXISTS (SELECT 1 FROM events e WHERE e.user_id = locked.user_id AND event_type IN ('error', 'signup') AND e.ts >= locked_until))
SELECT user_id, 'locked' AS event, happened_at, locked_until, attempts FROM locked UNION ALL
SELECT user_id, 'unlocked', locked_until, locked_until, attempts FROM ended""",
)


@query("stream_lock_events", LOCK_EVENTS_SQL)
def stream_lock_events(spark, sf):
    """Locks and unlocks by timers in the keyed state."""
    with jobs.keyed_state(spark):
        return jobs.drain(lockout.event_stream(lockout.attempts(event_stream(spark, sf)), RULES), "lock-events")


@query("lock_events_batch", LOCK_EVENTS_SQL)
def lock_events_batch(spark, sf):
    return lockout.event_batch(lockout.attempts(event_table(spark, sf)), RULES)


@query(
    "stream_ingest",
    "WITH " + RAW_SQL + ", least AS (SELECT date, sku_id, store_id, min(ROW(units, price, promo_flag)) AS r FROM raw GROUP BY 1, 2, 3) "
    "SELECT date, sku_id, store_id, r[1] AS units, r[2] AS price, r[3] AS promo_flag FROM least",
)
def stream_ingest(spark, sf):
    """Order lines as they arrive, one row per sales key: the smallest of the first micro-batch that holds the key."""
    lines = jobs.file_stream(spark, sf, "lineitem.parquet", table(spark, sf, "lineitem").schema)
    zone = run_folder(spark, "stream-zone")
    raw = sales_raw(spark, sf, lines).select("date", "sku_id", "store_id", "units", "price", "promo_flag")
    jobs.ingest(raw, zone, f"{zone}/state")
    return jobs.zone_rows(spark, zone)


LATE_SQL = "WITH " + REQUESTS_SQL + """, half AS (SELECT quantile_disc(ts, 0.5) AS at_half FROM events),
mark AS (SELECT max(ts) - INTERVAL 1 HOUR AS closed FROM events, half WHERE ts >= at_half AND event_id % 2 = 0)
SELECT count(DISTINCT (date_trunc('hour', ts), endpoint, status)) AS late_rows FROM requests, half, mark
WHERE ts < at_half AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= closed"""


@query("stream_late_rows", LATE_SQL)
def stream_late_rows(spark, sf):
    """The newer half of the events arrives in two files before the older half: what the hourly windows drop is counted.

    A micro-batch drops by the watermark that the one before it began with. The operator sees one row per window and key.
    """
    folder, events = run_folder(spark, "late-events"), event_table(spark, sf)
    half = events.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY unix_micros(ts))")).scalar()
    new, even = F.col("ts") >= F.timestamp_micros(half.cast("long")), F.col("event_id") % 2 == 0
    for part in (new & even, new & ~even, ~new):
        events.where(part).coalesce(1).write.mode("append").parquet(folder)
    stream = jobs.file_stream(spark, folder, "*.parquet", events.schema, files_per_trigger=1)
    return jobs.drained(windows.request_windows(as_requests(stream)), "late")[1]
