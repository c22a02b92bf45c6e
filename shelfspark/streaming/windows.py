"""Windowed streaming reports, and the batch forms that give the same rows.

In append mode a window is emitted once the watermark has passed its end, so each batch form keeps only windows that end
no later than the newest time minus the allowed delay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfspark.operators.audit import FEW_ATTEMPTS

DELAY = "1 hour"


def closed(df: DataFrame, events: DataFrame, end: str, delay: str = DELAY) -> DataFrame:
    """Windows the watermark has passed after all of ``events``."""
    mark = events.agg(F.date_trunc("MILLISECOND", F.max("ts"))).scalar() - F.expr(f"INTERVAL {delay}")
    return df.where(F.col(end) <= mark)


# ---- requests per hour --------------------------------------------------------------------------------------------


def _per_window(events: DataFrame, size: str) -> DataFrame:
    return events.groupBy(F.window("ts", size).alias("w"), "endpoint", "status").agg(
        F.count("*").alias("requests"), F.sum("duration").alias("duration_sum")
    ).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "endpoint", "status", "requests",
        "duration_sum",
    )


def request_windows(events: DataFrame, size: str = "1 hour", delay: str = DELAY) -> DataFrame:
    return _per_window(events.withWatermark("ts", delay), size)


def request_windows_batch(events: DataFrame, size: str = "1 hour", delay: str = DELAY) -> DataFrame:
    return closed(_per_window(events, size), events, "window_end", delay)


# ---- failed logins in a sliding day -------------------------------------------------------------------------------


def suspicious_windows(
    log: DataFrame, min_attempts: int = FEW_ATTEMPTS, size: str = "24 hours", slide: str = "1 hour", delay: str = DELAY
) -> DataFrame:
    """Addresses with many failed logins in any window.

    Failures are counted per slide first and the counts are then spread over the windows, so an attacked address is one
    row per hour and not one row per attempt and window.
    """
    return _sliding(log.withWatermark("ts", delay), min_attempts, size, slide)


def _sliding(log: DataFrame, min_attempts: int, size: str, slide: str) -> DataFrame:
    failed = log.where((F.col("event_type") == "login_failed") & F.col("ip_address").isNotNull())
    hourly = failed.groupBy(F.window("ts", slide).alias("h"), "ip_address").agg(F.count("*").alias("n"))
    spread = hourly.groupBy(F.window(F.window_time("h"), size, slide).alias("w"), "ip_address")
    counted = spread.agg(F.sum("n").alias("attempts")).where(F.col("attempts") >= min_attempts)
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "ip_address", "attempts"
    )


def suspicious_windows_batch(
    log: DataFrame, min_attempts: int = FEW_ATTEMPTS, size: str = "24 hours", slide: str = "1 hour", delay: str = DELAY
) -> DataFrame:
    return closed(_sliding(log, min_attempts, size, slide), log, "window_end", delay)


# ---- sessions -----------------------------------------------------------------------------------------------------


def sessions(events: DataFrame, gap: str = "60 minutes", delay: str = DELAY) -> DataFrame:
    """Runs of one user's events with at most ``gap`` between neighbours."""
    grouped = events.withWatermark("ts", delay).groupBy(F.session_window("ts", gap).alias("w"), "user_id")
    return grouped.agg(F.count("*").alias("events")).select(
        "user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events"
    )


def sessions_batch(events: DataFrame, gap_minutes: int = 60, delay: str = DELAY) -> DataFrame:
    """The same sessions, closed ones only. Events are first reduced to chains inside fixed slots of one gap."""
    parts = events.withColumn("_slot", _slot("ts", gap_minutes)).groupBy("user_id", "_slot").agg(
        F.min("ts").alias("lo"), F.max("ts").alias("hi"), F.count("*").alias("n")
    )
    w = Window.partitionBy("user_id").orderBy("_slot")
    gap = F.expr(f"INTERVAL {gap_minutes} MINUTES")
    # an event exactly one gap after the last one still belongs to the session
    fresh = F.coalesce((F.col("lo") > F.lag("hi").over(w) + gap).cast("int"), F.lit(1))
    numbered = parts.withColumn("_new", fresh).withColumn("_id", F.sum("_new").over(w))
    out = numbered.groupBy("user_id", "_id").agg(
        F.min("lo").alias("session_start"), (F.max("hi") + gap).alias("session_end"), F.sum("n").alias("events")
    ).drop("_id")
    return closed(out, events, "session_end", delay)


def _slot(ts: str, minutes: int) -> Column:
    """Number of the fixed time slot. Two events of one slot are less than ``minutes`` apart."""
    return F.floor(F.unix_micros(F.col(ts)) / F.lit(minutes * 60_000_000)).cast("bigint")
