"""Reads and statistics over the security audit log. ``as_of`` stands for "now" in every report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Export window, its columns, report window and thresholds.
EXPORT_HOURS, REPORT_HOURS, FEW_ATTEMPTS, MANY_ATTEMPTS = 720, 24, 3, 5
EXPORT_COLUMNS = [
    "id", "event_type", "user_id", "user_email", "ip_address", "severity", "details", "created_at",
]


def newest_time(log: DataFrame) -> Column:
    return log.agg(F.max("created_at")).scalar()


def within(log: DataFrame, as_of: Column, hours: int) -> DataFrame:
    return log.where(F.col("created_at") >= F.timestamp_add("HOUR", F.lit(-hours), as_of))


def newest_first() -> list[Column]:
    return [F.col("created_at").desc(), F.col("id").desc()]


def audit_filter(
    log: DataFrame,
    event_type: str | None = None,
    user_id: int | None = None,
    user_email: str | None = None,
    severity: str | None = None,
    ip_address: str | None = None,
    start: str | None = None,
    end: str | None = None,
    skip: int = 0,
    limit: int = 100,
) -> DataFrame:
    """One page of the log, newest first; ``user_email`` matches any part of the address in any case."""
    exact = {"event_type": event_type, "user_id": user_id, "severity": severity, "ip_address": ip_address}
    for column, value in exact.items():
        if value is not None:
            log = log.where(F.col(column) == value)
    if user_email:
        log = log.where(F.contains(F.lower("user_email"), F.lit(user_email.lower())))
    if start:
        log = log.where(F.col("created_at") >= F.lit(start).cast("timestamp"))
    if end:
        log = log.where(F.col("created_at") <= F.lit(end).cast("timestamp"))
    return log.orderBy(*newest_first()).offset(skip).limit(limit)


def suspicious_sources(
    log: DataFrame, as_of: Column, hours: int = REPORT_HOURS, min_attempts: int = FEW_ATTEMPTS
) -> DataFrame:
    """Addresses with many failed logins in the window; unknown addresses do not count."""
    failed = within(log, as_of, hours).where((F.col("event_type") == "login_failed") & F.col("ip_address").isNotNull())
    return failed.groupBy("ip_address").agg(F.count("*").alias("attempts")).where(F.col("attempts") >= min_attempts)


def audit_stats(log: DataFrame, as_of: Column, hours: int = REPORT_HOURS) -> DataFrame:
    """Counts by type, by severity and in all as rows (kind, name, n), plus suspicious addresses; two scans."""
    recent = within(log, as_of, hours)
    kind, level = F.col("event_type"), F.col("severity")
    sets = recent.groupingSets([[kind], [level], []], kind, level).agg(
        F.count("*").alias("n"), F.grouping_id("event_type", "severity").alias("_g")
    )
    counts = sets.select(
        F.when(F.col("_g") == 1, "event_type").when(F.col("_g") == 2, "severity").otherwise("total").alias("kind"),
        F.coalesce(kind, level).alias("name"), "n",
    )
    sources = suspicious_sources(log, as_of, hours, MANY_ATTEMPTS)
    return counts.unionByName(
        sources.select(F.lit("suspicious_ip").alias("kind"), F.col("ip_address").alias("name"), F.col("attempts").alias("n"))
    )


def audit_export(log: DataFrame, as_of: Column, hours: int = EXPORT_HOURS) -> DataFrame:
    """The rows of the window, newest first, with ISO times."""
    rows = within(log, as_of, hours).orderBy(*newest_first()).select(*EXPORT_COLUMNS)
    return rows.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
