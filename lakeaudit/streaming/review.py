"""Incremental review: which day comes next, and how its state moves on.

The "stream" is a lake that gains a day folder at a time. The state is the set of reviewed days plus
compact snapshots of recent partitions, so a gap day that arrives late is still picked up, while a
reviewed day is never opened again. All of it is tables with one row per day or partition.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

DEFAULT_MAX_DAYS_BACK = 2


def review_window(days: DataFrame, max_days_back: int = DEFAULT_MAX_DAYS_BACK) -> DataFrame:
    """One row: ``newest_day, oldest_day, discovered_days``."""
    return days.agg(
        F.max("partition_date").alias("newest_day"),
        F.date_sub(F.max("partition_date"), max_days_back).alias("oldest_day"),
        F.count(F.lit(1)).alias("discovered_days"),
    )


def pending_days(days: DataFrame, reviewed: DataFrame, max_days_back: int = DEFAULT_MAX_DAYS_BACK) -> DataFrame:
    """Days inside the review window that were not reviewed yet."""
    window = review_window(days, max_days_back).select("oldest_day")
    return (
        days.join(F.broadcast(window), F.col("partition_date") >= F.col("oldest_day"))
        .drop("oldest_day")
        .join(reviewed.select("partition_date").distinct(), "partition_date", "left_anti")
    )


def expired_days(days: DataFrame, reviewed: DataFrame, max_days_back: int = DEFAULT_MAX_DAYS_BACK) -> DataFrame:
    """One row: how many days before the window were never reviewed, and the first and last of them."""
    oldest = review_window(days, max_days_back).select("oldest_day")
    missed = days.join(reviewed, "partition_date", "left_anti").join(oldest, F.col("partition_date") < F.col("oldest_day"))
    return missed.agg(
        F.count(F.lit(1)).alias("expired_days"), F.min("partition_date").alias("oldest_expired_day"), F.max("partition_date").alias("newest_expired_day"))


def next_review(days: DataFrame, reviewed: DataFrame, max_days_back: int = DEFAULT_MAX_DAYS_BACK) -> DataFrame:
    """One row: ``status, target_day, blocked_day, pending_days``.

    The earliest pending day with files is next. If pending days exist but all are empty, the first
    of them blocks; with nothing pending the review is idle.
    """
    return (
        pending_days(days, reviewed, max_days_back)
        .agg(
            F.min(F.when(F.col("has_files"), F.col("partition_date"))).alias("target_day"),
            F.min(F.when(~F.col("has_files"), F.col("partition_date"))).alias("_empty_day"),
            F.count(F.lit(1)).alias("pending_days"),
        )
        .select(
            F.when(F.col("target_day").isNotNull(), "validated")
            .when(F.col("_empty_day").isNotNull(), "blocked")
            .otherwise("idle")
            .alias("status"),
            "target_day",
            F.when(F.col("target_day").isNull(), F.col("_empty_day")).alias("blocked_day"),
            "pending_days",
        )
    )


def resolved_reviewed(days: DataFrame, reviewed: DataFrame | None, latest: date | None) -> DataFrame:
    """Reviewed days; without a stored set every discovered day up to the latest one counts as reviewed."""
    if reviewed is not None:
        return reviewed.select("partition_date").distinct()
    bound = F.lit(False) if latest is None else F.col("partition_date") <= F.lit(latest)
    return days.where(bound).select("partition_date").distinct()


def advanced_reviewed(reviewed: DataFrame, target: date | Column) -> DataFrame:
    """Reviewed days plus the day just completed, whatever its findings were."""
    day = target if isinstance(target, Column) else F.lit(target)
    added = reviewed.sparkSession.range(1).select(day.cast("date").alias("partition_date"))
    return reviewed.select("partition_date").unionByName(added).distinct()


def within_days(snapshots: DataFrame, oldest: date | Column | None, latest: date | Column | None, include_latest: bool) -> DataFrame:
    """Snapshots of days from ``oldest`` up to ``latest``; nothing when a bound is missing."""
    if oldest is None or latest is None:
        return snapshots.where(F.lit(False))
    low = oldest if isinstance(oldest, Column) else F.lit(oldest)
    high = latest if isinstance(latest, Column) else F.lit(latest)
    day = F.col("partition_date")
    return snapshots.where((day >= low) & ((day <= high) if include_latest else (day < high)))


def upsert_snapshots(committed: DataFrame, current: DataFrame, key: str = "part_id") -> DataFrame:
    """Committed snapshots with every partition of ``current`` replaced by its current rows."""
    return committed.join(current.select(key).distinct(), key, "left_anti").unionByName(current)


def state_errors(
    newest: date | None, latest: date | None, reviewed: set[date] | None, snapshot_latest: date | None
) -> list[str]:
    """Contradictions in stored review state (aggregates only, so nothing large is inspected here)."""
    errors = []
    if latest is None:
        if reviewed:
            errors.append("reviewed days are stored without a latest reviewed day")
        if snapshot_latest is not None:
            errors.append("snapshots are stored without a latest reviewed day")
        return errors
    if newest is not None and latest > newest:
        errors.append(f"latest reviewed day {latest} lies after the newest discovered day {newest}")
    if reviewed is not None and not reviewed:
        errors.append("the set of reviewed days is empty despite a latest reviewed day")
    if reviewed and max(reviewed) != latest:
        errors.append(f"latest reviewed day {latest} is not the newest of the reviewed days")
    if snapshot_latest is not None and snapshot_latest > latest:
        errors.append(f"a snapshot of {snapshot_latest} lies after the latest reviewed day {latest}")
    return errors
