"""Analytic queries on session tables.

Session counts are taken on rolled-up sessions, never on event rows, so a session counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rollup_stored(table: DataFrame, user: str = "uuid") -> DataFrame:
    """One row per session of a stored session table, with its partition columns.

    A session lies in one partition, so filters on ``session_date`` and ``user_hash_bucket`` put on the result reach
    the scan of the table as partition filters.
    """
    start, end = F.col("session_start_time_ms"), F.col("session_end_time_ms")
    return (
        table.groupBy("session_date", "user_hash_bucket", user, "session_id")
        .agg(F.min(start).alias("session_start_time_ms"), F.max(end).alias("session_end_time_ms"), F.count(F.lit(1)).alias("event_count"))
        .withColumn("session_duration_seconds", (end - start) / 1000.0)
    )


def daily_sessions(rollup: DataFrame, first: str, last: str) -> DataFrame:
    """Sessions and average duration per start date within a date range."""
    return (
        rollup.filter(F.col("session_date").between(first, last))
        .groupBy("session_date")
        .agg(
            F.count(F.lit(1)).alias("daily_sessions"),
            F.avg("session_duration_seconds").alias("avg_duration"),
        )
    )


def bucket_cohort(table: DataFrame, buckets: list[int], user: str = "uuid", exact: bool = True) -> DataFrame:
    """Users per bucket for some buckets; ``exact=False`` uses a sketch instead of a shuffle of ids."""
    users = F.count_distinct(F.col(user)) if exact else F.approx_count_distinct(user)
    return (
        table.filter(F.col("user_hash_bucket").isin(buckets))
        .groupBy("user_hash_bucket")
        .agg(users.alias("unique_users"))
    )


def session_lookup(rollup: DataFrame, date: str, bucket: int, user: str = "uuid") -> DataFrame:
    """Sessions of one date and one bucket; on a partitioned table only that folder is read."""
    return rollup.filter(
        (F.col("session_date") == date) & (F.col("user_hash_bucket") == bucket)
    ).select(user, "session_id", "session_duration_seconds")


def counts_by(df: DataFrame, column: str, name: str = "event_count") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def date_distribution(sessions: DataFrame) -> DataFrame:
    """Events and different sessions per date, in date order."""
    return (
        sessions.groupBy("session_date", "session_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("session_date")
        .agg(F.sum("n").alias("event_count"), F.count(F.lit(1)).alias("sessions"))
        .orderBy("session_date")
    )


def users_per_bucket(table: DataFrame, user: str = "uuid") -> DataFrame:
    return (
        table.select(user, "user_hash_bucket")
        .distinct()
        .groupBy("user_hash_bucket")
        .agg(F.count(F.lit(1)).alias("users"))
    )


def bucket_balance(table: DataFrame, user: str = "uuid") -> DataFrame:
    """Smallest, largest, mean and standard deviation of users per bucket."""
    return users_per_bucket(table, user).agg(
        F.min("users").alias("min_users_per_bucket"),
        F.max("users").alias("max_users_per_bucket"),
        F.avg("users").alias("avg_users_per_bucket"),
        F.stddev_samp("users").alias("stddev_users"),
    )


def bucket_conflicts(table: DataFrame, user: str = "uuid") -> DataFrame:
    """Users found in more than one bucket; a sound layout has none."""
    return (
        table.groupBy(user)
        .agg(F.min("user_hash_bucket").alias("low"), F.max("user_hash_bucket").alias("high"))
        .filter("low <> high")
    )


def first_partitions(table: DataFrame, count: int = 10) -> DataFrame:
    """Events per (date, bucket), the first ``count`` in order."""
    return (
        table.groupBy("session_date", "user_hash_bucket")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy("session_date", "user_hash_bucket")
        .limit(count)
    )


def pruned_count(table: DataFrame, date: str | None = None, buckets: list[int] | None = None) -> DataFrame:
    """Rows of some partitions; both conditions are on partition columns and prune the scan."""
    if date is not None:
        table = table.filter(F.col("session_date") == date)
    if buckets is not None:
        table = table.filter(F.col("user_hash_bucket").isin(buckets))
    return table.agg(F.count(F.lit(1)).alias("event_count"))


def overall(rollup: DataFrame) -> DataFrame:
    return rollup.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.avg("session_duration_seconds").alias("avg_duration"),
        F.max("session_duration_seconds").alias("max_duration"),
    )


def sessions_per_user(rollup: DataFrame, user: str = "uuid") -> DataFrame:
    return counts_by(rollup, user, "session_count")


def numeric_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum: one row per column, one pass."""
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.count(name).alias("value_count"),
            F.avg(name).alias("mean"),
            F.stddev_samp(name).alias("stddev"),
            F.min(name).cast("double").alias("min_value"),
            F.max(name).cast("double").alias("max_value"),
        )
        for name in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def windowed_activity(
    df: DataFrame,
    keys: list[str],
    event_time: str = "timestamp",
    width: str = "30 minutes",
    total: str = "duration_seconds",
    counted: str = "page",
) -> DataFrame:
    """Sum and count per key and tumbling window; set a watermark first on a stream."""
    return df.groupBy(*keys, F.window(event_time, width).alias("window")).agg(
        F.sum(total).alias(f"{total}_sum"), F.count(counted).alias(f"{counted}_count")
    )
