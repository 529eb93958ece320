"""Partition columns of the session table and the predicates that prune on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The table is laid out by day and by one of 100 user buckets.
USER_BUCKETS = 100
SESSION_DATE_FORMAT = "yyyy-MM-dd"


def session_date(start_ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(start_ms), SESSION_DATE_FORMAT)


def user_bucket(user: Column, buckets: int = USER_BUCKETS) -> Column:
    """Murmur3 bucket of a user id. The widening cast keeps ``abs`` defined for every hash."""
    return (F.abs(F.hash(user).cast("bigint")) % buckets).cast("int")


def add_layout_columns(
    df: DataFrame,
    user: str = "uuid",
    start_ms: str = "session_start_time_ms",
    buckets: int = USER_BUCKETS,
) -> DataFrame:
    return df.withColumns(
        {
            "session_date": session_date(F.col(start_ms)),
            "user_hash_bucket": user_bucket(F.col(user), buckets),
        }
    )


def for_user(df: DataFrame, value: str, user: str = "uuid", buckets: int = USER_BUCKETS) -> DataFrame:
    """Rows of one user, with the literal bucket added so that the scan prunes partitions.

    Spark folds the hash of a literal at planning time, but cannot derive the bucket from a
    filter on the user column alone.
    """
    key = F.lit(value).cast(df.schema[user].dataType)
    return df.filter((F.col(user) == key) & (F.col("user_hash_bucket") == user_bucket(key, buckets)))


def with_date_column(df: DataFrame, time: Column, name: str) -> DataFrame:
    """A date derived from a time expression, to partition a table by."""
    return df.withColumn(name, F.to_date(time))


def spread(df: DataFrame, columns: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """Repartition by columns, by count, or both."""
    if partitions is None:
        return df.repartition(*columns) if columns else df
    return df.repartition(partitions, *(columns or []))
