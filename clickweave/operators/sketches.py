"""Mergeable summaries of sessions per partition: ranges of dates are answered without the rows.

One row per (date, user bucket) holds a HyperLogLog sketch of the users and a KLL sketch of the durations. Sketches of
any partitions merge into the sketch of their union, so a year is some thousand rows to read whatever the traffic was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTITION = ("session_date", "user_hash_bucket")
#: Sizes of the sketches. The relative standard error of a distinct count is about 1.04 / sqrt(2 ** LG_K), here 0.8 %; that of
#: the rank of a quantile about 2.3 / k ** 0.94, here 0.5 %. Up to about k values a KLL sketch is exact.
LG_K, KLL_K = 14, 800


def session_sketches(
    sessions: DataFrame,
    user: str = "uuid",
    duration: str = "session_duration_seconds",
    by: tuple[str, ...] = PARTITION,
    lg_k: int = LG_K,
    k: int = KLL_K,
) -> DataFrame:
    """One row per partition from one row per session: ``sessions``, ``events``, ``users`` and ``durations``.

    Sketches are built where the rows are and merged in the shuffle, so a partition that holds a third of all rows moves no
    more than any other. Null users and durations are in no sketch; a duration is measured in whole milliseconds.
    """
    millis = F.round(F.col(duration) * 1000).cast("bigint")
    return sessions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("event_count").alias("events"),
        F.hll_sketch_agg(F.col(user), F.lit(lg_k)).alias("users"),
        F.kll_sketch_agg_bigint(millis, F.lit(k)).alias("durations"),
    )


def merge_sketches(
    sketches: DataFrame,
    by: list[Column | str] = (),
    first: str | None = None,
    last: str | None = None,
    buckets: list[int] | None = None,
    k: int = KLL_K,
) -> DataFrame:
    """The sketches of dates ``first`` to ``last`` and of ``buckets`` merged, by any expression of the partition columns.

    The bounds are filters on partition columns, so a stored table is pruned by them.
    """
    if first is not None:
        sketches = sketches.filter(F.col("session_date") >= first)
    if last is not None:
        sketches = sketches.filter(F.col("session_date") <= last)
    if buckets is not None:
        sketches = sketches.filter(F.col("user_hash_bucket").isin(buckets))
    return sketches.groupBy(*by).agg(
        F.sum("sessions").alias("sessions"),
        F.sum("events").alias("events"),
        F.hll_union_agg("users").alias("users"),
        F.kll_merge_agg_bigint("durations", F.lit(k)).alias("durations"),
    )


def distinct_users(users: str = "users") -> Column:
    return F.hll_sketch_estimate(users)


def duration_quantile(share: float, durations: str = "durations") -> Column:
    """The duration in seconds that so large a share of the sessions do not exceed, null without any."""
    some = F.kll_sketch_get_n_bigint(durations) > 0
    return F.when(some, F.kll_sketch_get_quantile_bigint(durations, F.lit(share)) / 1000.0)
