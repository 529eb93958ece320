"""Event-time columns."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

# Fixed value: the first millisecond after the year 9999, beyond which no timestamp is valid.
END_OF_TIME_MS = 253402300800000


def parse_timestamp(df: DataFrame, column: str, fmt: str | None = None) -> DataFrame:
    """Turn a text column into a timestamp in place; unreadable text becomes null."""
    if isinstance(df.schema[column].dataType, (TimestampType, TimestampNTZType)):
        return df
    parsed = F.try_to_timestamp(F.col(column), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(column))
    return df.withColumn(column, parsed)


def normalise_event_time(
    df: DataFrame, column: str = "event_timestamp", truncate_to_seconds: bool = False
) -> DataFrame:
    """Add ``event_time`` (timestamp) and ``event_time_ms`` (epoch milliseconds).

    The source column may hold epoch milliseconds as a number or as text, ISO text, or a
    timestamp. A value that is none of these, or lies beyond the year 9999, gives null in both
    columns, whatever its type and on streams as well as bounded tables.
    """
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        ms = _valid(F.unix_millis(value.cast("timestamp")))
    else:
        ms = _valid(value.try_cast("double").try_cast("bigint"))
        if isinstance(kind, StringType):
            ms = F.coalesce(ms, _valid(F.unix_millis(F.try_to_timestamp(value))))
    if truncate_to_seconds:
        ms = ms - F.pmod(ms, F.lit(1000))
    return df.withColumn("event_time_ms", ms).withColumn(
        "event_time", F.timestamp_millis("event_time_ms")
    )


def _valid(ms: Column) -> Column:
    return F.when(F.abs(ms) < END_OF_TIME_MS, ms)


@dataclass(frozen=True)
class ClockRules:
    """How far the time of an event may be from its arrival, in milliseconds or as a ``timedelta``.

    ``most_ahead``: an event whose time is more than this after its arrival has a wrong clock. ``most_late``: one whose time
    is more than this before it is late; None takes events however late. ``slack``: how far the partitions of a source may lag
    behind each other in a stream, by arrival.
    """

    most_ahead: timedelta = timedelta(minutes=5)
    most_late: timedelta | None = None
    slack: timedelta = timedelta(minutes=5)

    def __post_init__(self):
        limits = (self.most_ahead, self.most_late or timedelta(0), self.slack)
        if min(limits) < timedelta(0):
            raise ValueError("limits of a clock are not negative")

    @property
    def watermark_delay(self) -> str:
        """What a watermark has to wait so that it passes nothing that the rules let through.

        The watermark is ``delay`` behind the latest event time, so at most ``most_ahead - delay`` after the latest arrival; an event that
        the rules let through is at most ``most_late`` before its arrival, which lags ``slack`` at most.
        """
        late = timedelta(minutes=10) if self.most_late is None else self.most_late
        return f"{(self.most_ahead + late + self.slack) // timedelta(milliseconds=1)} milliseconds"


def arrival_time(arrival: str | None) -> Column:
    """The timestamp column ``arrival``, and where it is null or not given the time of the batch."""
    now = F.current_timestamp()
    return now if arrival is None else F.coalesce(F.col(arrival).cast("timestamp"), now)


def clock_reason(time_ms: Column, arrival: Column, rules: ClockRules) -> Column:
    """Why the clock of an event rules it out: ``clock ahead``, ``late``, or null.

    It depends on the row alone, not on what else a stream has seen or how it is cut into batches, so a stream, its replay and a
    bounded table come to the same answer. A null time gives null.
    """
    ahead, step = time_ms - F.unix_millis(arrival), timedelta(milliseconds=1)
    reason = F.when(ahead > rules.most_ahead // step, "clock ahead")
    return reason if rules.most_late is None else reason.when(-ahead > rules.most_late // step, "late")


def clock_rejects(
    events: DataFrame, rules: ClockRules, time_ms: str = "event_time_ms", arrival: str | None = None
) -> DataFrame:
    """The events that ``rules`` leave out, with the ``reason``."""
    return events.withColumn("reason", clock_reason(F.col(time_ms), arrival_time(arrival), rules)).filter("reason IS NOT NULL")
