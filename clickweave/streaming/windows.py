"""Streaming sessions and windowed aggregates that need no custom state.

Each function takes a stream with an event-time column and sets the watermark itself, so late
rows are dropped by the operator that keeps state, and finished windows are emitted once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.functions.event_time import ClockRules, arrival_time, clock_reason
from clickweave.operators.analytics import windowed_activity
from clickweave.operators.sessions import tumbling_sessions, windowed_sessions

# Fixed value: how long a stream waits for late events unless told otherwise.
DEFAULT_DELAY = "10 minutes"


def right_clocks(events: DataFrame, event_time: str, clock: ClockRules | None, arrival: str | None) -> DataFrame:
    """The events that ``clock`` lets through; a single wrong clock would carry the watermark past all others.

    ``arrival`` is a timestamp column, by default the time of the micro-batch. A null time stays. None takes every time as it is.
    """
    if clock is None:
        return events
    return events.filter(clock_reason(F.unix_millis(F.col(event_time)), arrival_time(arrival), clock).isNull())


def stream_windowed_sessions(
    events: DataFrame,
    user: str = "uuid",
    event_time: str = "event_time",
    inactivity_minutes: float = 30,
    delay: str = DEFAULT_DELAY,
    clock: ClockRules | None = ClockRules(),
    arrival: str | None = None,
) -> DataFrame:
    """Inactivity-only sessions, each emitted when the watermark passes its end."""
    events = right_clocks(events, event_time, clock, arrival).withWatermark(event_time, delay)
    return windowed_sessions(events, user, event_time, inactivity_minutes=inactivity_minutes)


def stream_tumbling_sessions(
    events: DataFrame,
    user: str = "uuid",
    event_time: str = "event_time",
    width: str = "5 minutes",
    delay: str = DEFAULT_DELAY,
) -> DataFrame:
    """Event rows with their fixed window as the session. Stateless: rows pass straight through."""
    return tumbling_sessions(events.withWatermark(event_time, delay), user, event_time, width)


def stream_windowed_activity(
    events: DataFrame,
    keys: list[str],
    event_time: str = "timestamp",
    width: str = "30 minutes",
    delay: str = "30 minutes",
    total: str = "duration_seconds",
    counted: str = "page",
    clock: ClockRules | None = ClockRules(),
    arrival: str | None = None,
) -> DataFrame:
    """Sum and count per key and window."""
    events = right_clocks(events, event_time, clock, arrival).withWatermark(event_time, delay)
    return windowed_activity(events, keys, event_time, width, total, counted)
