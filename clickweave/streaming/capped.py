"""Streaming sessions under both rules, with keyed state.

Events are first counted per user and millisecond, spread over all tasks and combined before the shuffle, and held
back until the watermark has passed their second. What reaches the state are these moments, by bucket of users, in time order
whatever the arrival order, so the result equals the bounded ``greedy`` policy: a start depends on earlier moments only. Session
ids come from the session start and stay unique after a user's state has been removed.

Two outputs exist: finished sessions, and event rows, emitted as soon as the watermark passes their second with the
session end as known at that event. Event rows never enter Python: the starts of the moments are joined to them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from clickweave.functions.event_time import ClockRules, arrival_time, clock_reason
from clickweave.functions.layout import USER_BUCKETS
from clickweave.operators.sessions import SessionRules, usable_events
from clickweave.streaming.windows import DEFAULT_DELAY

# Spark starts a stream's first worker without the files of the application, so processors are shipped by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OPEN_SCHEMA = "start bigint, last bigint, events bigint"
# Users share their state's calls with those of the same bucket, by a hash of the user.
BUCKETS = 1024
# Moments are handed on once the watermark has passed the second they lie in.
SECOND_MS = 1000
DAY_MS = 86_400_000
STARTS = "session_start_time_ms bigint, _settled timestamp, _rows bigint"


def stream_capped_sessions(
    events: DataFrame,
    user: str = "uuid",
    time_ms: str = "event_time_ms",
    inactivity_minutes: float = 30,
    max_minutes: float = 120,
    delay: str | None = None,
    clock: ClockRules | None = ClockRules(),
    arrival: str | None = None,
    initial: DataFrame | None = None,
    boundary: Column | None = None,
) -> DataFrame:
    """One row per finished session. Needs the RocksDB state store.

    ``initial`` has the sessions that are open when the stream begins, such as ``SessionTable.open_sessions``: user,
    ``session_start_time_ms``, ``session_end_time_ms`` and ``event_count``. ``boundary`` is a condition on an event that also opens a new
    session, as on bounded tables. A task sees at most 1000 rows a user and second of event time, however busy the user is, and keeps nothing but the
    open sessions, a list for each of ``BUCKETS`` buckets of users. Events that break the ``clock`` rules are left out, see ``settling_events``.
    """
    rules = SessionRules(inactivity_minutes, max_minutes, "greedy")
    moments = _moments(settling_events(events, user, time_ms, delay, clock, arrival), user, time_ms, boundary)
    closed = _in_buckets(moments, user).transformWithStateInPandas(
        statefulProcessor=ClosedSessions(user, _kind(events, user), rules.gap_ms, rules.cap_ms),
        outputStructType=(
            f"`{user}` {_kind(events, user)}, session_start_time_ms bigint, session_end_time_ms bigint, event_count bigint"
        ),
        outputMode="append",
        timeMode="EventTime",
        initialState=_initial(initial, user),
    )
    return _describe(closed, user)


def stream_session_events(
    events: DataFrame,
    user: str = "uuid",
    time_ms: str = "event_time_ms",
    inactivity_minutes: float = 30,
    max_minutes: float = 120,
    delay: str | None = None,
    clock: ClockRules | None = ClockRules(),
    arrival: str | None = None,
    initial: DataFrame | None = None,
    boundary: Column | None = None,
    rows: str | None = None,
) -> DataFrame:
    """Event rows with session id, start and the end so far. Needs the RocksDB state store.

    ``initial`` and ``boundary`` as for ``stream_capped_sessions``. Column order and types of the input are kept. Moments are given their session start by user; a stream-stream join on
    user and moment brings the starts to the event rows, so the rows of one user are spread over all tasks. Both sides
    of the join are held until the watermark has passed their second, and no longer. Events that break the ``clock``
    rules are left out, see ``settling_events``. ``rows`` names one more column, by which a table of sessions can be written in few files: about
    how many rows the batch has for the row's partition of that table, see ``partition_rows``.
    """
    rules = SessionRules(inactivity_minutes, max_minutes, "greedy")
    settling = settling_events(events, user, time_ms, delay, clock, arrival)
    starts = _in_buckets(_moments(settling, user, time_ms, boundary), user).transformWithStateInPandas(
        statefulProcessor=MomentStarts(user, _kind(events, user), rules.gap_ms, rules.cap_ms),
        outputStructType=f"`{user}` {_kind(events, user)}, _moment bigint, {STARTS}",
        outputMode="append",
        timeMode="EventTime",
        initialState=_initial(initial, user),
        eventTimeColumnName="_settled",
    )
    starts = starts.withColumnsRenamed({user: "_user", "_settled": "_settled_at"})
    starts = starts.drop("_rows") if rows is None else starts
    same = (F.col(user) == F.col("_user")) & (F.col(time_ms) == F.col("_moment")) & (F.col("_settled") == F.col("_settled_at"))
    joined = settling.join(starts, same).withColumn("session_end_time_ms", F.col(time_ms))
    counted = [] if rows is None else [F.col("_rows").alias(rows)]
    return _describe(joined.select(*[f"`{c}`" for c in events.columns], "session_start_time_ms", "session_end_time_ms", *counted), user)


def settling_events(
    events: DataFrame, user: str, time_ms: str, delay: str | None, clock: ClockRules | None, arrival: str | None
) -> DataFrame:
    """Events that can belong to a session, with the end of their second in ``_settled`` and the watermark on it.

    A watermark follows the latest event time, so a single wrong clock would end the stream for everyone. ``clock``
    therefore leaves out events whose time is too far after or before their ``arrival`` (a timestamp column, by default the time
    of the micro-batch); ``clock_rejects`` has them. None takes every time as it is. ``delay`` is how long the watermark waits, by default
    what the rules need in order to lose nothing that they let through.
    """
    usable = usable_events(events, user, time_ms)
    if clock is not None:
        usable = usable.filter(clock_reason(F.col(time_ms), arrival_time(arrival), clock).isNull())
    second = F.floor(F.col(time_ms) / SECOND_MS).cast("bigint")
    wait = delay or (clock.watermark_delay if clock is not None and arrival is not None else DEFAULT_DELAY)
    return usable.withColumn("_settled", F.timestamp_millis((second + 1) * SECOND_MS)).withWatermark("_settled", wait)


def _moments(settling: DataFrame, user: str, time_ms: str, boundary: Column | None) -> DataFrame:
    cut = F.lit(False) if boundary is None else F.coalesce(F.max(boundary), F.lit(False))
    keys = (F.col(user), F.col(time_ms).alias("moment"), "_settled")
    counted = settling.groupBy(*keys).agg(F.count(F.lit(1)).alias("events"), cut.alias("cut"))
    # Python sees whole milliseconds only.
    return counted.select(user, "moment", "events", "cut")


def _initial(sessions: DataFrame | None, user: str):
    columns = (user, "session_start_time_ms", "session_end_time_ms", "event_count")
    return None if sessions is None else _in_buckets(sessions.select(*columns), user)


def _in_buckets(rows: DataFrame, user: str):
    bucket = F.pmod(F.xxhash64(user), F.lit(BUCKETS)).cast("int")
    return rows.withColumn("_bucket", bucket).groupBy("_bucket")


def _kind(events: DataFrame, column: str) -> str:
    return events.schema[column].dataType.simpleString()


def session_starts(
    moments: np.ndarray, start: int | None, last: int | None, gap_ms: int, cap_ms: int, cuts: np.ndarray | None = None
) -> np.ndarray:
    """Start of the session each moment belongs to, for moments in ascending order.

    ``start`` and ``last`` describe the open session, None if there is none; ``cuts`` marks moments that open a session of
    their own. One step per session, not per moment.
    """
    starts = np.empty(len(moments), dtype=np.int64)
    before = np.concatenate(([moments[0] if last is None else last], moments[:-1]))
    opens = moments - before > gap_ms
    if cuts is not None:
        opens |= cuts & (moments > before)
    breaks = np.flatnonzero(opens)
    at = 0
    if start is None:
        start = int(moments[0])
    while at < len(moments):
        if opens[at] or moments[at] - start > cap_ms:
            start = int(moments[at])
        capped = int(np.searchsorted(moments, start + cap_ms, side="right"))
        later = int(np.searchsorted(breaks, at, side="right"))
        until = min(capped, int(breaks[later]) if later < len(breaks) else len(moments))
        starts[at:until] = start
        at = until
    return starts


def partition_rows(codes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """About how many events a batch has for the partition, by date and user bucket, of each moment's session.

    It is told from one bucket of users alone, by their ``codes``, with the moments of a user in ascending order: a partition has the user's own
    events of the day, of which there may be very many, and its share of those of other users, who are dealt evenly over the
    buckets. Days are those of UTC.
    """
    days = starts // DAY_MS
    edges = np.flatnonzero((np.diff(codes, prepend=-1) != 0) | (np.diff(days, prepend=days[0]) != 0))
    own = np.add.reduceat(counts, edges)
    _, day = np.unique(days[edges], return_inverse=True)
    others = np.bincount(day, weights=own).astype(np.int64)[day] - own
    return np.repeat(own + others * BUCKETS // USER_BUCKETS, np.diff(edges, append=len(codes)))


class _PerBucket(StatefulProcessor):
    """State and timer handling shared by both processors: the open sessions of the users of one bucket.

    A call into the state costs as much as many users' sessions, so there is one list for all of them, read and written whole,
    and one timer, for the first of them to expire.
    """

    def __init__(self, user: str, kind: str, gap_ms: int, cap_ms: int):
        self.user, self.kind, self.gap_ms, self.cap_ms = user, kind, gap_ms, cap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", f"user {self.kind}, {OPEN_SCHEMA}")

    def wake_at(self, times: list[int]) -> None:
        """Keep one timer, at the earliest of the given times."""
        wanted, known = min(times, default=None), set(self.handle.listTimers())
        for timer in known:
            if timer != wanted:
                self.handle.deleteTimer(timer)
        if wanted is not None and wanted not in known:
            self.handle.registerTimer(wanted)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        columns = (initialState[c].tolist() for c in (self.user, "session_start_time_ms", "session_end_time_ms", "event_count"))
        sessions = self.sessions()
        for user, *session in zip(*columns):
            sessions.setdefault(user, tuple(map(int, session)))
        self.keep_open(sessions, timerValues)

    def sessions(self) -> dict:
        """The open session of each user: start, last moment, events."""
        return {user: (start, last, events) for user, start, last, events in self.open.get()}

    def keep_open(self, sessions: dict, timerValues) -> list[tuple]:
        """Keep the open sessions and a timer; the sessions that no event can join any more are returned."""
        # Moments of a second that the watermark has not left may still be on their way.
        settled = timerValues.getCurrentWatermarkInMs() // SECOND_MS * SECOND_MS
        kept, closed, times = [], [], []
        for user, session in sessions.items():
            expires = session[1] + self.gap_ms + 1
            if expires <= settled - 1:
                closed.append((user, *session))
            else:
                kept.append((user, *session))
                times.append(-(-(expires + 1) // SECOND_MS) * SECOND_MS)
        if kept:
            self.open.put(kept)
        else:
            self.open.clear()
        self.wake_at(times)
        return closed

    def by_user(self, rows: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """Each user with its moments in ascending order, their counts of events and cuts; users have their rows together."""
        settled = pd.concat([batch[[self.user, "moment", "events", "cut"]] for batch in rows])
        codes, users = pd.factorize(settled[self.user], use_na_sentinel=False)
        moments = settled["moment"].to_numpy(dtype=np.int64)
        order = np.lexsort((moments, codes))
        edges = np.cumsum(np.bincount(codes, minlength=len(users)))[:-1]
        columns = (moments, settled["events"].to_numpy(dtype=np.int64), settled["cut"].to_numpy(dtype=bool))
        yield from zip(users.tolist(), *(np.split(c[order], edges) for c in columns))

    def close(self) -> None:
        pass


class ClosedSessions(_PerBucket):
    """Emit each session once, when no event can join it any more.

    Moments arrive after the watermark has settled them: later batches hold later moments only.
    """

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        sessions, done = self.sessions(), []
        for user, moments, counts, cuts in self.by_user(rows):
            start, last, events = sessions.get(user, (None, None, 0))
            starts = session_starts(moments, start, last, self.gap_ms, self.cap_ms, cuts)
            edges = np.flatnonzero(np.diff(starts, prepend=starts[0] - 1))
            totals = np.add.reduceat(counts, edges)
            ends = moments[np.append(edges[1:], len(moments)) - 1]
            for begin, end, total in zip(starts[edges].tolist(), ends.tolist(), totals.tolist()):
                if begin == start:
                    last, events = end, events + total
                    continue
                if start is not None:
                    done.append((user, start, last, events))
                start, last, events = begin, end, total
            sessions[user] = (start, last, events)
        yield from self.settle(done, sessions, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.settle([], self.sessions(), timerValues)

    def settle(self, done: list[tuple], sessions: dict, timerValues) -> Iterator[pd.DataFrame]:
        done = done + self.keep_open(sessions, timerValues)
        if done:
            yield pd.DataFrame(done, columns=[self.user, "session_start_time_ms", "session_end_time_ms", "event_count"])


class MomentStarts(_PerBucket):
    """Emit each moment at once with the start of its session."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        sessions, users, found = self.sessions(), [], []
        for code, (user, moments, counts, cuts) in enumerate(self.by_user(rows)):
            start, last, _ = sessions.get(user, (None, None, 0))
            starts = session_starts(moments, start, last, self.gap_ms, self.cap_ms, cuts)
            sessions[user] = (int(starts[-1]), int(moments[-1]), 0)
            users += [user] * len(moments)
            found.append((moments, starts, counts, np.full(len(moments), code)))
        self.keep_open(sessions, timerValues)
        moments, starts, counts, codes = map(np.concatenate, zip(*found))
        ends = (moments // SECOND_MS + 1) * SECOND_MS
        ends = pd.Series(ends.astype("datetime64[ms]")).dt.tz_localize("UTC")
        about = partition_rows(codes, starts, counts)
        yield pd.DataFrame({self.user: users, "_moment": moments, "session_start_time_ms": starts, "_settled": ends, "_rows": about})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.keep_open(self.sessions(), timerValues)
        return iter(())


def _describe(df: DataFrame, user: str) -> DataFrame:
    start, end = F.col("session_start_time_ms"), F.col("session_end_time_ms")
    return df.withColumns(
        {
            "session_id": F.concat(F.col(user).cast("string"), F.lit("_session_"), start.cast("string")),
            "session_duration_seconds": (end - start) / 1000.0,
            "session_start_time": F.timestamp_millis(start),
            "session_end_time": F.timestamp_millis(end),
        }
    )
