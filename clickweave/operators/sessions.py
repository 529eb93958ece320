"""Session detection on bounded tables.

A user's events form *islands*: runs in which no gap exceeds the inactivity limit. A cap policy
then says what happens to an island that lasts longer than the duration limit:

``bin``
    cut the island into fixed windows of the cap length, counted from its first event;
``greedy``
    start a new session at the first event more than the cap after the current session's start,
    and measure the cap again from there;
``truncate``
    keep one session and clip its end.

Most users are handled by window functions after a single exchange on the user. Users with more
rows than one task should hold are found first by a counting pass and take the path in
``busy_users``, which never gathers one user in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.operators import busy_users

POLICIES = ("bin", "greedy", "truncate")


@dataclass(frozen=True)
class SessionRules:
    """Limits in minutes and the policy for islands longer than the cap."""

    inactivity_minutes: float = 30
    max_minutes: float = 120
    policy: str = "bin"

    def __post_init__(self):
        if self.inactivity_minutes <= 0 or self.max_minutes <= 0:
            raise ValueError("inactivity and maximum duration must be positive")
        if self.inactivity_minutes >= self.max_minutes:
            raise ValueError("inactivity must be shorter than the maximum duration")
        if self.policy not in POLICIES:
            raise ValueError(f"policy must be one of {POLICIES}, not {self.policy!r}")

    @property
    def gap_ms(self) -> int:
        return round(self.inactivity_minutes * 60_000)

    @property
    def cap_ms(self) -> int:
        return round(self.max_minutes * 60_000)


def usable_events(df: DataFrame, user: str = "uuid", time_ms: str = "event_time_ms") -> DataFrame:
    """Events that can belong to a session; see ``count_unusable`` for the others."""
    return df.filter(F.col(user).isNotNull() & F.col(time_ms).isNotNull())


def count_unusable(df: DataFrame, user: str = "uuid", time_ms: str = "event_time_ms") -> DataFrame:
    """One row: how many events have no user and how many have no readable time."""
    return df.agg(
        F.count_if(F.col(user).isNull()).alias("null_user"),
        F.count_if(F.col(time_ms).isNull()).alias("null_time"),
        F.count(F.lit(1)).alias("total"),
    )


def session_gaps(
    df: DataFrame,
    user: str = "uuid",
    time_ms: str = "event_time_ms",
    tie_break: str = "event_id",
    busy: busy_users.BusyUsers | None = busy_users.BusyUsers(),
) -> DataFrame:
    """Milliseconds since the same user's previous event, null for the first one."""
    small, large = busy_users.separate(usable_events(df, user, time_ms), user, busy)
    order = Window.partitionBy(user).orderBy(time_ms, tie_break)
    gaps = small.withColumn("gap_ms", F.col(time_ms) - F.lag(time_ms).over(order))
    if large is not None:
        gaps = gaps.unionByName(busy_users.gaps(large, user, time_ms, tie_break, busy))
    return gaps


def session_islands(
    df: DataFrame,
    user: str = "uuid",
    time_ms: str = "event_time_ms",
    inactivity_minutes: float = 30,
    boundary: Column | None = None,
    busy: busy_users.BusyUsers | None = busy_users.BusyUsers(),
) -> DataFrame:
    """Number each user's islands from 1 and attach the island start; no cap is applied."""
    rules = SessionRules(inactivity_minutes, inactivity_minutes + 1, "truncate")
    return _split(df, user, time_ms, rules, boundary, busy, capped=False).withColumnsRenamed(
        {"_island": "island", "_island_start": "island_start_ms"}
    )


def detect_sessions(
    df: DataFrame,
    user: str = "uuid",
    time_ms: str = "event_time_ms",
    inactivity_minutes: float = 30,
    max_minutes: float = 120,
    policy: str = "bin",
    boundary: Column | None = None,
    busy: busy_users.BusyUsers | None = busy_users.BusyUsers(),
    earlier: str | None = None,
) -> DataFrame:
    """Attach session id, start, end and duration to every event row.

    ``boundary`` is an optional condition that also opens a new session, for example
    ``F.col("page_name") == "logout"``. ``busy`` sets when a user counts as too large for one
    task; ``None`` skips the counting pass for tables known to have no such user. ``earlier`` names a
    column with the number of sessions (islands under ``bin``) that the user had before these events; numbers in ids go on from there.
    """
    rules = SessionRules(inactivity_minutes, max_minutes, policy)
    marked = _split(df, user, time_ms, rules, boundary, busy)
    if earlier is not None:
        marked = marked.withColumn("_island", F.col("_island") + F.coalesce(F.col(earlier), F.lit(0)))
    return _describe(marked, df.columns, user, rules)


def rollup_sessions(
    sessions: DataFrame,
    user: str = "uuid",
    time_ms: str = "event_time_ms",
    cap_minutes: float | None = None,
) -> DataFrame:
    """One row per session from the rows of ``detect_sessions``.

    Built from mergeable aggregates only, so a long session is reduced before it is shuffled.
    ``cap_minutes`` clips the end, which policy ``truncate`` needs.
    """
    start, end = F.min(time_ms), F.max(time_ms)
    if cap_minutes is not None:
        end = F.least(end, start + round(cap_minutes * 60_000))
    return (
        sessions.groupBy(user, "session_id")
        .agg(
            start.alias("session_start_time_ms"),
            end.alias("session_end_time_ms"),
            F.count(F.lit(1)).alias("event_count"),
        )
        .withColumn("session_duration_seconds", _seconds())
    )


def session_paths(
    sessions: DataFrame,
    page: str = "page_name",
    user: str = "uuid",
    time_ms: str = "event_time_ms",
    tie_break: str = "event_id",
    part_events: int = 10_000,
    busy: busy_users.BusyUsers | None = busy_users.BusyUsers(),
) -> DataFrame:
    """Each session with its roll-up and its pages in visiting order, one row per ``part_events`` pages.

    A session of ordinary size is one row with ``part`` 0. A longer one continues in further
    rows, so no page is lost and no array outgrows a task; every one of them carries start, end, event
    count and duration of the whole session.
    """
    small, large = busy_users.separate(sessions, user, busy)
    order = Window.partitionBy(user, "session_id").orderBy(time_ms, tie_break)
    numbered = small.withColumn("_position", F.row_number().over(order).cast("bigint") - 1)
    if large is not None:
        numbered = numbered.unionByName(
            busy_users.number_within_session(large, user, time_ms, tie_break, busy)
        )
    part = F.floor(F.col("_position") / part_events)
    whole = Window.partitionBy(user, "session_id")
    visits = F.array_sort(F.collect_list(F.struct("_position", F.col(page).alias("page"))))
    return (
        numbered.groupBy(user, "session_id", part.alias("part"))
        .agg(
            visits.alias("_visits"),
            F.min(time_ms).alias("_first"),
            F.max(time_ms).alias("_last"),
            F.count(F.lit(1)).alias("_events"),
        )
        .withColumns(
            {
                "session_start_time_ms": F.min("_first").over(whole),
                "session_end_time_ms": F.max("_last").over(whole),
                "event_count": F.sum("_events").over(whole),
            }
        )
        .select(
            user,
            "session_id",
            "part",
            F.col("_visits.page").alias("pages_visited"),
            "session_start_time_ms",
            "session_end_time_ms",
            "event_count",
            _seconds().alias("session_duration_seconds"),
        )
    )


def windowed_sessions(
    df: DataFrame,
    user: str = "uuid",
    event_time: str = "event_time",
    time_ms: str = "event_time_ms",
    inactivity_minutes: float = 30,
    busy: busy_users.BusyUsers | None = busy_users.BusyUsers(),
) -> DataFrame:
    """Inactivity-only sessions by the built-in session window, one row per session.

    Works on streams as well. On bounded tables busy users are merged slice by slice instead,
    because a session window sorts all of a user's events in one task. Events without user or
    readable time are left out, as everywhere.
    """
    events = usable_events(df, user, time_ms)
    small, large = (events, None) if df.isStreaming else busy_users.separate(events, user, busy)
    gap = f"{round(inactivity_minutes * 60_000)} milliseconds"
    window = F.session_window(F.timestamp_millis(time_ms), gap)
    if df.isStreaming:
        window = F.session_window(event_time, gap)
    rows = small.groupBy(F.col(user), window.alias("_w")).agg(
        F.min(time_ms).alias("session_start_time_ms"),
        F.max(time_ms).alias("session_end_time_ms"),
        F.count(F.lit(1)).alias("event_count"),
    )
    if large is not None:
        islands = session_islands(large, user, time_ms, inactivity_minutes, busy=busy)
        rows = rows.unionByName(
            islands.groupBy(user, F.col("island_start_ms").alias("session_start_time_ms"))
            .agg(
                F.max(time_ms).alias("session_end_time_ms"),
                F.count(F.lit(1)).alias("event_count"),
            )
            .withColumn("_w", F.lit(None)),
            allowMissingColumns=True,
        )
    return rows.select(
        user,
        start_based_id(F.col(user), F.col("session_start_time_ms")).alias("session_id"),
        "session_start_time_ms",
        "session_end_time_ms",
        "event_count",
        _seconds().alias("session_duration_seconds"),
    )


def tumbling_sessions(
    df: DataFrame, user: str = "uuid", event_time: str = "event_time", width: str = "5 minutes"
) -> DataFrame:
    """Give every event the fixed window it falls in as its session.

    A narrow projection: windows are a function of the event alone, so nothing is grouped, and
    the same code serves bounded and streaming tables. All input columns are kept.
    """
    bounded = df.withColumn("_w", F.window(event_time, width))
    start, end = F.unix_millis("_w.start"), F.unix_millis("_w.end")
    return (
        bounded.withColumns(
            {
                "session_id": start_based_id(F.col(user), start),
                "session_start_time_ms": start,
                "session_end_time_ms": end,
                "session_duration_seconds": (end - start) / 1000.0,
            }
        )
        .withColumn("session_start_time", F.col("_w.start"))
        .withColumn("session_end_time", F.col("_w.end"))
        .drop("_w")
    )


def running_session_end(
    sessions: DataFrame, user: str = "uuid", time_ms: str = "event_time_ms"
) -> DataFrame:
    """The session end as known at each event: the latest time seen so far in its session.

    Events are taken in time order, so that is the event's own time.
    """
    end = F.col(time_ms)
    return sessions.withColumns(
        {
            "running_end_time_ms": end,
            "running_duration_seconds": (end - F.col("session_start_time_ms")) / 1000.0,
        }
    )


def start_based_id(user: Column, start_ms: Column) -> Column:
    """A session id that does not depend on counting earlier sessions."""
    return F.concat(user.cast("string"), F.lit("_session_"), start_ms.cast("string"))


def _seconds() -> Column:
    return (F.col("session_end_time_ms") - F.col("session_start_time_ms")) / 1000.0


def _split(df, user, time_ms, rules, boundary, busy, capped=True) -> DataFrame:
    events = usable_events(df, user, time_ms)
    if boundary is not None:
        events = events.withColumn("_cut", F.coalesce(boundary, F.lit(False)))
    small, large = busy_users.separate(events, user, busy)
    marked = _mark_islands(small, user, time_ms, rules, boundary is not None)
    if capped:
        marked = _apply_cap(marked, user, time_ms, rules)
    if large is not None:
        marked = marked.unionByName(
            busy_users.mark_sessions(large, user, time_ms, rules, boundary is not None, busy, capped)
        )
    return marked.drop("_cut")


def _mark_islands(events: DataFrame, user, time_ms, rules: SessionRules, with_cut: bool) -> DataFrame:
    # The default frame of an ordered window takes in equal times, so ties share an island.
    timeline = Window.partitionBy(user).orderBy(time_ms)
    now, previous = F.col(time_ms), F.col("_previous")
    opens = previous.isNull() | (now - previous > rules.gap_ms)
    events = events.withColumn("_previous", F.lag(time_ms).over(timeline))
    if with_cut:
        same_time = Window.partitionBy(user, time_ms)
        events = events.withColumn("_cut", F.max("_cut").over(same_time))
        opens = opens | (F.col("_cut") & (now > previous))
    return (
        events.withColumn("_opens", opens)
        .withColumn("_island", F.sum(F.col("_opens").cast("bigint")).over(timeline))
        .withColumn("_island_start", F.max(F.when(F.col("_opens"), now)).over(timeline))
        .drop("_previous", "_opens")
    )


def _apply_cap(marked: DataFrame, user, time_ms, rules: SessionRules) -> DataFrame:
    offset = F.col(time_ms) - F.col("_island_start")
    if rules.policy == "greedy":
        return _greedy(marked, user, time_ms, rules)
    bin_number = F.floor(offset / rules.cap_ms) if rules.policy == "bin" else F.lit(0).cast("bigint")
    session = Window.partitionBy(user, "_island", "_part")
    return marked.withColumn("_part", bin_number).withColumns(
        {
            "session_start_time_ms": F.min(time_ms).over(session),
            "session_end_time_ms": clipped(F.max(time_ms).over(session), rules),
        }
    )


def _greedy(marked: DataFrame, user, time_ms, rules: SessionRules) -> DataFrame:
    """Re-anchored starts come from a fold over the few events beyond the cap of their island.

    They go back among the events as marker rows at their times, so one more window over the same timeline tells
    every event how many restarts it has seen and which was the last, however many there are.
    """
    late = F.when(F.col(time_ms) - F.col("_island_start") > rules.cap_ms, F.col(time_ms))
    islands = (
        marked.groupBy(user, "_island_start")
        .agg(F.array_sort(F.collect_list(late)).alias("_late"))
        .filter(F.size("_late") > 0)
    )
    empty = F.array().cast("array<bigint>")
    first = F.struct(F.col("_island_start").alias("start"), empty.alias("found"))

    def step(state, now):
        return F.when(
            now - state["start"] > rules.cap_ms,
            F.struct(now.alias("start"), F.array_append(state["found"], now).alias("found")),
        ).otherwise(state)

    folded = F.aggregate("_late", first, step, lambda state: state["found"])
    restarts = islands.select(user, F.explode(folded).alias(time_ms), F.lit(1).alias("_restart"))
    timeline = Window.partitionBy(user).orderBy(time_ms)
    session = Window.partitionBy(user, "session_start_time_ms")
    return (
        marked.withColumn("_restart", F.lit(0))
        .unionByName(restarts, allowMissingColumns=True)
        .withColumns(
            {
                "_part": F.sum("_restart").over(timeline),
                "_restarted": F.max(F.when(F.col("_restart") == 1, F.col(time_ms))).over(timeline),
            }
        )
        .filter("_restart = 0")
        .withColumn("session_start_time_ms", F.greatest("_island_start", "_restarted"))
        .withColumn("session_end_time_ms", F.max(time_ms).over(session))
        .drop("_restart", "_restarted")
    )


def clipped(end: Column, rules: SessionRules) -> Column:
    if rules.policy != "truncate":
        return end
    return F.least(end, F.col("_island_start") + rules.cap_ms)


def _describe(marked: DataFrame, columns: list[str], user: str, rules: SessionRules) -> DataFrame:
    if rules.policy == "bin":
        number = F.concat_ws("_", "_island", "_part")
    elif rules.policy == "greedy":
        number = (F.col("_island") + F.col("_part")).cast("string")
    else:
        number = F.col("_island").cast("string")
    return marked.select(
        *columns,
        F.concat(F.col(user).cast("string"), F.lit("_session_"), number).alias("session_id"),
        "session_start_time_ms",
        "session_end_time_ms",
        _seconds().alias("session_duration_seconds"),
        F.timestamp_millis("session_start_time_ms").alias("session_start_time"),
        F.timestamp_millis("session_end_time_ms").alias("session_end_time"),
    )
