"""Sessions of users too large for one task.

A bot or a shared key may own a large share of all events. Its timeline is reduced to distinct
moments (one row per user and millisecond, combined before the shuffle), cut into slices of fixed
length and spread by (user, slice). A slice of one hour holds at most 3.6 million moments whatever
the number of events. What one slice must tell the next fits in one summary row.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.session import cut_lineage


@dataclass(frozen=True)
class BusyUsers:
    """When a user is handled apart.

    ``rows``: users with more events than this are busy. ``limit``: at most this many users are
    listed, the largest ones; by counting, any user beyond the list owns less than 1/limit of the
    table, which an ordinary task can sort. ``slice_minutes``: length of one timeline slice.
    ``known``: ids found earlier by ``measure_busy``, to save the counting job. ``summary``: counters
    of the summary that users are looked for with first; 0 counts all users at once.
    """

    rows: int = 1_000_000
    limit: int = 100_000
    slice_minutes: int = 60
    known: tuple | None = None
    summary: int = 1 << 20

    @property
    def slice_ms(self) -> int:
        return self.slice_minutes * 60_000


def measure_busy(df: DataFrame, user: str = "uuid", busy: BusyUsers = BusyUsers()) -> BusyUsers:
    """Count once and remember the busy users, for several operators over the same events.

    Reads the user column only. At most ``limit`` ids reach the driver.
    """
    return replace(busy, known=tuple(row[0] for row in busy_counts(df, user, busy).select(user).collect()))


def busy_counts(df: DataFrame, user: str = "uuid", busy: BusyUsers = BusyUsers()) -> DataFrame:
    """The busy users and their ``rows``, exactly.

    Users are counted by a hash first. Every task sends at most ``summary`` counters, whatever the number of users, and
    counters add up. A user of more than ``rows`` rows is behind a counter of more than that, so none is missed; most tables have no such
    counter and are done. Otherwise the users behind those counters, at most ``summary`` of which are broadcast, are counted one by one.
    """
    rows = df.select(user)
    if busy.summary:
        counter = F.pmod(F.xxhash64(user), F.lit(busy.summary)).alias("_counter")
        high = rows.groupBy(counter).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > busy.rows)
        found = [(row[0],) for row in high.select("_counter").collect()]
        candidates = rows.sparkSession.createDataFrame(found, "_counter bigint")
        rows = rows.withColumn("_counter", counter).join(F.broadcast(candidates), "_counter", "left_semi")
    counts = rows.groupBy(user).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > busy.rows)
    return counts.orderBy(F.desc("rows")).limit(busy.limit)


def list_busy(df: DataFrame, user: str, busy: BusyUsers) -> DataFrame | None:
    """The busy users of a table as a one-column table small enough to broadcast, or None."""
    ids = busy.known if busy.known is not None else measure_busy(df, user, busy).known
    if not ids:
        return None
    schema = df.select(user).schema
    return df.sparkSession.createDataFrame([(value,) for value in ids], schema)


def separate(df: DataFrame, user: str, busy: BusyUsers | None) -> tuple[DataFrame, DataFrame | None]:
    """Split a table into ordinary and busy users; the second is None when there are none."""
    ids = list_busy(df, user, busy) if busy is not None else None
    if ids is None:
        return df, None
    ids = F.broadcast(ids)
    return df.join(ids, user, "left_anti"), df.join(ids, user, "left_semi")


def mark_sessions(events: DataFrame, user, time_ms, rules, with_cut, busy, capped=True) -> DataFrame:
    """The same columns the window path adds, computed slice by slice."""
    moments = cut_lineage(_moments(events, user, time_ms, with_cut))
    placed = cut_lineage(_place_in_islands(moments, user, rules.gap_ms, busy.slice_ms))
    if capped:
        placed = _place_in_sessions(placed, user, rules, busy.slice_ms)
    keys = placed.withColumnRenamed("_ms", time_ms).drop("_events", "_slice", "_cut")
    return events.join(keys, [user, time_ms])


def gaps(events: DataFrame, user, time_ms, tie_break, busy) -> DataFrame:
    """Add ``gap_ms``: time since the previous moment for the first event of a moment, else 0.

    Of the events of one moment the first in the order of ``tie_break`` (nulls first) gets the gap; of
    events that repeat its ``tie_break`` too, one of them does.
    """
    inside = Window.partitionBy(user, "_slice").orderBy("_ms")
    slices = Window.partitionBy(user).orderBy("_slice")
    moments = cut_lineage(
        events.groupBy(user, F.col(time_ms).alias("_ms"))
        .agg(F.count(F.lit(1)).alias("_events"))
        .withColumn("_slice", F.floor(F.col("_ms") / busy.slice_ms))
        .withColumn("_previous", F.lag("_ms").over(inside))
    )
    carried = (
        moments.groupBy(user, "_slice")
        .agg(F.max("_ms").alias("last"))
        .select(user, "_slice", F.lag("last").over(slices).alias("_carried"))
    )
    previous = moments.join(carried, [user, "_slice"]).select(
        user,
        F.col("_ms").alias(time_ms),
        "_events",
        F.coalesce("_previous", "_carried").alias("_previous"),
    )
    joined = events.join(previous, [user, time_ms])
    # Only events that share their millisecond have to be ranked.
    same_moment = Window.partitionBy(user, time_ms).orderBy(tie_break)
    alone = joined.filter("_events = 1").withColumn("_place", F.lit(1))
    shared = joined.filter("_events > 1").withColumn("_place", F.row_number().over(same_moment))
    gap = F.when(F.col("_place") > 1, F.lit(0)).otherwise(F.col(time_ms) - F.col("_previous"))
    return alone.unionByName(shared).withColumn("gap_ms", gap).drop("_previous", "_events", "_place")


def number_within_session(sessions: DataFrame, user, time_ms, tie_break, busy) -> DataFrame:
    """Add ``_position``: events of the same session before this one.

    Positions are counted moment by moment, so only events of one millisecond are ranked together.
    """
    slices = F.floor(F.col("_ms") / busy.slice_ms)
    counted = cut_lineage(
        sessions.groupBy(user, "session_id", F.col(time_ms).alias("_ms"))
        .agg(F.count(F.lit(1)).alias("_events"))
        .withColumn("_slice", slices)
    )
    keys = [user, "session_id", "_slice"]
    earlier_rows = (Window.unboundedPreceding, -1)
    in_slice = Window.partitionBy(*keys).orderBy("_ms").rowsBetween(*earlier_rows)
    slice_order = Window.partitionBy(user, "session_id").orderBy("_slice").rowsBetween(*earlier_rows)
    carried = (
        counted.groupBy(*keys)
        .agg(F.sum("_events").alias("_sum"))
        .select(*keys, F.coalesce(F.sum("_sum").over(slice_order), F.lit(0)).alias("_carried"))
    )
    before = F.coalesce(F.sum("_events").over(in_slice), F.lit(0))
    ranked = (
        counted.withColumn("_in_slice", before)
        .join(carried, keys)
        .select(
            user,
            "session_id",
            F.col("_ms").alias(time_ms),
            (F.col("_carried") + F.col("_in_slice")).alias("_before"),
        )
    )
    same_moment = Window.partitionBy(user, "session_id", time_ms).orderBy(tie_break)
    return (
        sessions.join(ranked, [user, "session_id", time_ms])
        .withColumn("_position", F.col("_before") + F.row_number().over(same_moment) - 1)
        .drop("_before")
    )


def _moments(events: DataFrame, user, time_ms, with_cut) -> DataFrame:
    cut = F.bool_or("_cut") if with_cut else F.lit(False)
    return events.groupBy(user, F.col(time_ms).alias("_ms")).agg(
        F.count(F.lit(1)).alias("_events"), cut.alias("_cut")
    )


def _place_in_islands(moments: DataFrame, user, gap_ms, slice_ms) -> DataFrame:
    """Island number and start of every moment.

    Inside a slice this is the ordinary window computation, except for the slice's first moment.
    The summaries of a user's slices, one row each, settle those and carry numbers forward.
    """
    inside = Window.partitionBy(user, "_slice").orderBy("_ms")
    previous = F.col("_previous")
    opens = previous.isNotNull() & ((F.col("_ms") - previous > gap_ms) | F.col("_cut"))
    local = cut_lineage(
        moments.withColumn("_slice", F.floor(F.col("_ms") / slice_ms))
        .withColumn("_previous", F.lag("_ms").over(inside))
        .withColumn("_opens", opens)
        .withColumn("_opened", F.sum(F.col("_opens").cast("bigint")).over(inside))
        .withColumn("_opened_at", F.max(F.when(F.col("_opens"), F.col("_ms"))).over(inside))
        .drop("_previous", "_opens")
    )
    summary = local.groupBy(user, "_slice").agg(
        F.min("_ms").alias("first"),
        F.min_by("_cut", "_ms").alias("first_cut"),
        F.max("_ms").alias("last"),
        F.max("_opened").alias("opened"),
        F.max("_opened_at").alias("opened_at"),
    )
    slices = Window.partitionBy(user).orderBy("_slice")
    earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
    continues = F.col("first") - F.lag("last").over(slices) <= gap_ms
    opens_first = ~(F.coalesce(continues, F.lit(False)) & ~F.col("first_cut"))
    own_start = F.coalesce("opened_at", F.when(F.col("opens_first"), F.col("first")))
    carried = (
        summary.withColumn("opens_first", opens_first)
        .withColumn("total", F.col("opened") + F.col("opens_first").cast("bigint"))
        .withColumn("own_start", own_start)
        .withColumn("before", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
        .withColumn("start_before", F.max("own_start").over(earlier))
        .select(
            user,
            "_slice",
            (F.col("before") + F.col("opens_first").cast("bigint")).alias("_base"),
            F.when(F.col("opens_first"), F.col("first"))
            .otherwise(F.col("start_before"))
            .alias("_base_start"),
        )
    )
    return (
        local.join(carried, [user, "_slice"])
        .withColumn("_island", F.col("_base") + F.col("_opened"))
        .withColumn("_island_start", F.coalesce("_opened_at", "_base_start"))
        .drop("_base", "_base_start", "_opened", "_opened_at")
    )


def _place_in_sessions(placed: DataFrame, user, rules, slice_ms) -> DataFrame:
    offset = F.col("_ms") - F.col("_island_start")
    if rules.policy == "greedy":
        placed = _restart_counts(placed, user, rules.cap_ms, slice_ms)
    elif rules.policy == "bin":
        placed = placed.withColumn("_part", F.floor(offset / rules.cap_ms))
    else:
        placed = placed.withColumn("_part", F.lit(0).cast("bigint"))
    keys = [user, "_island", "_part"]
    end = F.max("_ms")
    if rules.policy == "truncate":
        end = F.least(end, F.min("_island_start") + rules.cap_ms)
    bounds = placed.groupBy(*keys).agg(
        F.min("_ms").alias("session_start_time_ms"), end.alias("session_end_time_ms")
    )
    return placed.join(bounds, keys)


def _restart_counts(placed: DataFrame, user, cap_ms, slice_ms) -> DataFrame:
    """Greedy policy: ``_part`` is the number of restarts of this user up to each moment."""
    keys = [user, "_slice"]
    restarts = _restarts(placed, user, cap_ms, slice_ms).select(
        user, F.col("_ms").alias("restart"), F.floor(F.col("_ms") / slice_ms).alias("_slice")
    )
    # Restarts lie at least one cap apart, so both the per-slice lists and the rows per user
    # in the running count are few.
    per_slice = restarts.groupBy(*keys).agg(F.collect_list("restart").alias("_in_slice"))
    earlier = (
        Window.partitionBy(user).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = (
        placed.select(*keys)
        .distinct()
        .join(per_slice, keys, "left")
        .withColumn("_count", F.greatest(F.size(F.coalesce("_in_slice", F.array())), F.lit(0)))
        .withColumn("_earlier", F.coalesce(F.sum("_count").over(earlier), F.lit(0)))
        .select(*keys, "_in_slice", "_earlier")
    )
    passed = F.size(F.filter(F.coalesce("_in_slice", F.array()), lambda s: s <= F.col("_ms")))
    return (
        placed.join(counts, keys)
        .withColumn("_part", (F.col("_earlier") + passed).cast("bigint"))
        .drop("_in_slice", "_earlier")
    )


def _restarts(placed: DataFrame, user, cap_ms, slice_ms) -> DataFrame:
    """Greedy restarts by pointer doubling.

    Every moment of a long island points to the first moment more than one cap later. The
    restarts are the moments reachable from the island start. Pointers over 1, 2, 4, ... steps
    are composed until they span the longest island, then followed from the longest step down.
    A pointer is kept only for moments that some pointer of the same length reaches; chains merge
    quickly, so the tables shrink from round to round.
    """
    bin_number = F.floor((F.col("_ms") - F.col("_island_start")) / cap_ms)
    binned = placed.select(user, "_island", "_island_start", "_ms", bin_number.alias("bin"))
    long_islands = binned.groupBy(user, "_island").agg(F.max("bin").alias("bins")).filter("bins > 0")
    binned = cut_lineage(binned.join(long_islands, [user, "_island"]))
    # A session covers more than one cap, so the number of bins bounds the length of a chain.
    longest = binned.agg(F.max("bins")).first()[0] or 0
    starts = binned.filter(F.col("_ms") == F.col("_island_start")).select(user, "_ms")

    pointers = []
    jump = _next_after_cap(binned, user, cap_ms, slice_ms)
    for _ in range(longest.bit_length()):
        if pointers:
            onward = jump.select(user, F.col("_ms").alias("_next"), F.col("_next").alias("_after"))
            jump = jump.join(onward, [user, "_next"]).select(
                user, "_ms", F.col("_after").alias("_next")
            )
        reachable = jump.select(user, F.col("_next").alias("_ms")).distinct().union(starts)
        jump = cut_lineage(jump.join(reachable, [user, "_ms"], "left_semi"))
        pointers.append(jump)

    # Every moment of the chain so far keeps its place and adds the one its pointer leads to.
    reached = starts
    for jump in reversed(pointers):
        both = F.explode(F.array_compact(F.array("_ms", "_next")))
        reached = reached.join(jump, [user, "_ms"], "left").select(user, both.alias("_ms"))
    return cut_lineage(reached.join(starts, [user, "_ms"], "left_anti"))


def _next_after_cap(moments: DataFrame, user, cap_ms, slice_ms) -> DataFrame:
    """For each moment, the first moment of its island more than one cap later.

    A moment asks at its own time plus the cap, in the slice that time lies in, and is answered by the first later moment of
    that slice, failing that by the first moment of the user's next slice that has one. That slices carry to each other as
    one summary row. A slice has at most one moment and one question per millisecond, however long the cap is.
    """
    group = [user, "_slice"]
    targets = moments.select(user, "_island", F.col("_ms").alias("at"), F.lit(None).cast("bigint").alias("asks"))
    questions = moments.select(user, "_island", (F.col("_ms") + cap_ms).alias("at"), F.col("_ms").alias("asks"))
    both = targets.union(questions).withColumn("_slice", F.floor(F.col("at") / slice_ms))
    # Backwards in time; at equal times the question comes first, so it sees later moments only.
    backwards = (
        Window.partitionBy(*group)
        .orderBy(F.desc("at"), F.col("asks").isNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    target = F.when(F.col("asks").isNull(), F.struct("at", "_island"))
    later = Window.partitionBy(user).orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        both.groupBy(*group)
        .agg(F.min(target).alias("_first"))
        .select(*group, F.min("_first").over(later).alias("_carried"))
    )
    answered = both.withColumn("_found", F.min(target).over(backwards)).filter(F.col("asks").isNotNull())
    return (
        answered.join(carried, group)
        .withColumn("_answer", F.coalesce("_found", "_carried"))
        .filter(F.col("_answer._island") == F.col("_island"))
        .select(user, F.col("asks").alias("_ms"), F.col("_answer.at").alias("_next"))
    )
