"""Registered queries: session detection and analytics on sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweave.functions.layout import add_layout_columns, for_user
from clickweave.operators import analytics
from clickweave.operators.busy_users import BusyUsers, busy_counts, measure_busy
from clickweave.operators.incremental import SessionTable
from clickweave.operators.sketches import distinct_users, duration_quantile, merge_sketches, session_sketches
from clickweave.operators.sessions import (
    detect_sessions,
    rollup_sessions,
    running_session_end,
    session_gaps,
    session_islands,
    session_paths,
    tumbling_sessions,
    windowed_sessions,
)
from clickweave.plans import jobs
from clickweave.plans.inputs import click_messages, clicks, scratch, table
from clickweave.plans.registry import query
from clickweave.plans.sql_parts import (
    BIN_SESSIONS,
    CLICKS,
    EVENT_COLUMNS,
    GREEDY_SESSIONS,
    INACTIVITY_MINUTES,
    MAX_MINUTES,
    ROLLUP,
    ROLLUP_COLUMNS,
    bins,
    bucket,
    islands,
)
from clickweave.sinks.tables import write_bucketed, write_table

LIMITS = {"inactivity_minutes": INACTIVITY_MINUTES, "max_minutes": MAX_MINUTES}
# Every user through the path for oversized users, in slices of one day.
ALL_BUSY = BusyUsers(rows=0, slice_minutes=1440)
EVENT_OUTPUT = [
    "uuid",
    "event_id",
    "session_id",
    "session_start_time_ms",
    "session_end_time_ms",
    "session_duration_seconds",
]
ROLLUP_SQL = f"SELECT {ROLLUP_COLUMNS} FROM sess GROUP BY uuid, session_id"


def sessions(spark, sf_dir, policy="bin", **options):
    return detect_sessions(clicks(spark, sf_dir), policy=policy, **LIMITS, **options)


def rollup(spark, sf_dir):
    rows = rollup_sessions(sessions(spark, sf_dir))
    return add_layout_columns(rows)


@query(
    "session_gap",
    f"WITH {CLICKS} SELECT uuid, event_id, ms AS event_time_ms,"
    " ms - lag(ms) OVER (PARTITION BY uuid ORDER BY ms, event_id) AS gap_ms FROM clicks",
)
def session_gap(spark, sf_dir):
    return session_gaps(clicks(spark, sf_dir)).select("uuid", "event_id", "event_time_ms", "gap_ms")


@query(
    "session_gap_sliced",
    f"WITH {CLICKS} SELECT uuid, event_id, ms AS event_time_ms,"
    " ms - lag(ms) OVER (PARTITION BY uuid ORDER BY ms, event_id) AS gap_ms FROM clicks",
)
def session_gap_sliced(spark, sf_dir):
    gaps = session_gaps(clicks(spark, sf_dir), busy=ALL_BUSY)
    return gaps.select("uuid", "event_id", "event_time_ms", "gap_ms")


@query(
    "session_islands",
    f"WITH {CLICKS}, {islands()} SELECT uuid, event_id, island, island_start AS island_start_ms FROM isl",
)
def islands_query(spark, sf_dir):
    found = session_islands(clicks(spark, sf_dir), inactivity_minutes=INACTIVITY_MINUTES)
    return found.select("uuid", "event_id", "island", "island_start_ms")


@query("sessions_bin", f"{BIN_SESSIONS} {ROLLUP_SQL}")
def sessions_bin(spark, sf_dir):
    return rollup_sessions(sessions(spark, sf_dir, "bin"))


@query("sessions_greedy", f"{GREEDY_SESSIONS} {ROLLUP_SQL}")
def sessions_greedy(spark, sf_dir):
    return rollup_sessions(sessions(spark, sf_dir, "greedy"))


DAY_MS = 86_400_000


@query(
    "busy_users",
    'SELECT CAST(user_id AS VARCHAR) AS uuid, count(*) AS "rows" FROM events GROUP BY user_id HAVING count(*) > 75',
)
def busy_users(spark, sf_dir):
    """Users above a limit, looked for with fewer counters than there are users."""
    return busy_counts(clicks(spark, sf_dir), busy=BusyUsers(rows=75, summary=64))


@query("sessions_bucketed", f"{BIN_SESSIONS} SELECT {EVENT_COLUMNS} FROM sess")
def sessions_bucketed(spark, sf_dir):
    """Events stored by user; detection reads the buckets and shuffles nothing."""
    path = scratch(spark, "bucketed")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    write_bucketed(clicks(spark, sf_dir), name, "uuid", 8, ["event_time_ms"], location=path)
    return detect_sessions(spark.table(name), busy=None, **LIMITS).select(*EVENT_OUTPUT)


def slice_ends(events, days: int) -> list[int]:
    """Ends of the slices of so many days that hold all events."""
    low, high = events.agg(F.min("event_time_ms"), F.max("event_time_ms")).first()
    return list(range((low // DAY_MS + days) * DAY_MS, high + days * DAY_MS + 1, days * DAY_MS)) if low is not None else [0]


@query("sessions_incremental", f"{GREEDY_SESSIONS} SELECT {EVENT_COLUMNS} FROM sess")
def sessions_incremental(spark, sf_dir):
    """The table taken in slice by slice; each run reads its own events and the sessions that were open before it."""
    events = clicks(spark, sf_dir)
    stored = SessionTable(spark, scratch(spark, "incremental"), busy=None, **LIMITS)
    for end in slice_ends(events, days=8):
        stored.add(events, end)
    return stored.rows().select(*EVENT_OUTPUT)


TRUNCATED = f"""
WITH {CLICKS}, {islands()}
SELECT uuid, uuid || '_session_' || island AS session_id, min(ms) AS session_start_time_ms,
       least(max(ms), min(ms) + {MAX_MINUTES * 60_000}) AS session_end_time_ms,
       count(*) AS event_count,
       least(max(ms) - min(ms), {MAX_MINUTES * 60_000}) / 1000.0::DOUBLE AS session_duration_seconds
FROM isl GROUP BY uuid, island"""


@query("sessions_truncate", TRUNCATED)
def sessions_truncate(spark, sf_dir):
    return rollup_sessions(sessions(spark, sf_dir, "truncate"), cap_minutes=MAX_MINUTES)


@query("session_events", f"{BIN_SESSIONS} SELECT {EVENT_COLUMNS} FROM sess")
def session_events(spark, sf_dir):
    return sessions(spark, sf_dir).select(*EVENT_OUTPUT)


@query("session_events_greedy", f"{GREEDY_SESSIONS} SELECT {EVENT_COLUMNS} FROM sess")
def session_events_greedy(spark, sf_dir):
    return sessions(spark, sf_dir, "greedy").select(*EVENT_OUTPUT)


@query("session_events_bin_sliced", f"{BIN_SESSIONS} SELECT {EVENT_COLUMNS} FROM sess")
def session_events_bin_sliced(spark, sf_dir):
    return sessions(spark, sf_dir, busy=ALL_BUSY).select(*EVENT_OUTPUT)


@query("session_events_greedy_sliced", f"{GREEDY_SESSIONS} SELECT {EVENT_COLUMNS} FROM sess")
def session_events_greedy_sliced(spark, sf_dir):
    return sessions(spark, sf_dir, "greedy", busy=ALL_BUSY).select(*EVENT_OUTPUT)


@query(
    "session_rollup",
    f"WITH {CLICKS}, {islands(30 * 60_000)}, {bins(120 * 60_000)} {ROLLUP_SQL}",
)
def session_rollup(spark, sf_dir):
    """Flagship: the default limits, 30 minutes and 2 hours."""
    return rollup_sessions(detect_sessions(clicks(spark, sf_dir)))


# Roll-up columns of the whole session, for groups that hold some of its events.
WHOLE = """s AS session_start_time_ms, e AS session_end_time_ms, count(*) AS event_count,
    (e - s) / 1000.0::DOUBLE AS session_duration_seconds"""


@query(
    "session_paths",
    f"""{BIN_SESSIONS} SELECT uuid, session_id, CAST(0 AS BIGINT) AS part,
        string_agg(page_name, '>' ORDER BY ms, event_id) AS pages_visited, {WHOLE} FROM sess GROUP BY uuid, session_id, s, e""",
)
def session_paths_query(spark, sf_dir):
    busy = measure_busy(clicks(spark, sf_dir))
    paths = session_paths(sessions(spark, sf_dir, busy=busy), busy=busy)
    return paths.withColumn("pages_visited", F.array_join("pages_visited", ">"))


@query(
    "session_paths_sliced",
    f"""{BIN_SESSIONS}, seq AS (
        SELECT *, (row_number() OVER (PARTITION BY uuid, session_id ORDER BY ms, event_id) - 1) // 3 AS part,
            count(*) OVER (PARTITION BY uuid, session_id) AS event_count
        FROM sess)
    SELECT uuid, session_id, part, string_agg(page_name, '>' ORDER BY ms, event_id) AS pages_visited,
        s AS session_start_time_ms, e AS session_end_time_ms, event_count,
        (e - s) / 1000.0::DOUBLE AS session_duration_seconds
    FROM seq GROUP BY uuid, session_id, part, s, e, event_count""",
)
def session_paths_sliced(spark, sf_dir):
    paths = session_paths(sessions(spark, sf_dir), part_events=3, busy=ALL_BUSY)
    return paths.withColumn("pages_visited", F.array_join("pages_visited", ">"))


CUSTOM = f"WITH {CLICKS}, {islands(extra="page_name = 'signup'")}, {bins()}"


@query("sessions_custom_boundary", f"{CUSTOM} {ROLLUP_SQL}")
def sessions_custom_boundary(spark, sf_dir):
    return rollup_sessions(sessions(spark, sf_dir, boundary=F.col("page_name") == "signup"))


@query("sessions_custom_boundary_sliced", f"{CUSTOM} {ROLLUP_SQL}")
def sessions_custom_boundary_sliced(spark, sf_dir):
    signup = F.col("page_name") == "signup"
    return rollup_sessions(sessions(spark, sf_dir, boundary=signup, busy=ALL_BUSY))


@query(
    "session_window_batch",
    f"WITH {CLICKS}, {islands()} SELECT uuid, uuid || '_session_' || min(ms) AS session_id,"
    " min(ms) AS session_start_time_ms, max(ms) AS session_end_time_ms, count(*) AS event_count,"
    " (max(ms) - min(ms)) / 1000.0::DOUBLE AS session_duration_seconds FROM isl GROUP BY uuid, island",
)
def session_window_batch(spark, sf_dir):
    return windowed_sessions(clicks(spark, sf_dir), inactivity_minutes=INACTIVITY_MINUTES)


TUMBLING = f"""
WITH {CLICKS}, w AS (SELECT *, ms // 300000 * 300000 AS s FROM clicks)
SELECT uuid, event_id, uuid || '_session_' || s AS session_id, s AS session_start_time_ms,
       s + 300000 AS session_end_time_ms, 300.0::DOUBLE AS session_duration_seconds
FROM w"""


@query("tumbling_sessions", TUMBLING)
def tumbling(spark, sf_dir):
    return tumbling_sessions(clicks(spark, sf_dir)).select(*EVENT_OUTPUT)


@query(
    "running_session_end",
    f"{BIN_SESSIONS} SELECT uuid, event_id, session_id, ms AS running_end_time_ms,"
    " (ms - s) / 1000.0::DOUBLE AS running_duration_seconds FROM sess",
)
def running_end(spark, sf_dir):
    return running_session_end(sessions(spark, sf_dir)).select(
        "uuid", "event_id", "session_id", "running_end_time_ms", "running_duration_seconds"
    )


@query(
    "session_date_layout",
    f"""{BIN_SESSIONS} SELECT uuid, event_id, strftime(epoch_ms(s), '%Y-%m-%d') AS session_date,
        {bucket('uuid')} AS user_hash_bucket FROM sess""",
)
def session_date_layout(spark, sf_dir):
    laid_out = add_layout_columns(sessions(spark, sf_dir))
    return laid_out.select("uuid", "event_id", "session_date", "user_hash_bucket")


@query(
    "user_bucket",
    f"WITH {CLICKS} SELECT uuid, {bucket('uuid')} AS user_hash_bucket, count(*) AS events"
    " FROM clicks GROUP BY uuid",
)
def user_bucket_query(spark, sf_dir):
    laid_out = add_layout_columns(clicks(spark, sf_dir), start_ms="event_time_ms")
    return laid_out.groupBy("uuid", "user_hash_bucket").agg(F.count(F.lit(1)).alias("events"))


# Analytics ---------------------------------------------------------------------------------

DATES = ("2024-01-05", "2024-01-20")
BUCKETS = [3, 29, 61, 88]
LOOKUP_DATE, LOOKUP_BUCKET = "2024-01-09", 29
STORED: dict[tuple, str] = {}


def stored_sessions(spark, sf_dir):
    """The session table of the batch job, by date and user bucket; written once per application and table."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in STORED or not spark.catalog.tableExists(STORED[key]):
        path = scratch(spark, "session_table")
        name = path.rsplit("/", 1)[1].replace("-", "_")
        jobs.sessions_batch(
            click_messages(table(spark, sf_dir, "events")),
            lambda df: write_table(df, name, "create", ["session_date", "user_hash_bucket"], location=path),
            **LIMITS,
        )
        STORED[key] = name
    return spark.table(STORED[key])


@query(
    "daily_sessions",
    f"""{ROLLUP} SELECT session_date, count(*) AS daily_sessions,
        round(sum(session_end_time_ms - session_start_time_ms) / 1000.0::DOUBLE / count(*), 3) AS avg_duration
    FROM rollup WHERE session_date BETWEEN '{DATES[0]}' AND '{DATES[1]}' GROUP BY session_date""",
)
def daily(spark, sf_dir):
    report = analytics.daily_sessions(analytics.rollup_stored(stored_sessions(spark, sf_dir)), *DATES)
    return report.withColumn("avg_duration", F.round("avg_duration", 3)).orderBy("session_date")


@query(
    "bucket_cohort",
    f"""WITH {CLICKS}, b AS (SELECT DISTINCT uuid FROM clicks),
    c AS (SELECT uuid, {bucket('uuid')} AS user_hash_bucket FROM b)
    SELECT user_hash_bucket, count(*) AS unique_users FROM c
    WHERE user_hash_bucket IN (3, 29, 61, 88) GROUP BY user_hash_bucket""",
)
def cohort(spark, sf_dir):
    return analytics.bucket_cohort(stored_sessions(spark, sf_dir), BUCKETS)


# A week's start, from the date text of the session table.
WEEK = "date_trunc('week', CAST(session_date AS DATE))"


def weekly_sketches(spark, sf_dir):
    """Sketches per date and bucket, stored as a table of their own; a week is merged from its rows alone."""
    path = scratch(spark, "sketches")
    session_sketches(analytics.rollup_stored(stored_sessions(spark, sf_dir)), lg_k=18, k=8192).write.partitionBy("session_date").parquet(path)
    stored = spark.read.parquet(path).withColumn("session_date", F.col("session_date").cast("string"))
    week = F.date_format(F.date_trunc("week", F.to_date("session_date")), "yyyy-MM-dd")
    return merge_sketches(stored, [week.alias("week")], k=8192)


@query(
    "cohort_sketch",
    f"""{ROLLUP} SELECT strftime({WEEK}, '%Y-%m-%d') AS week, count(*) AS sessions,
        CAST(sum(event_count) AS BIGINT) AS events, count(DISTINCT uuid) AS users FROM rollup GROUP BY 1""",
)
def cohort_sketch(spark, sf_dir):
    """Sketches this large are exact on tables this small, so the SQL counts."""
    return weekly_sketches(spark, sf_dir).select("week", "sessions", "events", distinct_users().alias("users"))


@query(
    "duration_quantiles",
    f"""{ROLLUP}, r AS (
        SELECT strftime({WEEK}, '%Y-%m-%d') AS week, session_duration_seconds AS d,
            row_number() OVER (PARTITION BY {WEEK} ORDER BY session_duration_seconds) AS place,
            count(*) OVER (PARTITION BY {WEEK}) AS n FROM rollup)
    SELECT week, max(d) FILTER (WHERE place = ceil(0.5 * n)) AS p50, max(d) FILTER (WHERE place = ceil(0.9 * n)) AS p90,
        max(d) FILTER (WHERE place = ceil(0.99 * n)) AS p99 FROM r GROUP BY week""",
)
def duration_quantiles(spark, sf_dir):
    quantiles = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    return weekly_sketches(spark, sf_dir).select("week", *[duration_quantile(q).alias(n) for n, q in quantiles.items()])


@query(
    "session_lookup",
    f"""{ROLLUP} SELECT uuid, session_id, session_duration_seconds FROM rollup
    WHERE session_date = '{LOOKUP_DATE}' AND {bucket('uuid')} = {LOOKUP_BUCKET}""",
)
def lookup(spark, sf_dir):
    return analytics.session_lookup(analytics.rollup_stored(stored_sessions(spark, sf_dir)), LOOKUP_DATE, LOOKUP_BUCKET)


@query(
    "user_lookup",
    f"{ROLLUP} SELECT uuid, session_id, session_date, {bucket('uuid')} AS user_hash_bucket"
    " FROM rollup WHERE uuid = '8'",
)
def user_lookup(spark, sf_dir):
    found = for_user(analytics.rollup_stored(stored_sessions(spark, sf_dir)), "8")
    return found.select("uuid", "session_id", F.col("session_date").cast("string").alias("session_date"), "user_hash_bucket")


@query(
    "event_type_counts",
    "SELECT event_type, count(*) AS event_count FROM events GROUP BY event_type",
)
def event_type_counts(spark, sf_dir):
    return analytics.counts_by(table(spark, sf_dir, "events"), "event_type")


@query(
    "date_distribution",
    f"""{BIN_SESSIONS} SELECT strftime(epoch_ms(s), '%Y-%m-%d') AS session_date, count(*) AS event_count,
        count(DISTINCT session_id) AS sessions FROM sess GROUP BY 1""",
)
def date_distribution(spark, sf_dir):
    return analytics.date_distribution(add_layout_columns(sessions(spark, sf_dir)))


PER_BUCKET = f"""WITH {CLICKS}, b AS (SELECT DISTINCT uuid FROM clicks),
c AS (SELECT {bucket('uuid')} AS user_hash_bucket, count(*) AS users FROM b GROUP BY 1)"""


@query("users_per_bucket", f"{PER_BUCKET} SELECT user_hash_bucket, users FROM c")
def per_bucket(spark, sf_dir):
    return analytics.users_per_bucket(add_layout_columns(clicks(spark, sf_dir), start_ms="event_time_ms"))


@query(
    "bucket_balance",
    f"""{PER_BUCKET} SELECT min(users) AS min_users_per_bucket, max(users) AS max_users_per_bucket,
        round(avg(users), 6) AS avg_users_per_bucket, round(stddev_samp(users), 6) AS stddev_users FROM c""",
)
def balance(spark, sf_dir):
    laid_out = add_layout_columns(clicks(spark, sf_dir), start_ms="event_time_ms")
    report = analytics.bucket_balance(laid_out)
    return report.withColumns(
        {c: F.round(c, 6) for c in ("avg_users_per_bucket", "stddev_users")}
    )


@query(
    "bucket_consistency",
    f"WITH {CLICKS} SELECT count(*) FILTER (WHERE n > 1) AS conflicting_users FROM"
    f" (SELECT uuid, count(DISTINCT {bucket('uuid')}) AS n FROM clicks GROUP BY uuid)",
)
def consistency(spark, sf_dir):
    conflicts = analytics.bucket_conflicts(stored_sessions(spark, sf_dir))
    return conflicts.agg(F.count(F.lit(1)).alias("conflicting_users"))


@query(
    "partition_top10",
    f"""{BIN_SESSIONS} SELECT strftime(epoch_ms(s), '%Y-%m-%d') AS session_date,
        {bucket('uuid')} AS user_hash_bucket, count(*) AS event_count
    FROM sess GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 10""",
)
def partition_top10(spark, sf_dir):
    return analytics.first_partitions(add_layout_columns(sessions(spark, sf_dir)))


@query(
    "session_overall",
    f"""{ROLLUP} SELECT count(*) AS total_sessions,
        round(sum(session_end_time_ms - session_start_time_ms) / 1000.0::DOUBLE / count(*), 3) AS avg_duration,
        max(session_duration_seconds) AS max_duration FROM rollup""",
)
def session_overall(spark, sf_dir):
    report = analytics.overall(rollup_sessions(sessions(spark, sf_dir)))
    return report.withColumn("avg_duration", F.round("avg_duration", 3))


@query("sessions_per_user", f"{ROLLUP} SELECT uuid, count(*) AS session_count FROM rollup GROUP BY uuid")
def per_user(spark, sf_dir):
    return analytics.sessions_per_user(rollup_sessions(sessions(spark, sf_dir)))


@query(
    "profile_numeric",
    f"""{ROLLUP}, v AS (
        SELECT 'session_duration_seconds' AS column_name, session_duration_seconds AS x FROM rollup
        UNION ALL SELECT 'event_count', event_count FROM rollup)
    SELECT column_name, count(x) AS value_count, round(avg(x), 4) AS mean,
        round(stddev_samp(x), 4) AS stddev, min(x)::DOUBLE AS min_value, max(x)::DOUBLE AS max_value
    FROM v GROUP BY column_name""",
)
def profile(spark, sf_dir):
    rows = rollup_sessions(sessions(spark, sf_dir))
    report = analytics.numeric_profile(rows, ["session_duration_seconds", "event_count"])
    return report.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query(
    "windowed_user_agg",
    """SELECT CAST(user_id AS VARCHAR) AS user_id, (epoch_us(ts) // 1000) // 1800000 * 1800000 AS window_start_ms,
        CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS duration_seconds_sum,
        count(event_type) AS page_count
    FROM events GROUP BY 1, 2""",
)
def windowed_user_agg(spark, sf_dir):
    pages = page_activity(table(spark, sf_dir, "events"))
    report = analytics.windowed_activity(pages, ["user_id"])
    return report.select(
        "user_id",
        F.unix_millis("window.start").alias("window_start_ms"),
        "duration_seconds_sum",
        "page_count",
    )


def page_activity(events):
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("page"),
        F.get_json_object("props", "$.k").cast("bigint").alias("duration_seconds"),
    )


def pruned_sql(test: str) -> str:
    return f"""{BIN_SESSIONS}, placed AS (SELECT strftime(epoch_ms(s), '%Y-%m-%d') AS session_date,
        {bucket('uuid')} AS user_hash_bucket FROM sess)
    SELECT count(*) AS event_count FROM placed WHERE {test}"""


@query("pruned_counts", pruned_sql(f"session_date = '{LOOKUP_DATE}'"))
def pruned_counts(spark, sf_dir):
    return analytics.pruned_count(stored_sessions(spark, sf_dir), date=LOOKUP_DATE)


@query("pruned_counts_bucket", pruned_sql("user_hash_bucket IN (3, 29, 61, 88)"))
def pruned_counts_bucket(spark, sf_dir):
    return analytics.pruned_count(stored_sessions(spark, sf_dir), buckets=BUCKETS)


@query("pruned_counts_both", pruned_sql(f"session_date = '{LOOKUP_DATE}' AND user_hash_bucket IN (3, 29, 61, 88)"))
def pruned_counts_both(spark, sf_dir):
    return analytics.pruned_count(stored_sessions(spark, sf_dir), date=LOOKUP_DATE, buckets=BUCKETS)


@query(
    "session_window_batch_sliced",
    f"""WITH {CLICKS}, {islands()}
    SELECT uuid, uuid || '_session_' || min(ms) AS session_id, min(ms) AS session_start_time_ms,
        max(ms) AS session_end_time_ms, count(*) AS event_count,
        (max(ms) - min(ms)) / 1000.0::DOUBLE AS session_duration_seconds
    FROM isl GROUP BY uuid, island""",
)
def session_window_batch_sliced(spark, sf_dir):
    return windowed_sessions(clicks(spark, sf_dir), inactivity_minutes=INACTIVITY_MINUTES, busy=ALL_BUSY)


@query(
    "session_readable_times",
    f"""{BIN_SESSIONS} SELECT uuid, event_id, strftime(epoch_ms(s), '%Y-%m-%d %H:%M:%S') AS session_start,
        strftime(epoch_ms(e), '%Y-%m-%d %H:%M:%S') AS session_end FROM sess""",
)
def session_readable_times(spark, sf_dir):
    texts = [F.date_format(f"session_{n}_time", "yyyy-MM-dd HH:mm:ss").alias(f"session_{n}") for n in ("start", "end")]
    return sessions(spark, sf_dir).select("uuid", "event_id", *texts)
