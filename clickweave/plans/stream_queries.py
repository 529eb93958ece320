"""Registered queries: Structured Streaming over the events table.

Every query runs a real stream to completion (all files there are, then stop) into a sink under
the shared folder and returns what the sink holds. Streams with open sessions or windows are closed by
an end marker, so they return what the bounded operators return. An event arrives at its own time there. ``stream_late_data`` alone is about what the
watermark has passed, and its SQL applies the same rule.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.operators.incremental import SessionTable
from clickweave.operators.row_ops import apply_steps
from clickweave.operators.sessions import rollup_sessions
from clickweave.plans import jobs
from clickweave.plans.inputs import (
    as_clicks,
    click_messages,
    click_stream,
    clicks,
    end_marker,
    event_stream,
    scratch,
    table,
)
from clickweave.plans.registry import query
from clickweave.plans.session_queries import EVENT_OUTPUT, LIMITS, TUMBLING, page_activity
from clickweave.plans.sql_parts import CLICKS, INACTIVITY_MINUTES, greedy, islands
from clickweave.operators.quality import checked_writer, stream_report
from clickweave.plans.table_queries import EXPECTED, REPORT_SQL, as_people, user_event_messages
from clickweave.sinks.streams import batch_writer, kafka_payload, write_stream
from clickweave.sources.files import stream_files
from clickweave.streaming.capped import stream_capped_sessions, stream_session_events
from clickweave.streaming.windows import (
    stream_tumbling_sessions,
    stream_windowed_activity,
    stream_windowed_sessions,
)

DRAIN = {"availableNow": True}


def drain(df: DataFrame, label: str, **options) -> DataFrame:
    """Run a stream over everything available into Parquet files and read them back."""
    spark = df.sparkSession
    path, checkpoint = scratch(spark, label), scratch(spark, f"{label}-checkpoint")
    write_stream(df, checkpoint, path=path, trigger=DRAIN, **options).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def drain_whole(spark, sf_dir: str, build, label: str, run=None, only: Column | None = None, **options) -> DataFrame:
    """Run a stream over the whole events table (or ``only`` some rows) and close it, so that its result is complete.

    The stream reads the table and a folder with the end marker. Both come with the first batch; the marker's watermark then
    has the batch that follows, which has no data, close all that is open.
    """
    events = event_stream(spark, sf_dir)
    closing, path, checkpoint = (scratch(spark, f"{label}-{part}") for part in ("closing", "out", "checkpoint"))
    row = end_marker(events.schema)
    spark.createDataFrame([tuple(row[c] for c in events.columns)], events.schema).write.parquet(closing)
    source = events.unionByName(stream_files(spark, closing, events.schema))
    source = source if only is None else source.filter(only)
    if run is not None:
        query = run(source, checkpoint=checkpoint, path=path, trigger=DRAIN)
    else:
        query = write_stream(build(source), checkpoint, path=path, trigger=DRAIN, **options)
    query.awaitTermination()
    return spark.read.parquet(path)


@query("stream_to_files", "SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'")
def stream_to_files(spark, sf_dir):
    steps = [{"filter": "event_type <> 'error'"}, {"select": ["event_id", "user_id", "event_type", "value"]}]
    return drain(apply_steps(event_stream(spark, sf_dir), steps), "stream_files")


@query("stream_to_table", "SELECT event_id, user_id, value, event_type FROM events")
def stream_to_table(spark, sf_dir):
    path = scratch(spark, "stream_table")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    write_stream(
        event_stream(spark, sf_dir).select("event_id", "user_id", "value", "event_type"),
        scratch(spark, "stream_table_checkpoint"),
        table=name,
        trigger=DRAIN,
        partition_by=["event_type"],
        options={"path": path},
        files_per_partition=2,
    ).awaitTermination()
    return spark.table(name)


@query(
    "stream_each_batch",
    "SELECT event_type, count(*) AS event_count FROM events GROUP BY event_type",
)
def stream_each_batch(spark, sf_dir):
    """Batches appended by a function; counting happens on the written files."""
    path = scratch(spark, "each_batch")

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    stream = event_stream(spark, sf_dir).select("event_id", "event_type")
    write_stream(
        stream, scratch(spark, "each_batch_checkpoint"), trigger=DRAIN, each_batch=append
    ).awaitTermination()
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))


@query("stream_replayed_batch", "SELECT event_id, user_id, event_type FROM events")
def stream_replayed_batch(spark, sf_dir):
    """Every batch runs three times: once as it should, once after its ledger entry was lost, once with the entry there."""
    path, ledger = scratch(spark, "replayed"), scratch(spark, "replayed_ledger")
    write = batch_writer(ledger, path=path, partition_by=["event_type"])

    def write_again(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        entry = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/batches/{batch_id}")
        entry.getFileSystem(spark._jsc.hadoopConfiguration()).delete(entry, True)
        write(batch, batch_id)
        write(batch, batch_id)

    stream = event_stream(spark, sf_dir).select("event_id", "user_id", "event_type")
    write_stream(stream, scratch(spark, "replayed_checkpoint"), trigger=DRAIN, each_batch=write_again).awaitTermination()
    return spark.read.parquet(path).select("event_id", "user_id", "event_type")


@query("stream_dq_report", REPORT_SQL)
def stream_dq_report(spark, sf_dir):
    """The checks ride along with the write of each batch; their reports add up to that of the table."""
    customers = table(spark, sf_dir, "customer")
    stream = stream_files(spark, sf_dir, customers.schema, options={"pathGlobFilter": "customer.parquet"})
    reports = scratch(spark, "dq_reports")
    write = batch_writer(scratch(spark, "dq_ledger"), path=scratch(spark, "dq_rows"))
    checked = checked_writer(write, reports, **EXPECTED)
    write_stream(as_people(stream), scratch(spark, "dq_checkpoint"), trigger=DRAIN, each_batch=checked).awaitTermination()
    return stream_report(spark, reports, min_rows=1_000_000)


@query("stream_distinct", "SELECT event_id, event_type FROM events")
def stream_distinct(spark, sf_dir):
    """Every event sent twice; duplicates are dropped within the watermark."""
    events = event_stream(spark, sf_dir).select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("at")
    )
    twice = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    unique = apply_steps(twice, [{"watermark": "at, 10 minutes"}, "distinct"])
    return drain(unique.select("event_id", "event_type"), "stream_distinct")


@query(
    "stream_kafka_payload",
    """SELECT CAST(user_id AS VARCHAR) AS key,
        '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value
    FROM events""",
)
def stream_payload(spark, sf_dir):
    events = event_stream(spark, sf_dir).select("event_id", "user_id", "event_type")
    return drain(kafka_payload(events, key="user_id"), "stream_payload")


@query(
    "stream_session_window",
    f"""WITH {CLICKS}, {islands()}
    SELECT uuid, uuid || '_session_' || min(ms) AS session_id, min(ms) AS session_start_time_ms,
        max(ms) AS session_end_time_ms, count(*) AS event_count,
        (max(ms) - min(ms)) / 1000.0::DOUBLE AS session_duration_seconds
    FROM isl GROUP BY uuid, island""",
)
def stream_session_window(spark, sf_dir):
    def build(events):
        return stream_windowed_sessions(as_clicks(events), inactivity_minutes=INACTIVITY_MINUTES, arrival="event_time")

    return drain_whole(spark, sf_dir, build, "stream_session_window")


@query("stream_tumbling_sessions", TUMBLING)
def stream_tumbling(spark, sf_dir):
    rows = stream_tumbling_sessions(click_stream(spark, sf_dir))
    return drain(rows.select(*EVENT_OUTPUT), "stream_tumbling")


@query(
    "stream_windowed_user_agg",
    """WITH w AS (
        SELECT CAST(user_id AS VARCHAR) AS user_id, (epoch_us(ts) // 1000) // 1800000 * 1800000 AS window_start_ms,
            CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
    SELECT user_id, window_start_ms, CAST(sum(k) AS BIGINT) AS duration_seconds_sum, count(*) AS page_count
    FROM w GROUP BY 1, 2""",
)
def stream_windowed_user_agg(spark, sf_dir):
    def build(events):
        return stream_windowed_activity(page_activity(events), ["user_id"], arrival="timestamp").select(
            "user_id",
            F.unix_millis("window.start").alias("window_start_ms"),
            "duration_seconds_sum",
            "page_count",
        )

    return drain_whole(spark, sf_dir, build, "stream_windowed")


LATE_CUT = "2024-01-20"
LATE_DELAY_MS = 3 * 86_400_000
HOUR_MS = 3_600_000


@query(
    "stream_late_data",
    f"""WITH e AS (
        SELECT (epoch_us(ts) // 1000) AS ms, (epoch_us(ts) // 1000) // {HOUR_MS} * {HOUR_MS} AS s,
            ts < TIMESTAMP '{LATE_CUT}' AND event_type <> 'error' AS on_time FROM events),
    wm AS (SELECT max(ms) FILTER (WHERE on_time) - {LATE_DELAY_MS} AS first,
                  max(ms) - {LATE_DELAY_MS} AS last FROM e)
    SELECT s AS window_start_ms, count(*) AS event_count FROM e, wm
    WHERE s + {HOUR_MS} <= wm.last AND (on_time OR s + {HOUR_MS} > wm.first) GROUP BY s""",
)
def stream_late_data(spark, sf_dir):
    """Error events arrive after everything else of the first weeks; those beyond the delay are late.

    The stream runs twice over one folder, so the second run resumes from the first one's state.
    """
    events = table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("at"))
    source, target, checkpoint = (scratch(spark, f"late_{part}") for part in ("in", "out", "checkpoint"))
    on_time = (F.col("at") < LATE_CUT) & (F.col("event_type") != "error")
    for arrived in (events.filter(on_time), events.filter(~on_time)):
        arrived.write.mode("append").parquet(source)
        hourly = (
            stream_files(spark, source, events.schema)
            .withWatermark("at", f"{LATE_DELAY_MS} milliseconds")
            .groupBy(F.window("at", "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("event_count"))
            .select(F.unix_millis("w.start").alias("window_start_ms"), "event_count")
        )
        write_stream(hourly, checkpoint, path=target, trigger=DRAIN).awaitTermination()
    return spark.read.parquet(target)


STREAM_SESSIONS = f"WITH RECURSIVE {CLICKS}, {islands()}, {greedy()}"


@query(
    "stream_sessions_capped",
    f"""{STREAM_SESSIONS}
    SELECT uuid, uuid || '_session_' || s AS session_id, s AS session_start_time_ms,
        max(ms) AS session_end_time_ms, count(*) AS event_count,
        (max(ms) - s) / 1000.0::DOUBLE AS session_duration_seconds
    FROM sess GROUP BY uuid, s, n""",
)
def stream_sessions_capped(spark, sf_dir):
    def build(events):
        return stream_capped_sessions(as_clicks(events), arrival="event_time", **LIMITS).select(
            "uuid",
            "session_id",
            "session_start_time_ms",
            "session_end_time_ms",
            "event_count",
            "session_duration_seconds",
        )

    return drain_whole(spark, sf_dir, build, "stream_capped", stateful=True)


@query(
    "stream_session_events",
    f"""{STREAM_SESSIONS}
    SELECT uuid, event_id, uuid || '_session_' || s AS session_id, s AS session_start_time_ms,
        ms AS session_end_time_ms, (ms - s) / 1000.0::DOUBLE AS session_duration_seconds FROM sess""",
)
def stream_events(spark, sf_dir):
    def build(events):
        return stream_session_events(as_clicks(events), arrival="event_time", **LIMITS).select(*EVENT_OUTPUT)

    return drain_whole(spark, sf_dir, build, "stream_session_events", stateful=True)


BOUNDARY_SESSIONS = f"WITH RECURSIVE {CLICKS}, {islands(extra="page_name = 'signup'")}, {greedy()}"


@query(
    "stream_custom_boundary",
    f"""{BOUNDARY_SESSIONS}
    SELECT uuid, uuid || '_session_' || s AS session_id, s AS session_start_time_ms,
        max(ms) AS session_end_time_ms, count(*) AS event_count FROM sess GROUP BY uuid, s, n""",
)
def stream_custom_boundary(spark, sf_dir):
    """A sign-up opens a session of its own, on a stream as on a bounded table."""
    columns = ["uuid", "session_id", "session_start_time_ms", "session_end_time_ms", "event_count"]

    def build(events):
        signup = F.col("page_name") == "signup"
        return stream_capped_sessions(as_clicks(events), arrival="event_time", boundary=signup, **LIMITS).select(*columns)

    return drain_whole(spark, sf_dir, build, "stream_boundary", stateful=True)


@query(
    "stream_after_batch",
    f"""{STREAM_SESSIONS}
    SELECT uuid, s AS session_start_time_ms, max(ms) AS session_end_time_ms, count(*) AS event_count
    FROM sess GROUP BY uuid, s, n""",
)
def stream_after_batch(spark, sf_dir):
    """The first half of the time as a bounded table; a stream goes on from the sessions that are open then."""
    columns = ["uuid", "session_start_time_ms", "session_end_time_ms", "event_count"]
    events = clicks(spark, sf_dir)
    low, high = events.agg(F.min("event_time_ms"), F.max("event_time_ms")).first()
    middle = (low + high) // 2
    stored = SessionTable(spark, scratch(spark, "before_stream"), busy=None, **LIMITS)
    stored.add(events, middle)
    opened = stored.open_sessions()

    def build(rest):
        return stream_capped_sessions(as_clicks(rest), arrival="event_time", initial=opened, **LIMITS).select(*columns)

    later = F.unix_millis(F.col("ts").cast("timestamp")) >= middle
    streamed = drain_whole(spark, sf_dir, build, "after_batch", only=later, stateful=True)
    closed = stored.rows().join(opened.select("uuid", "session_start_time_ms"), ["uuid", "session_start_time_ms"], "left_anti")
    return rollup_sessions(closed).select(*columns).unionByName(streamed)


@query(
    "job_typed_events_stream",
    "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, (epoch_us(ts) // 1000) AS ms,"
    " event_type FROM events",
)
def job_typed_events_stream(spark, sf_dir):
    path = scratch(spark, "typed_events")
    jobs.typed_events_stream(
        user_event_messages(event_stream(spark, sf_dir)),
        checkpoint=scratch(spark, "typed_checkpoint"),
        path=path,
        trigger=DRAIN,
    ).awaitTermination()
    return spark.read.parquet(path).select(
        "event_id", "user_id", F.unix_millis("timestamp").alias("ms"), "event_type"
    )


@query(
    "job_activity_stream",
    """WITH w AS (
        SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS session_id,
            (epoch_us(ts) // 1000) // 1800000 * 1800000 AS window_start_ms,
            CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
    SELECT user_id, session_id, window_start_ms, CAST(sum(k) AS BIGINT) AS duration_seconds_sum,
        count(*) AS page_count, strftime(epoch_ms(window_start_ms), '%Y-%m-%d') AS window_day
    FROM w GROUP BY ALL""",
)
def job_activity_stream(spark, sf_dir):
    def run(events, **write):
        pages = page_activity(events).withColumn("session_id", F.col("page"))
        return jobs.activity_stream(pages.select(F.to_json(F.struct(*pages.columns)).alias("value"), "timestamp"), **write)

    return drain_whole(spark, sf_dir, None, "activity", run=run).select(
        "user_id",
        "session_id",
        F.unix_millis("window.start").alias("window_start_ms"),
        "duration_seconds_sum",
        "page_count",
        F.col("window_date").cast("string").alias("window_day"),
    )


@query(
    "job_sessions_stream",
    f"""{STREAM_SESSIONS}
    SELECT uuid, CAST(event_id AS VARCHAR) AS event_id, page_name, s AS session_start_time_ms,
        strftime(epoch_ms(s), '%Y-%m-%d') AS session_date FROM sess""",
)
def job_sessions_stream(spark, sf_dir):
    """Messages to a session table by date and user bucket."""

    def run(events, **write):
        return jobs.sessions_stream(click_messages(events), limits=LIMITS, **write)

    return drain_whole(spark, sf_dir, None, "sessions_stream", run=run).select(
        "uuid",
        "event_id",
        "page_name",
        "session_start_time_ms",
        F.col("session_date").cast("string").alias("session_date"),
    )


# Messages whose sender's clock runs ahead, and messages that were held up on their way; the others are up to four minutes on it.
AHEAD, HELD_UP = "user_id % 17 = 3", "event_id % 13 = 5"
AHEAD_MS, HELD_UP_MS = 2 * HOUR_MS, 3 * HOUR_MS
SENT = f"""
arrivals AS (
    SELECT CAST(user_id AS VARCHAR) AS uuid, event_id, event_type AS page_name, (epoch_us(ts) // 1000) AS ms,
        CASE WHEN {AHEAD} THEN 'clock ahead' WHEN {HELD_UP} THEN 'late' END AS reason FROM events
),
clicks AS (SELECT uuid, event_id, page_name, ms FROM arrivals WHERE reason IS NULL)"""


# Fixed value: what a task reads at least, where a stream has written many small files.
READ_BYTES = 32_000_000


def drain_arriving(spark, sf_dir: str, label: str, run) -> DataFrame:
    """Run a stream over the events as messages with an arrival, in its order, a third of them at a time; an end marker comes last.

    Events are dealt to all tasks first. Each third is landed by all tasks, and a run of the stream takes it as one batch, whatever the number of its
    files. The next run goes on from the state of the one before.
    """
    events = table(spark, sf_dir, "events")
    closing = spark.createDataFrame([tuple(end_marker(events.schema)[c] for c in events.columns)], events.schema)
    sent = F.unix_millis(F.col("ts").cast("timestamp"))
    lag = F.when(F.expr(AHEAD), -AHEAD_MS).when(F.expr(HELD_UP), HELD_UP_MS).otherwise(F.pmod("event_id", F.lit(5)) * 60_000)
    timed = events.repartition(spark.sparkContext.defaultParallelism).withColumn("arrived", sent + lag)
    timed = jobs.land(timed, scratch(spark, f"{label}-timed"))
    first, second = timed.approxQuantile("arrived", [1 / 3, 2 / 3], 0.01)
    parts = (F.col("arrived") <= first, (F.col("arrived") > first) & (F.col("arrived") <= second), F.col("arrived") > second)
    source, path, checkpoint = (scratch(spark, f"{label}-{part}") for part in ("in", "out", "checkpoint"))
    for part in (*[timed.filter(p) for p in parts], closing.withColumn("arrived", sent)):
        messages = click_messages(part.drop("arrived")).drop("timestamp")
        arrivals = part.select(F.col("event_id").alias("offset"), F.timestamp_millis("arrived").alias("timestamp"))
        messages = messages.join(arrivals, "offset")
        messages.write.mode("append").parquet(source)
        run(stream_files(spark, source, messages.schema), checkpoint=checkpoint, path=path, trigger=DRAIN).awaitTermination()
    return read_written(spark, path)


def read_written(spark, path: str) -> DataFrame:
    """What a stream has written, with its many small files read by a few tasks a core, or one for each ``READ_BYTES``."""
    rows = spark.read.parquet(path)
    size = rows._jdf.queryExecution().analyzed().stats().sizeInBytes()
    return rows.coalesce(max(2 * spark.sparkContext.defaultParallelism, -(-size // READ_BYTES)))


def rejected(spark, sf_dir: str, label: str, reason: str) -> DataFrame:
    found = drain_arriving(spark, sf_dir, label, jobs.rejects_stream).filter(F.col("reason") == reason)
    return found.select(F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"), "reason")


@query("stream_clock_rejects", f"WITH {SENT} SELECT event_id, reason FROM arrivals WHERE reason = 'clock ahead'")
def stream_clock_rejects(spark, sf_dir):
    return rejected(spark, sf_dir, "clock_rejects", "clock ahead")


@query("stream_late_rejects", f"WITH {SENT} SELECT event_id, reason FROM arrivals WHERE reason = 'late'")
def stream_late_rejects(spark, sf_dir):
    return rejected(spark, sf_dir, "late_rejects", "late")


@query(
    "stream_guarded_sessions",
    f"""WITH RECURSIVE {SENT}, {islands()}, {greedy()}
    SELECT uuid, CAST(event_id AS VARCHAR) AS event_id, s AS session_start_time_ms FROM sess""",
)
def stream_guarded_sessions(spark, sf_dir):
    """Sessions of all that is neither late nor has a wrong clock, none of which the watermark may drop."""
    run = partial(jobs.sessions_stream, limits=LIMITS)
    return drain_arriving(spark, sf_dir, "guarded", run).select("uuid", "event_id", "session_start_time_ms")
