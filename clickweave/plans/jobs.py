"""Ready-made jobs: read, a chain of DataFrame functions, write."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickweave.functions.event_time import ClockRules, arrival_time, clock_reason, normalise_event_time, parse_timestamp
from clickweave.functions.json_columns import parse_json, with_processing_time
from clickweave.functions.layout import add_layout_columns, with_date_column
from clickweave.functions.schema import to_schema
from clickweave.operators.quality import clean_rows
from clickweave.operators.row_ops import apply_steps
from clickweave.operators.sessions import detect_sessions
from clickweave.session import shared_dir
from clickweave.sinks.files import write_files
from clickweave.sinks.streams import batch_writer, table_stream_options, write_stream
from clickweave.sinks.tables import SESSION_PARTITIONS, SESSION_TABLE_PROPERTIES
from clickweave.sources.files import read_files
from clickweave.streaming.capped import stream_session_events
from clickweave.streaming.windows import stream_windowed_activity

# The message schemas of the three streaming jobs.
CLICKSTREAM_SCHEMA = """
    event_id STRING NOT NULL,
    page_name STRING,
    event_timestamp STRING NOT NULL,
    booking_details MAP<STRING, STRING>,
    uuid STRING NOT NULL,
    event_details STRUCT<event_name: STRING, event_type: STRING, event_value: STRING>
"""
USER_EVENT_SCHEMA = """
    event_id STRING NOT NULL,
    event_type STRING NOT NULL,
    user_id STRING NOT NULL,
    timestamp STRING NOT NULL,
    session_id STRING,
    page_url STRING,
    action STRING,
    duration_ms INT,
    properties MAP<STRING, STRING>
"""
PAGE_ACTIVITY_SCHEMA = """
    user_id STRING,
    session_id STRING,
    timestamp TIMESTAMP,
    page STRING,
    action STRING,
    duration_seconds INT
"""
# Envelope columns no table keeps, and the time format of user events.
ENVELOPE_REST = ["key", "topic", "partition", "offset", "timestampType"]
USER_EVENT_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

#: What the time of a message may be, measured against the broker's timestamp. Bounded tables take late events.
BATCH_CLOCK, STREAM_CLOCK = ClockRules(), ClockRules(most_late=timedelta(minutes=10))
#: Where the parser puts the broker's timestamp.
ARRIVAL = "kafka_timestamp"
#: Column, not written, by which writes of session streams choose the number of files of a partition.
PARTITION_ROWS = "_partition_rows"

Transform = Callable[[DataFrame], DataFrame]


def run_batch(source: DataFrame, transforms: Iterable[Transform], sink: Callable[[DataFrame], None]) -> None:
    """An empty list of transforms copies the source."""
    for transform in transforms:
        source = source.transform(transform)
    sink(source)


def run_stream(source: DataFrame, transforms: Iterable[Transform], **write) -> StreamingQuery:
    for transform in transforms:
        source = source.transform(transform)
    return write_stream(source, **write)


def with_reason(messages: DataFrame, clock: ClockRules | None = BATCH_CLOCK) -> DataFrame:
    """Parsed clickstream messages with event time, their text and why they are no usable event, if so.

    The reason is null for a usable event. It depends on the message alone, so bounded tables and streams agree under the same
    ``clock``, and events and rejects are all messages, each once. Messages without a broker timestamp are measured
    against the time of the batch.
    """
    events = normalise_event_time(parse_json(messages, to_schema(CLICKSTREAM_SCHEMA)).drop(*ENVELOPE_REST))
    time_ms = F.col("event_time_ms")
    reason = F.when(F.col("uuid").isNull(), "no user").when(time_ms.isNull(), "no readable time")
    if clock is not None:
        arrival = arrival_time(ARRIVAL if ARRIVAL in events.columns else None)
        reason = F.coalesce(reason, clock_reason(time_ms, arrival, clock))
    return events.withColumn("reason", reason)


def clickstream_events(messages: DataFrame, clock: ClockRules | None = BATCH_CLOCK) -> DataFrame:
    """Typed clickstream events from envelope rows, with event time; see ``clickstream_rejects`` for the others."""
    return with_reason(messages, clock).filter("reason IS NULL").drop("reason", "value")


def clickstream_rejects(messages: DataFrame, clock: ClockRules | None = BATCH_CLOCK) -> DataFrame:
    """``value`` and ``reason`` of the messages that ``clickstream_events`` leaves out."""
    return with_reason(messages, clock).filter("reason IS NOT NULL").select("value", "reason")


def land(events: DataFrame, path: str) -> DataFrame:
    """Write typed rows once and read them back, so that later passes neither read nor parse messages again."""
    events.write.parquet(path)
    return events.sparkSession.read.schema(events.schema).parquet(path)


def sessions_batch(
    messages: DataFrame,
    sink: Callable[[DataFrame], None],
    rejects: Callable[[DataFrame], None] | None = None,
    landing: str | None = None,
    clock: ClockRules | None = BATCH_CLOCK,
    **limits,
) -> None:
    """Bounded messages to sessionised event rows with layout columns; what is no event goes to ``rejects``.

    Messages are read and parsed once, into Parquet at ``landing`` (by default a new folder under the shared
    one), before anything is counted: the busy users are counted on the landed user column while
    the plan is built, which runs a job. The landed rows are needed until ``sink`` has run.
    """
    spark = messages.sparkSession
    path = landing or f"{shared_dir(spark).rstrip('/')}/landed-{uuid.uuid4().hex}"
    landed = land(with_reason(messages, clock), path)
    if rejects is not None:
        rejects(landed.filter("reason IS NOT NULL").select("value", "reason"))
    run_batch(
        landed.filter("reason IS NULL").drop("reason", "value"),
        [lambda e: detect_sessions(e, **limits), add_layout_columns],
        sink,
    )


def sessions_stream(
    messages: DataFrame, limits: dict | None = None, clock: ClockRules = STREAM_CLOCK, **write
) -> StreamingQuery:
    """Message stream to a session table partitioned by date and user bucket.

    ``rejects_stream`` is a second query over the same messages, for what is no event, has a wrong clock or is late: between
    them they have every message once, whatever batches either of them is cut into. The watermark waits for all that
    ``clock`` lets through. ``dropped_rows`` of the query tells whether partitions lagged by more than ``clock.slack``.
    """
    return run_stream(
        messages,
        _to_sessions(limits, clock),
        stateful=True,
        partition_by=SESSION_PARTITIONS,
        partition_rows=PARTITION_ROWS,
        **write,
    )


def sessions_to_table(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    settings: dict | None = None,
    limits: dict | None = None,
    clock: ClockRules = STREAM_CLOCK,
    properties: dict[str, str] | None = SESSION_TABLE_PROPERTIES,
    format: str = "parquet",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Message stream to the catalog table of sessions, which is created with its properties if it is not there.

    Batches are written with ``batch_writer``: rows are clustered, and a batch that Spark runs again, after a failure at
    whatever point, leaves its rows there once. ``settings`` are those of a streaming table write, such as ``merge_schema``.
    """
    options = table_stream_options(settings or {})
    writer = batch_writer(
        f"{checkpoint}/ledger",
        table=table,
        partition_by=SESSION_PARTITIONS,
        merge_schema=options.pop("mergeSchema") == "true",
        properties={**(properties or {}), **options},
        format=format,
        partition_rows=PARTITION_ROWS,
    )
    return run_stream(
        messages, _to_sessions(limits, clock), checkpoint=checkpoint, stateful=True, trigger=trigger, each_batch=writer
    )


def _to_sessions(limits: dict | None, clock: ClockRules) -> list[Transform]:
    given = {"delay": clock.watermark_delay, **(limits or {})}
    return [
        lambda m: clickstream_events(m, clock),
        lambda e: stream_session_events(e, clock=None, rows=PARTITION_ROWS, **given),
        add_layout_columns,
    ]


def rejects_stream(messages: DataFrame, clock: ClockRules = STREAM_CLOCK, **write) -> StreamingQuery:
    """Messages that ``sessions_stream`` leaves out, with the reason."""
    return run_stream(messages, [lambda m: clickstream_rejects(m, clock)], **write)


REQUIRED = ("event_id", "event_type", "user_id", "timestamp")


def _parsed_user_events(messages: DataFrame) -> DataFrame:
    return parse_timestamp(parse_json(messages, to_schema(USER_EVENT_SCHEMA)), "timestamp", USER_EVENT_TIME)


def typed_rejects(messages: DataFrame) -> DataFrame:
    """``value`` and ``reason`` (the first required field that is missing or unreadable) of what ``typed_events`` leaves out."""
    events = _parsed_user_events(messages)
    reason = F.coalesce(*[F.when(F.col(c).isNull(), f"no {c}") for c in REQUIRED])
    return events.select("value", reason.alias("reason")).filter("reason IS NOT NULL")


def typed_events(messages: DataFrame, delay: str = "10 minutes", by_date: bool = False) -> DataFrame:
    """Typed user events without heartbeats; the stamp is the processing time. See ``typed_rejects`` for the others."""
    events = with_processing_time(_parsed_user_events(messages))
    events = apply_steps(
        events,
        [
            {"filter": " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED)},
            {"filter": "event_type != 'heartbeat'"},
            {"watermark": f"timestamp, {delay}"},
            {"drop": ["value", "kafka_timestamp", *ENVELOPE_REST]},
        ],
    )
    return with_date_column(events, events["timestamp"], "event_date") if by_date else events


def typed_events_stream(messages: DataFrame, by_date: bool = False, **write) -> StreamingQuery:
    """Message stream to a typed event table partitioned by event type, optionally by date."""
    partitions = ["event_type"] + (["event_date"] if by_date else [])
    return run_stream(
        messages, [lambda m: typed_events(m, by_date=by_date)], partition_by=partitions, **write
    )


def filter_files(
    spark: SparkSession,
    source: str,
    target: str,
    source_format: str = "parquet",
    target_format: str = "parquet",
    predicate: str | None = None,
    columns: list[str] | None = None,
    source_options: dict[str, str] | None = None,
    mode: str = "overwrite",
    partition_by: list[str] = (),
) -> None:
    """Files to files, with an optional filter and column list."""
    steps = [{"filter": predicate}] if predicate else []
    steps += [{"select": columns}] if columns else []
    run_batch(
        read_files(spark, source, source_format, options=source_options),
        [lambda df: apply_steps(df, steps)],
        lambda df: write_files(df, target, target_format, mode, partition_by),
    )


def quality_files(
    spark: SparkSession,
    source: str,
    target: str,
    source_format: str = "parquet",
    target_format: str = "parquet",
    source_options: dict[str, str] | None = None,
    **rules,
) -> None:
    """Files to files, keeping only the rows that satisfy the quality rules."""
    run_batch(
        read_files(spark, source, source_format, options=source_options),
        [lambda df: clean_rows(df, **rules)],
        lambda df: write_files(df, target, target_format),
    )


def activity_windows(messages: DataFrame, delay: str = "30 minutes", clock: ClockRules | None = BATCH_CLOCK) -> DataFrame:
    """Half-hour totals per user and session, with the window's date to partition by."""
    pages = parse_json(messages, to_schema(PAGE_ACTIVITY_SCHEMA), keep_value=False)
    arrival = ARRIVAL if ARRIVAL in pages.columns else None
    totals = stream_windowed_activity(pages, ["user_id", "session_id"], delay=delay, clock=clock, arrival=arrival)
    return with_date_column(totals, totals["window.start"], "window_date")


def activity_stream(messages: DataFrame, **write) -> StreamingQuery:
    return run_stream(
        messages, [activity_windows], stateful=True, partition_by=["window_date"], **write
    )
