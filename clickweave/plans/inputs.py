"""The given tables in the shapes the operators expect."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickweave.session import DEFAULT_CONF, shared_dir
from clickweave.sources.envelope import to_envelope
from clickweave.sources.files import read_files, stream_files

# Settings the results depend on, and the state store of stateful streams.
QUERY_CONF = (
    "spark.sql.session.timeZone",
    "spark.sql.streaming.stateStore.providerClass",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate",
    "spark.sql.streaming.join.stateFormatVersion",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition",
)


def prepare(spark: SparkSession) -> None:
    for key in QUERY_CONF:
        spark.conf.set(key, DEFAULT_CONF[key])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return read_files(spark, f"{sf_dir}/{name}.parquet")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as clickstream events with event time."""
    return as_clicks(table(spark, sf_dir, "events"))


def as_clicks(events: DataFrame) -> DataFrame:
    time = F.col("ts").cast("timestamp")
    return events.select(
        F.col("user_id").cast("string").alias("uuid"),
        "event_id",
        F.col("event_type").alias("page_name"),
        time.alias("event_time"),
        F.unix_millis(time).alias("event_time_ms"),
    )


def click_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_clicks(event_stream(spark, sf_dir))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return stream_files(spark, sf_dir, schema, options={"pathGlobFilter": "events.parquet"})


def end_marker(schema: StructType, user: str = "user_id", time: str = "ts") -> dict:
    """One row that closes a finished stream: an event of an own user (-1) at the end of time.

    It moves the watermark past every other event. Its own session or window stays open, so it never
    reaches the output.
    """
    kinds = {f.name: f.dataType for f in schema}
    row = {name: None for name in kinds} | {user: -1, time: datetime(9999, 12, 1)}
    return row | ({"event_id": -1} if "event_id" in kinds else {})


def click_messages(events: DataFrame) -> DataFrame:
    """Events as broker messages carrying clickstream JSON."""
    time = F.col("ts").cast("timestamp")
    messages = events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_type").alias("page_name"),
        F.unix_millis(time).cast("string").alias("event_timestamp"),
        F.create_map(F.lit("k"), F.get_json_object("props", "$.k")).alias("booking_details"),
        F.col("user_id").cast("string").alias("uuid"),
        F.struct(
            F.concat(F.lit("user-"), F.col("event_type")).alias("event_name"),
            F.lit("click").alias("event_type"),
            F.col("value").cast("string").alias("event_value"),
        ).alias("event_details"),
    )
    offset = F.col("event_id").cast("bigint")
    return to_envelope(messages, offset=offset, time=F.timestamp_millis(F.col("event_timestamp").cast("bigint")))


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
