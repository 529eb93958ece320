"""Kafka reads. The option maps are pure functions, so they can be checked without a broker."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Columns of the message envelope, with key and value as text.
ENVELOPE_COLUMNS = (
    "CAST(key AS STRING) AS key",
    "CAST(value AS STRING) AS value",
    "topic",
    "partition",
    "offset",
    "timestamp",
    "timestampType",
)


def stream_options(settings: dict[str, Any]) -> dict[str, str]:
    """Source options of an unbounded read, starting at the latest offsets by default."""
    return {"startingOffsets": "latest", **_source_options(settings)}


def batch_options(settings: dict[str, Any]) -> dict[str, str]:
    """Source options of a bounded read, from the earliest to the latest offsets by default."""
    options = {"startingOffsets": "earliest", "endingOffsets": "latest", **_source_options(settings)}
    options.pop("maxOffsetsPerTrigger", None)
    return options


def read_kafka_stream(spark: SparkSession, settings: dict[str, Any]) -> DataFrame:
    stream = spark.readStream.format("kafka").options(**stream_options(settings)).load()
    return stream.selectExpr(*ENVELOPE_COLUMNS)


def read_kafka(spark: SparkSession, settings: dict[str, Any]) -> DataFrame:
    table = spark.read.format("kafka").options(**batch_options(settings)).load()
    return table.selectExpr(*ENVELOPE_COLUMNS)


def _source_options(settings: dict[str, Any]) -> dict[str, str]:
    given = dict(settings)
    servers = given.pop("bootstrap_servers", None)
    group = given.pop("group_id", None)
    if "kafka.bootstrap.servers" not in given:
        if not servers:
            raise ValueError("kafka.bootstrap.servers is required")
        given["kafka.bootstrap.servers"] = servers
    if group is not None:
        given.setdefault("kafka.group.id", group)

    options = {k: str(v) for k, v in given.items() if k.startswith("kafka.")}
    options |= _topics(given)
    options["failOnDataLoss"] = str(given.get("failOnDataLoss", False)).lower()
    for name in ("startingOffsets", "endingOffsets", "maxOffsetsPerTrigger"):
        if name in given:
            value = given[name]
            options[name] = json.dumps(value) if isinstance(value, dict) else str(value)
    return options


def _topics(given: dict[str, Any]) -> dict[str, str]:
    if "topics" in given:
        if "subscribe" in given:
            raise ValueError("give either subscribe or topics")
        topics = given.pop("topics")
        given["subscribe"] = topics if isinstance(topics, str) else ",".join(topics)
    chosen = [name for name in ("subscribe", "subscribePattern", "assign") if name in given]
    if len(chosen) != 1:
        raise ValueError("exactly one of subscribe, subscribePattern and assign is required")
    value = given[chosen[0]]
    return {chosen[0]: value if isinstance(value, str) else json.dumps(value)}
