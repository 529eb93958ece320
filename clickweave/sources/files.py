"""Bounded and unbounded file scans, and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickweave.functions.schema import to_schema

# The file formats a job may name. avro and delta need their jar on the class path.
FILE_FORMATS = ("parquet", "csv", "json", "avro", "orc", "delta", "text")


def read_files(
    spark: SparkSession,
    path: str | list[str],
    format: str = "parquet",
    schema=None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A lazy scan; nothing is counted or sampled unless the options ask for inference."""
    _check(format)
    reader = spark.read.format(format).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(to_schema(schema))
    return reader.load(path)


def stream_files(
    spark: SparkSession,
    path: str,
    schema,
    format: str = "parquet",
    max_files_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A stream of the files that appear in a folder."""
    _check(format)
    reader = spark.readStream.format(format).schema(to_schema(schema)).options(**(options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _check(format: str) -> None:
    if format not in FILE_FORMATS:
        raise ValueError(f"unsupported file format {format!r}; choose from {FILE_FORMATS}")
