"""Bounded file writes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickweave.sources.files import FILE_FORMATS

MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


def write_files(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] = (),
    options: dict[str, str] | None = None,
) -> None:
    if format not in FILE_FORMATS or mode not in MODES:
        raise ValueError(f"unsupported format or mode: {format!r}, {mode!r}")
    gather_partitions(df, partition_by).write.format(format).mode(mode).options(
        **(options or {})
    ).partitionBy(*partition_by).save(path)


def gather_partitions(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Bring rows of one output partition together before a write.

    A rebalance lets adaptive execution join small partitions and split an oversized one, so a
    busy user's folder is written by several tasks and quiet folders do not become many tiny files.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df
