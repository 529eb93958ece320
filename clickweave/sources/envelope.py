"""Messages in the shape a broker delivers them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_envelope(
    df: DataFrame,
    key: str = "uuid",
    topic: str = "clickstream",
    offset: Column | None = None,
    time: Column | None = None,
) -> DataFrame:
    """Wrap each row as a message whose value is the row in JSON."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns)).alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        (offset if offset is not None else F.monotonically_increasing_id()).cast("bigint").alias("offset"),
        (time if time is not None else F.current_timestamp()).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
