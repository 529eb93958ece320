"""Streaming writes: files, catalog tables, Kafka, console, memory and foreachBatch."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from clickweave.session import written
from clickweave.sinks.tables import ensure_table, write_table

OUTPUT_MODES = ("append", "complete", "update")
# Fixed value: how often a stream runs when the job does not say.
DEFAULT_TRIGGER = {"processingTime": "10 seconds"}
#: Files that one micro-batch writes into one partition at most; so many tasks share the rows of a hot one.
FILES_PER_PARTITION = 4
#: Rows that a partition gets in a micro-batch, where that is known, for each of these files.
ROWS_PER_FILE = 100_000
#: Last partition column of what ``batch_writer`` writes.
BATCH = "batch"


def trigger_arguments(trigger: dict[str, Any] | None, stateful: bool = False) -> dict[str, Any]:
    """Arguments for ``DataStreamWriter.trigger``.

    ``once`` becomes ``availableNow``: it also processes everything there is and stops, but in
    batches of bounded size.
    """
    chosen = {k: v for k, v in (trigger or DEFAULT_TRIGGER).items() if v}
    if len(chosen) != 1:
        raise ValueError(f"exactly one trigger is required, not {trigger!r}")
    kind, value = next(iter(chosen.items()))
    if kind in ("once", "availableNow"):
        return {"availableNow": True}
    if kind == "processingTime":
        return {"processingTime": value}
    if kind == "continuous" and not stateful:
        return {"continuous": value}
    raise ValueError(f"trigger {kind!r} is not supported{' for stateful queries' if stateful else ''}")


def write_stream(
    df: DataFrame,
    checkpoint: str,
    format: str = "parquet",
    path: str | None = None,
    table: str | None = None,
    output_mode: str = "append",
    trigger: dict[str, Any] | None = None,
    partition_by: list[str] = (),
    options: dict[str, str] | None = None,
    name: str | None = None,
    stateful: bool = False,
    each_batch: Callable[[DataFrame, int], None] | None = None,
    files_per_partition: int = FILES_PER_PARTITION,
    partition_rows: str | None = None,
) -> StreamingQuery:
    """Start a streaming write; give ``table`` for a catalog table, ``path`` for files.

    Partitioned rows are clustered first, see ``clustered``; ``files_per_partition`` 0 writes them as they come, from every task.
    The column ``partition_rows`` is not written.
    """
    if output_mode not in OUTPUT_MODES:
        raise ValueError(f"output mode must be one of {OUTPUT_MODES}")
    if partition_by and files_per_partition and "continuous" not in (trigger or {}):
        df = clustered(df, partition_by, files_per_partition, partition_rows)
    elif partition_rows is not None:
        df = df.drop(partition_rows)
    writer = (
        df.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .options(**(options or {}))
        .trigger(**trigger_arguments(trigger, stateful))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    if each_batch is not None:
        return writer.foreachBatch(each_batch).start()
    writer = writer.format(format)
    if table:
        return writer.toTable(table)
    return writer.start(path) if path else writer.start()


def clustered(
    df: DataFrame, partition_by: list[str], files_per_partition: int = FILES_PER_PARTITION, partition_rows: str | None = None
) -> DataFrame:
    """The rows shuffled so that each partition is written by at most ``files_per_partition`` tasks.

    The rows of a partition are dealt by a hash of all their columns, so one that holds a third of all rows is shared evenly,
    and a task that runs again gets the same rows. ``partition_rows`` names a column that says about how many rows the partition has, which is
    left out: there is one task then for each ``ROWS_PER_FILE`` of them, up to that number, so that small partitions are one file.
    """
    left_out = [*partition_by, partition_rows]
    hashed = [F.col(f"`{f.name}`") for f in df.schema if f.name not in left_out and _hashable(f.dataType)]
    files = F.lit(files_per_partition)
    if partition_rows is not None:
        files = F.least(files, F.greatest(F.ceil(F.col(partition_rows) / ROWS_PER_FILE).cast("int"), F.lit(1)))
    salt = F.pmod(F.xxhash64(*hashed), files) if hashed else F.lit(0)
    rows = df.repartition(*[F.col(f"`{c}`") for c in partition_by], salt)
    return rows if partition_rows is None else rows.drop(partition_rows)


def _hashable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_hashable(f.dataType) for f in kind)
    return not isinstance(kind, (MapType, VariantType))


def batch_writer(
    ledger: str,
    path: str | None = None,
    table: str | None = None,
    partition_by: list[str] = (),
    files_per_partition: int = FILES_PER_PARTITION,
    merge_schema: bool = False,
    properties: dict[str, str] | None = None,
    format: str = "parquet",
    partition_rows: str | None = None,
) -> Callable[[DataFrame, int], bool]:
    """A function for ``foreachBatch`` that leaves a batch's rows there once, however often Spark runs the batch.

    Rows go to partitions by ``partition_by`` and, last, the batch, which a batch that runs again replaces. The ``ledger``
    folder has an entry for every batch that is whole, and such a batch is not run again; it also has an id of its own, so a
    stream that begins anew, with a new ledger, never replaces what another one wrote. Give ``path`` for files or ``table`` for a
    catalog table, which the first batch creates with ``properties`` if it is not there; ``merge_schema`` adds columns that
    it lacks. ``partition_rows`` is as for ``clustered``. What a batch holds has to follow from its input alone; the processing time must not choose its partitions.
    The function returns whether it has written.
    """
    if (path is None) == (table is None):
        raise ValueError("give either path or table")
    parts = [*partition_by, BATCH]

    def write(batch: DataFrame, batch_id: int) -> bool:
        spark = batch.sparkSession
        entry = f"{ledger}/batches/{batch_id}"
        if written(spark, entry):
            return False
        if not written(spark, f"{ledger}/id"):
            spark.createDataFrame([(uuid.uuid4().hex,)], "id string").write.mode("overwrite").parquet(f"{ledger}/id")
        name = f"{spark.read.parquet(f'{ledger}/id').first().id}-{batch_id}"
        rows = clustered(batch.withColumn(BATCH, F.lit(name)), parts, files_per_partition, partition_rows)
        if table is not None:
            ensure_table(spark, table, rows.schema, partition_by=parts, properties=properties, format=format)
            write_table(rows, table, "overwrite", parts, format, merge_schema=merge_schema, gather=False)
        else:
            writer = rows.write.format(format).mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(*parts).save(path)
        spark.range(batch_id, batch_id + 1).write.mode("overwrite").parquet(entry)
        return True

    return write


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the watermark has kept out of state so far, in the batches whose progress the query still holds.

    Above zero, the source's partitions lag behind each other by more than the watermark waits.
    """
    return sum(int(op["numRowsDroppedByWatermark"]) for batch in query.recentProgress for op in batch["stateOperators"])


def table_stream_options(settings: dict[str, Any]) -> dict[str, str]:
    """Options of a streaming table write: schema merging, open files, pass-through ``iceberg.*``."""
    options = {"mergeSchema": str(settings.get("merge_schema", True)).lower()}
    if settings.get("fanout_enabled"):
        options["fanout-enabled"] = "true"
    options |= {k: str(v) for k, v in settings.items() if k.startswith("iceberg.")}
    return options


def kafka_payload(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as Kafka records: the whole row as JSON text in ``value``."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def kafka_options(settings: dict[str, Any]) -> dict[str, str]:
    """Writer options of the Kafka sink."""
    servers = settings.get("kafka.bootstrap.servers") or settings.get("bootstrap_servers")
    topic = settings.get("topic")
    if not servers or not topic:
        raise ValueError("kafka.bootstrap.servers and topic are required")
    passed = {k: str(v) for k, v in settings.items() if k.startswith("kafka.")}
    return {**passed, "kafka.bootstrap.servers": str(servers), "topic": str(topic)}
