"""Catalog tables: built-in (Parquet) tables, or a V2 catalog such as Iceberg when installed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickweave.sinks.files import gather_partitions

TABLE_MODES = ("append", "overwrite", "create", "replace")

# Properties of the session table in an Iceberg catalog.
SESSION_TABLE_PROPERTIES = {
    "write.format.default": "parquet",
    "write.parquet.compression-codec": "zstd",
    "write.target-file-size-bytes": "134217728",
    "write.distribution-mode": "hash",
    "commit.retry.num-retries": "3",
    "commit.retry.min-wait-ms": "100",
    "commit.retry.max-wait-ms": "60000",
    "history.expire.max-snapshot-age-ms": "432000000",
    "write.metadata.delete-after-commit.enabled": "true",
    "write.metadata.previous-versions-max": "100",
    "read.split.target-size": "134217728",
    "format-version": "2",
}
SESSION_PARTITIONS = ["session_date", "user_hash_bucket"]

# Implementation classes of the supported catalog kinds.
ICEBERG_CATALOG = "org.apache.iceberg.spark.SparkCatalog"
ICEBERG_EXTENSIONS = "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"
CATALOG_IMPLEMENTATIONS = {
    "glue": "org.apache.iceberg.aws.glue.GlueCatalog",
    "rest": "org.apache.iceberg.rest.RESTCatalog",
}


def catalog_conf(
    name: str, kind: str = "hadoop", warehouse: str | None = None, uri: str | None = None, **extra: str
) -> dict[str, str]:
    """Session settings for an Iceberg catalog, to be passed when the session is built."""
    if kind not in ("hadoop", "hive", "glue", "rest"):
        raise ValueError(f"unknown catalog kind {kind!r}")
    if kind in ("hadoop", "glue") and not warehouse:
        raise ValueError(f"a {kind} catalog needs a warehouse")
    if kind in ("hive", "rest") and not uri:
        raise ValueError(f"a {kind} catalog needs a uri")
    prefix = f"spark.sql.catalog.{name}"
    conf = {"spark.sql.extensions": ICEBERG_EXTENSIONS, prefix: ICEBERG_CATALOG}
    if kind in CATALOG_IMPLEMENTATIONS:
        conf[f"{prefix}.catalog-impl"] = CATALOG_IMPLEMENTATIONS[kind]
    else:
        conf[f"{prefix}.type"] = kind
    settings = {"warehouse": warehouse, "uri": uri, **extra}
    return conf | {f"{prefix}.{k}": v for k, v in settings.items() if v is not None}


def table_ddl(
    name: str,
    schema: StructType,
    partition_by: list[str] = (),
    properties: dict[str, str] | None = None,
    format: str = "parquet",
    location: str | None = None,
) -> str:
    """CREATE TABLE text for the schema a job really produces."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    text = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {format}"
    if partition_by:
        text += f" PARTITIONED BY ({', '.join(partition_by)})"
    if location:
        text += f" LOCATION '{location}'"
    if properties:
        listed = ", ".join(f"'{key}' = '{value}'" for key, value in properties.items())
        text += f" TBLPROPERTIES ({listed})"
    return text


def ensure_table(spark: SparkSession, name: str, schema: StructType, **layout) -> bool:
    """Create the table if it is absent; True if it was created. Any failure is raised."""
    if spark.catalog.tableExists(name):
        return False
    spark.sql(table_ddl(name, schema, **layout))
    return True


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "append",
    partition_by: list[str] = (),
    format: str = "parquet",
    properties: dict[str, str] | None = None,
    location: str | None = None,
    merge_schema: bool = False,
    gather: bool = True,
) -> None:
    """Write a bounded table.

    ``create`` fails if the table exists; ``replace`` swaps its whole content; ``append`` adds
    rows; ``overwrite`` replaces only the partitions present in ``df``. The last two create the
    table when it is absent. Both raise an error if the columns differ from the table's; with ``merge_schema``
    new columns are added to the table first, and columns that ``df`` lacks are null. ``gather`` brings the rows of a partition
    together first; leave it out for rows that are clustered already.
    """
    if mode not in TABLE_MODES:
        raise ValueError(f"unsupported table mode {mode!r}; choose from {TABLE_MODES}")
    if format == "iceberg":
        _write_v2(df, name, mode, partition_by, properties)
        return
    exists = df.sparkSession.catalog.tableExists(name)
    if exists and mode in ("append", "overwrite"):
        df = match_columns(df, name, merge_schema)
    rows = gather_partitions(df, partition_by) if gather else df
    if mode == "overwrite" and exists:
        _replace_partitions(rows, name)
        return
    writer = rows.write.format(format).mode(
        {"create": "errorifexists", "replace": "overwrite"}.get(mode, "append")
    )
    writer = writer.options(**(properties or {}))
    if location:
        writer = writer.option("path", location)
    writer.partitionBy(*partition_by).saveAsTable(name)


def write_bucketed(df: DataFrame, name: str, user: str, buckets: int, sort_by: list[str] = (), location: str | None = None) -> None:
    """Replace a table laid out so that what groups by ``user`` needs no shuffle.

    Rows are shuffled here, once, to one task per bucket, which writes one sorted file. Whoever detects sessions on the table,
    rolls them up or joins it by user later reads each bucket where it is. Choose ``buckets`` for files that a task can hold; a user
    with a large share of the rows makes its bucket that large, so tables with such users are better left to the busy path.
    """
    writer = df.repartition(buckets, user).write.mode("overwrite").bucketBy(buckets, user).sortBy(user, *sort_by)
    (writer.option("path", location) if location else writer).saveAsTable(name)


def match_columns(df: DataFrame, name: str, merge_schema: bool = False) -> DataFrame:
    """``df`` with the columns of a table in its order, after adding new ones to the table if asked to."""
    spark = df.sparkSession
    there = spark.table(name).columns
    known, given = {c.lower() for c in there}, {c.lower() for c in df.columns}
    if known != given and not merge_schema:
        raise ValueError(f"columns differ from those of {name}: {sorted(known ^ given)}")
    new = [f for f in df.schema.fields if f.name.lower() not in known]
    if new:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
    kinds = spark.table(name).schema
    return df.select(
        *[df[f"`{f.name}`"] if f.name.lower() in given else F.lit(None).cast(f.dataType).alias(f.name) for f in kinds]
    )


def _replace_partitions(rows: DataFrame, name: str) -> None:
    # insertInto goes by position, and the rows follow the table's own column order. It takes the overwrite
    # mode from the session, so the write has a session of its own that other writes cannot see.
    spark, view = rows.sparkSession, f"rows_{uuid.uuid4().hex}"
    own = spark.newSession()
    for setting in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(setting, spark.conf.get(setting))
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rows.createGlobalTempView(view)
    try:
        target = name if "." in name else f"{spark.catalog.currentDatabase()}.{name}"
        own.table(f"global_temp.{view}").write.mode("overwrite").insertInto(target)
    finally:
        spark.catalog.dropGlobalTempView(view)
    spark.catalog.refreshTable(name)


def _write_v2(df: DataFrame, name, mode, partition_by, properties) -> None:
    exists = df.sparkSession.catalog.tableExists(name)
    writer = df.writeTo(name)
    if mode == "append" and exists:
        writer.append()
        return
    if mode == "overwrite" and exists:
        writer.overwritePartitions()
        return
    writer = writer.using("iceberg")
    if partition_by:
        writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
    for key, value in (properties or {}).items():
        writer = writer.tableProperty(key, value)
    if mode == "replace":
        writer.createOrReplace()
    else:
        writer.create()


def table_partitions(spark: SparkSession, name: str) -> DataFrame:
    """The partitions of a built-in catalog table, one ``column=value/...`` text per row."""
    return spark.sql(f"SHOW PARTITIONS {name}")


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


def table_properties(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW TBLPROPERTIES {name}")
