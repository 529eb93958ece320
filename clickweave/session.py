"""Spark session settings and lineage cutting."""

from __future__ import annotations

import hashlib
import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Checkpoint files go once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # Keyed session state lives on disk, not on the executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A batch commits what it changed; whole snapshots are uploaded in the background.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A stream has a small store for every partition and stateful step; 4 MB of disk are not set aside for each.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # The four tables of a stream-stream join are in one store a partition.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # Session windows on streams are merged before the shuffle, so a busy user sends few rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with this library's defaults; the master comes from ``spark-submit``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where driver and
    executors are one process, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="clickweave-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run.

    Its modules go into one archive in the shared folder, once per application, which Spark hands to every
    worker. Functions, classes and caches are then pickled by name, as in a job started with ``--py-files``.
    """
    context, root, packed = spark.sparkContext, Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            # A fixed date, so that equal code gives an equal name.
            archive.writestr(zipfile.ZipInfo(path.relative_to(root.parent).as_posix()), path.read_bytes())
    name = f"clickweave-{hashlib.sha256(packed.getvalue()).hexdigest()[:16]}.zip"
    if name in context._python_includes:
        return
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/{name}")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(target, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(files.makeQualified(target).toString())


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back as a new root."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(spark: SparkSession, folder: str) -> bool:
    """Whether a folder has been written to its end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
