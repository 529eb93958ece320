"""Helpers shared by the training-data operators: scratch tables, free column names, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.session import shared_dir, ship_package


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, *names: str) -> str | list[str]:
    """Each name, with underscores added until ``df`` has no such column (whatever its case)."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found[0] if len(names) == 1 else found


def column(df: DataFrame, name: str) -> Column:
    """The column called exactly ``name``, dots and all."""
    return df["`" + name.replace("`", "``") + "`"]


#: Rows and bytes of a batch of texts sent to a Python worker; they bound its memory, and that of the buffers beside it.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """From now on the session sends batches of at most this size to Python; a smaller setting stays.

    Its workers can import this package, wherever they run.
    """
    ship_package(spark)
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key).lower().removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


#: Tables that operators have written since the innermost ``collecting`` began.
_collectors: list[list[Scratch]] = []


class Scratch:
    """Tables written under the shared checkpoint folder, so that a lost executor costs no recomputation.

    ``keep`` writes a table and reads it back; ``drop`` deletes one that no plan reads any more.
    What the returned plan of an operator still reads has to stay until that plan has run; ``collecting`` drops it then.
    """

    def __init__(self, spark: SparkSession, label: str):
        ship_package(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self.count = 0
        if _collectors:
            _collectors[-1].append(self)

    def keep(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        # The schema is known, so no job is needed to read it from the files.
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *numbers: int) -> None:
        for number in numbers:
            self._delete(f"{self.root}/{number}")

    def drop_all(self) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def collecting() -> Iterator[None]:
    """Drops all tables that operators write inside, at the end. Results have to be written before."""
    made: list[Scratch] = []
    _collectors.append(made)
    try:
        yield
    finally:
        _collectors.remove(made)
        for scratch in made:
            scratch.drop_all()


#: Files whose rows are numbered by place; the list of them goes to every executor.
MOST_FILES = 1_000_000
#: Bits of a row's place in its file.
PLACE_BITS = 40


def numbered(docs: DataFrame, row: str, scratch: Scratch) -> DataFrame:
    """``docs`` with a number for each row in the column ``row``, the same in every later job.

    Where ``docs`` is a scan of Parquet files, with columns chosen and rows filtered at most, the number is made of the file and the
    row's place in it, and nothing is written. Anything else is numbered as it is and written with its numbers: a plan that
    runs again may split its input otherwise (split sizes follow the cores registered at that time).
    """
    if _is_scan(docs):
        path, place, at, name = free_name(docs, "file_path", "file_place", "file_number", "known_path")
        try:
            placed = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(place))
        except AnalysisException:
            placed = None  # no Parquet, or a column of that name
        if placed is not None:
            files = sorted(r[0] for r in placed.select(path).distinct().limit(MOST_FILES + 1).collect())
            if len(files) <= 1:
                return placed.withColumn(row, F.col(place)).drop(path, place)
            if len(files) <= MOST_FILES:
                # From Arrow: a list of rows would pass through Python workers on the executors, which then stay beside the others.
                known = docs.sparkSession.createDataFrame(pa.table({at: pa.array(range(len(files)), pa.int64()), name: files}))
                placed = placed.join(F.broadcast(known), F.col(path) == F.col(name))
                number = F.shiftleft(F.col(at), PLACE_BITS).bitwiseOR(F.col(place))
                return placed.withColumn(row, number).drop(path, place, at, name)
    return scratch.keep(docs.withColumn(row, F.monotonically_increasing_id()))


def _is_scan(docs: DataFrame) -> bool:
    plan = docs._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.child()
    return plan.getClass().getSimpleName() == "LogicalRelation"


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Smallest node reachable from each node that has an edge.

    ``edges`` has bigint columns ``a`` and ``b``; direction, repeats and loops do not matter. Returns
    ``node`` and ``root`` for every node but the roots themselves. Stars are merged in turns (larger
    neighbours point to the smallest one, then smaller ones do), so the number of rounds grows with
    the logarithm of the longest chain. Every round is two aggregates combined before their shuffle and
    joins whose skewed side Spark splits; it is written and read back, nothing reaches the driver
    but one count.
    """
    forest = scratch.keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    )
    while True:
        both = forest.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            forest.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(smallest, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        before = scratch.count
        forest = scratch.keep(small.union(smallest.select("hi", F.col("m").alias("lo"))).distinct())
        scratch.drop(before)
        parents = forest.groupBy("hi").agg(F.count(F.lit(1)).alias("n"))
        open_nodes = parents.where("n > 1").select("hi").union(
            forest.select("lo").distinct().join(parents, F.col("lo") == F.col("hi"), "left_semi")
        )
        if open_nodes.limit(1).count() == 0:
            return forest.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
