"""Sessions of a growing table, one time slice after another, without going back over history.

What a slice has to know of the past is small: the rows of sessions that were still open when the last slice ended, and how many
sessions each user had finished. Under ``greedy`` an open session lasts no longer than the cap, so what is carried does not
grow with history; a session's first row is the anchor of its cap, so detection over carried and new rows goes on as if it
had seen everything.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators.busy_users import BusyUsers
from clickweave.operators.sessions import SessionRules, detect_sessions, usable_events


@dataclass
class SessionTable:
    """Event rows with their sessions under ``root``, extended by ``add``.

    ``rows/slice=<end>/open=<true|false>`` has what a slice found, ``finished/slice=<end>`` each user's number of finished
    sessions by then; a slice is named by its end in epoch milliseconds and done once ``finished`` is whole. A slice that
    failed or is run again replaces what it wrote before, so a run can be repeated at any point.
    """

    spark: SparkSession
    root: str
    user: str = "uuid"
    time_ms: str = "event_time_ms"
    inactivity_minutes: float = 30
    max_minutes: float = 120
    busy: BusyUsers | None = field(default_factory=BusyUsers)

    def __post_init__(self):
        self.rules = SessionRules(self.inactivity_minutes, self.max_minutes, "greedy")

    def slices(self) -> list[int]:
        """Ends of the slices that are done, in order. Names of folders are read, no files."""
        folder = self._path(f"{self.root}/finished")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        found = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(n.removeprefix("slice=")) for n in found if self._exists(f"{self.root}/finished/{n}/_SUCCESS"))

    def add(self, events: DataFrame, until_ms: int) -> DataFrame:
        """Take in the events from the end of the last slice up to ``until_ms``; returns those that are too late.

        ``events`` may hold more: later ones are left for later slices, earlier ones belong to a slice that is done and come back.
        Events without user or time are in no session. Only the last slice may be run again.
        """
        before = [end for end in self.slices() if end < until_ms]
        if any(end > until_ms for end in self.slices()):
            raise ValueError(f"a slice after {until_ms} is done")
        since = before[-1] if before else None
        usable = usable_events(events, self.user, self.time_ms)
        now = F.col(self.time_ms)
        rows = usable.filter(now < until_ms) if since is None else usable.filter((now >= since) & (now < until_ms))
        finished = None
        if since is not None:
            rows = rows.unionByName(self._open_rows(since).select(*[f"`{c}`" for c in events.columns]))
            finished = self.spark.read.parquet(f"{self.root}/finished/slice={since}")
        found = self._detect(rows, finished).withColumn("open", self._may_go_on(until_ms))
        found.write.mode("overwrite").partitionBy("open").parquet(f"{self.root}/rows/slice={until_ms}")
        if since is None:
            # A slice without rows leaves no file that would tell the columns.
            found.drop("open").limit(0).write.mode("overwrite").parquet(f"{self.root}/columns")
        self._count(finished, until_ms)
        return usable.filter(F.lit(False) if since is None else now < since)

    def rows(self) -> DataFrame:
        """All event rows so far with session id, start, end and duration, those of open sessions as they stand."""
        done = self.slices()
        if not done:
            raise ValueError("no slice is done")
        paths = [f"{self.root}/rows/slice={end}/open=false" for end in done] + [f"{self.root}/rows/slice={done[-1]}/open=true"]
        return self._read(paths)

    def open_sessions(self) -> DataFrame:
        """User, start, end and event count of the sessions that are open at the end of the last slice: where a stream goes on."""
        carried = self._open_rows(self.slices()[-1])
        return carried.groupBy(self.user).agg(
            F.min(self.time_ms).alias("session_start_time_ms"),
            F.max(self.time_ms).alias("session_end_time_ms"),
            F.count(F.lit(1)).alias("event_count"),
        )

    def _detect(self, rows: DataFrame, finished: DataFrame | None) -> DataFrame:
        limits = {"inactivity_minutes": self.inactivity_minutes, "max_minutes": self.max_minutes, "policy": "greedy"}
        if finished is None:
            return detect_sessions(rows, self.user, self.time_ms, busy=self.busy, **limits)
        rows = rows.join(finished.withColumnRenamed("sessions", "_earlier"), self.user, "left")
        return detect_sessions(rows, self.user, self.time_ms, busy=self.busy, earlier="_earlier", **limits).drop("_earlier")

    def _may_go_on(self, until_ms: int):
        """Whether an event at ``until_ms`` or later can still belong to the session."""
        near = F.col("session_end_time_ms") + self.rules.gap_ms >= until_ms
        return near & (F.col("session_start_time_ms") + self.rules.cap_ms >= until_ms)

    def _count(self, finished: DataFrame | None, until_ms: int) -> None:
        closed = self._read([f"{self.root}/rows/slice={until_ms}/open=false"]).select(self.user, "session_start_time_ms").distinct()
        counts = closed.groupBy(self.user).agg(F.count(F.lit(1)).alias("sessions"))
        if finished is not None:
            counts = finished.unionByName(counts).groupBy(self.user).agg(F.sum("sessions").alias("sessions"))
        counts.write.mode("overwrite").parquet(f"{self.root}/finished/slice={until_ms}")

    def _open_rows(self, end: int) -> DataFrame:
        return self._read([f"{self.root}/rows/slice={end}/open=true"])

    def _read(self, paths: list[str]) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.root}/columns").schema
        there = [path for path in paths if self._exists(path)]
        return self.spark.read.schema(schema).parquet(*there) if there else self.spark.createDataFrame([], schema)

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _exists(self, path: str) -> bool:
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(self._path(path))
