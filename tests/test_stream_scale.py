"""Streams at scale: tables are landed by all tasks, and calls into the state do not grow with the users."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from clickweave.plans import stream_queries
from clickweave.streaming.capped import ClosedSessions, MomentStarts, session_starts


def test_arrivals_are_landed_by_all_tasks(spark, tmp_path, monkeypatch):
    """Each third of the messages came out of one task before, which joined and sorted all of it."""
    begin = datetime(2024, 1, 1)
    rows = [(i, begin + timedelta(minutes=i), i % 40, "click", 1.0, '{"k": 1}') for i in range(600)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(stream_queries, "scratch", lambda spark, label: f"{tmp_path}/{label}")
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = stream_queries.stream_late_rejects(spark, str(tmp_path)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r.event_id for r in found) == [i for i in range(600) if i % 13 == 5 and i % 40 % 17 != 3]
    assert len(list((tmp_path / "late_rejects-in").glob("*.parquet"))) >= 3 * 8
    assert len(list((tmp_path / "late_rejects-checkpoint/commits").glob("[0-9]*"))) >= 4


class Handle:
    """State in memory that counts the calls."""

    def __init__(self):
        self.calls, self.rows, self.timers = 0, [], set()

    def getListState(self, name, schema):
        return self

    def called(self):
        self.calls += 1

    def get(self):
        self.called()
        return iter(self.rows)

    def put(self, rows):
        self.called()
        self.rows = list(rows)

    def clear(self):
        self.called()
        self.rows = []

    def listTimers(self):
        self.called()
        return iter(sorted(self.timers))

    def registerTimer(self, at):
        self.called()
        self.timers.add(at)

    def deleteTimer(self, at):
        self.called()
        self.timers.remove(at)

    def getCurrentWatermarkInMs(self):
        return 0


@pytest.mark.parametrize("processor", [ClosedSessions, MomentStarts])
def test_calls_into_the_state(processor):
    """A list of sessions and a timer for a bucket of users; they were one of each a user."""
    calls = set()
    for users in (1, 300):
        handle, draw = Handle(), np.random.default_rng(users)
        runs = processor("uuid", "string", 60_000, 300_000)
        runs.init(handle)
        moments = {f"u{u}": np.unique(draw.integers(0, 3_000_000, 40)) for u in range(users)}
        frame = pd.DataFrame([(u, m, 1, False) for u, own in moments.items() for m in own], columns=["uuid", "moment", "events", "cut"])
        frame = frame.sample(frac=1, random_state=1)
        found = pd.concat(runs.handleInputRows((7,), iter([frame[:11], frame[11:]]), handle))
        calls.add(handle.calls)
        starts = {u: session_starts(own, None, None, 60_000, 300_000) for u, own in moments.items()}
        if processor is MomentStarts:
            expected = {(u, m, s) for u, own in moments.items() for m, s in zip(own, starts[u])}
            assert set(zip(found["uuid"], found["_moment"], found["session_start_time_ms"])) == expected and len(found) == len(frame)
        else:
            assert set(zip(found["uuid"], found["session_start_time_ms"])) == {(u, s) for u in moments for s in starts[u] if s < starts[u][-1]}
        assert {r[0]: r[1] for r in handle.rows} == {u: starts[u][-1] for u in moments} and len(handle.timers) == 1
    assert len(calls) == 1
