from collections import Counter
from datetime import timedelta

import numpy as np
import pytest
from brute import sessions as brute_sessions
from pyspark.sql import functions as F
from test_sessions import MINUTE, skewed_events

from clickweave.functions.event_time import ClockRules, clock_rejects
from clickweave.functions.layout import add_layout_columns
from clickweave.plans import jobs
from clickweave.sinks.streams import write_stream
from clickweave.sources.files import stream_files
from clickweave.streaming.capped import session_starts, stream_capped_sessions, stream_session_events
from clickweave.streaming.windows import stream_tumbling_sessions, stream_windowed_sessions

pytestmark = pytest.mark.usefixtures("few_partitions")

DRAIN = {"availableNow": True}
SCHEMA = "uuid string, event_time_ms bigint, event_id bigint"
# An event far in the future moves the watermark past everything else.
SENTINEL = ("sentinel", 10**10, -1)


def with_time(df):
    return df.withColumn("event_time", F.timestamp_millis("event_time_ms"))


class Feed:
    """A folder that receives batches of events and a stream that is run once per batch."""

    def __init__(self, spark, tmp_path, build):
        self.spark, self.build = spark, build
        self.source, self.target, self.checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))

    def send(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(2).write.mode("append").parquet(self.source)
        stream = self.build(with_time(stream_files(self.spark, self.source, SCHEMA)))
        write_stream(stream, self.checkpoint, path=self.target, trigger=DRAIN, stateful=True).awaitTermination()

    def rows(self):
        return self.spark.read.parquet(self.target).collect()


def expected_sessions(rows):
    found = brute_sessions(rows, 2 * MINUTE, 9 * MINUTE, "greedy")
    counts = {}
    for user, _, event in rows:
        _, start, end = found[event]
        counts[user, start, end] = counts.get((user, start, end), 0) + 1
    return counts


def capped(stream, delay="30 seconds"):
    return stream_capped_sessions(stream, inactivity_minutes=2, max_minutes=9, delay=delay)


@pytest.mark.parametrize("batches", [1, 3])
def test_closed_sessions_equal_batch_greedy(spark, tmp_path, batches):
    rows = sorted(skewed_events(7, events=400, span=2000), key=lambda r: r[1])
    feed = Feed(spark, tmp_path, capped)
    size = -(-len(rows) // batches)
    for at in range(0, len(rows), size):
        feed.send(rows[at : at + size])
    feed.send([SENTINEL])
    found = {
        (r.uuid, r.session_start_time_ms, r.session_end_time_ms): r.event_count for r in feed.rows()
    }
    assert found == expected_sessions(rows)
    assert len({r.session_id for r in feed.rows()}) == len(found)


def test_late_events(spark, tmp_path):
    """One event inside the delay joins its session, one beyond it is dropped."""
    feed = Feed(spark, tmp_path, capped)
    feed.send([("u", 10**6, 1), ("u", 10**6 + 100_000, 2)])
    feed.send([("u", 10**6 + 80_000, 3), ("u", 10**6 + 50_000, 4)])
    feed.send([SENTINEL])
    rows = [r for r in feed.rows() if r.uuid == "u"]
    assert [(r.session_start_time_ms, r.session_end_time_ms, r.event_count) for r in rows] == [
        (10**6, 10**6 + 100_000, 3)
    ]


def test_session_returns_after_state_is_gone(spark, tmp_path):
    feed = Feed(spark, tmp_path, capped)
    feed.send([("u", 5000, 1)])
    feed.send([("other", 10**7, 2)])
    feed.send([("u", 2 * 10**7, 3)])
    feed.send([SENTINEL])
    ids = sorted(r.session_id for r in feed.rows())
    assert ids == ["other_session_10000000", "u_session_20000000", "u_session_5000"]


def test_session_events(spark, tmp_path):
    rows = sorted(skewed_events(8, events=300, span=1500), key=lambda r: r[1])
    feed = Feed(
        spark,
        tmp_path,
        lambda s: stream_session_events(s, inactivity_minutes=2, max_minutes=9, delay="30 seconds"),
    )
    feed.send(rows[:150])
    feed.send(rows[150:])
    feed.send([SENTINEL])
    expected = brute_sessions(rows, 2 * MINUTE, 9 * MINUTE, "greedy")
    found = feed.rows()
    assert {(r.event_id, r.session_start_time_ms) for r in found} == {
        (event, start) for event, (_, start, _) in expected.items()
    }
    assert len(found) == len(rows)
    assert all(r.session_end_time_ms == r.event_time_ms for r in found)
    assert all(r.event_time.timestamp() * 1000 == r.event_time_ms for r in found)


def test_windowed_and_tumbling_streams(spark, tmp_path):
    rows = sorted(skewed_events(9, events=200, span=1500), key=lambda r: r[1])
    feed = Feed(
        spark, tmp_path / "w", lambda s: stream_windowed_sessions(s, inactivity_minutes=2, delay="30 seconds")
    )
    feed.send(rows[:90])
    feed.send(rows[90:])
    feed.send([SENTINEL])
    expected = brute_sessions(rows, 2 * MINUTE, 10**15, "truncate")
    assert {(r.session_start_time_ms, r.session_end_time_ms) for r in feed.rows()} == {
        (start, end) for _, start, end in expected.values()
    }
    tumbling = Feed(spark, tmp_path / "t", stream_tumbling_sessions)
    tumbling.send(rows)
    assert all(
        r.session_start_time_ms <= r.event_time_ms < r.session_end_time_ms for r in tumbling.rows()
    )
    assert len(tumbling.rows()) == len(rows)


def test_session_job_writes_a_partitioned_table(spark, tmp_path):
    from pyspark.sql.types import StructType

    from clickweave.sources.envelope import to_envelope

    events = spark.createDataFrame(
        [("e1", "home", "1704103200000", "u1"), ("e2", "search", "1704103260000", "u1"), ("e3", "x", "1904103260000", "u2"), ("e5", "x", "99704103260000", "u2"),
         ("e4", "x", None, "u1")],
        "event_id string, page_name string, event_timestamp string, uuid string",
    )
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    sent = F.timestamp_millis(F.col("event_timestamp").cast("bigint"))
    messages = to_envelope(events, time=sent)
    messages.write.parquet(source)
    stream = stream_files(spark, source, StructType.fromJson(messages.schema.jsonValue()))
    jobs.sessions_stream(
        stream, checkpoint=str(tmp_path / "ckpt"), path=target, trigger=DRAIN
    ).awaitTermination()
    # A last message at the end of time closes the stream; its own event stays open.
    end = spark.createDataFrame([("end", "", "253399622400000", "end")], events.schema)
    to_envelope(end, time=sent).write.mode("append").parquet(source)
    jobs.sessions_stream(
        stream, checkpoint=str(tmp_path / "ckpt"), path=target, trigger=DRAIN
    ).awaitTermination()
    rows = spark.read.parquet(target).orderBy("event_id").collect()
    assert [(r.event_id, r.session_id) for r in rows] == [
        ("e1", "u1_session_1704103200000"),
        ("e2", "u1_session_1704103200000"),
        ("e3", "u2_session_1904103260000"),
        ("e5", "u2_session_99704103260000"),
    ]
    assert str(rows[0].session_date) == "2024-01-01"
    batch = []
    jobs.sessions_batch(messages, batch.append, policy="greedy")
    assert {r.session_id for r in batch[0].collect()} == {
        "u1_session_1",
        "u2_session_1",
        "u2_session_2",
    }
    assert {r.event_id for r in rows} == {r.event_id for r in batch[0].collect()}
    assert set(rows[0].asDict()) >= set(add_layout_columns(batch[0]).columns)
    rejected = jobs.clickstream_rejects(messages).collect()
    assert [r.reason for r in rejected] == ["no readable time"]


@pytest.mark.parametrize("start, last", [(None, None), (0, 95)])
def test_session_starts(start, last):
    moments = np.array([100, 105, 111, 131, 132, 152, 153])
    found = session_starts(moments, start, last, gap_ms=20, cap_ms=20)
    expected = [100, 100, 100, 131, 131, 152, 152]
    if start is not None:
        # The open session began too long ago, so the first moment starts another one.
        expected = [100, 100, 100, 131, 131, 152, 152]
    assert found.tolist() == expected


ARRIVING = "uuid string, event_time_ms bigint, event_id bigint, arrived bigint, tags map<int, string>"


class ArrivingFeed(Feed):
    """Events with an arrival of their own and a column that JSON cannot bring back."""

    def send(self, rows):
        rows = [(*r, {r[2] % 3: str(r[2])}) for r in rows]
        self.spark.createDataFrame(rows, ARRIVING).coalesce(2).write.mode("append").parquet(self.source)
        stream = self.build(stream_files(self.spark, self.source, ARRIVING).withColumn("arrived", F.timestamp_millis("arrived")))
        query = write_stream(stream, self.checkpoint, path=self.target, trigger=DRAIN, stateful=True)
        query.awaitTermination()
        return query


def test_one_wrong_clock_loses_nothing(spark, tmp_path):
    """Events of a day, then one from the end of time, then events of the next day: all but the one come out, and it is a reject."""
    start, day, end = 10**12, 86_400_000, 253_400_000_000_000
    first = [(f"u{i % 3}", start + i * 60_000, i, start + i * 60_000) for i in range(60)]
    second = [(f"u{i % 3}", start + day + i * 60_000, 100 + i, start + day + i * 60_000 + 9 * MINUTE) for i in range(60)]
    wrong = [("other", end, 500, start + 3_600_000)]
    late = [("u0", start, 600, start + day)]
    rules = ClockRules(most_late=timedelta(minutes=10))
    feed = ArrivingFeed(
        spark,
        tmp_path,
        lambda s: stream_session_events(s, inactivity_minutes=30, max_minutes=120, clock=rules, arrival="arrived"),
    )
    feed.send(first + wrong)
    feed.send(second + late)
    feed.send([("end", start + 9 * day, -1, start + 9 * day)])
    rows = feed.rows()
    assert Counter(r.event_id for r in rows) == Counter(r[2] for r in first + second)
    assert all(r.tags == {r.event_id % 3: str(r.event_id)} for r in rows)
    everything = spark.read.parquet(feed.source).withColumn("arrived", F.timestamp_millis("arrived"))
    rejects = clock_rejects(everything, rules, arrival="arrived").collect()
    assert {(r.event_id, r.reason) for r in rejects} == {(500, "clock ahead"), (600, "late")}
    # Rows out and rejects are the rows in, but for the event that closes the stream.
    assert len(rows) + len(rejects) + 1 == everything.count()


def test_clocks_are_held_against_the_time_of_the_batch(spark, tmp_path):
    """Without an arrival; the future ends no stream."""
    feed = Feed(spark, tmp_path, capped)
    feed.send([("u", 5000, 1), ("x", 253_400_000_000_000, 2)])
    feed.send([("u", 100_000, 3)])
    feed.send([SENTINEL])
    assert {(r.uuid, r.event_count) for r in feed.rows()} == {("u", 2)}


def test_join_state_is_let_go(spark, tmp_path):
    """Neither side of the join keeps rows of seconds that the watermark has passed."""
    feed = ArrivingFeed(
        spark, tmp_path, lambda s: stream_session_events(s, delay="10 seconds", clock=None)
    )
    feed.send([(f"u{i % 5}", i * 1000, i, 0) for i in range(200)])
    query = feed.send([("end", 10**9, -1, 0)])
    assert len(feed.rows()) == 200
    held = {op["operatorName"]: op["numRowsTotal"] for op in query.lastProgress["stateOperators"]}
    assert held["symmetricHashJoin"] <= 1


def test_clock_rules():
    rules = ClockRules(timedelta(minutes=1), timedelta(minutes=2), timedelta(seconds=3))
    assert rules.watermark_delay == "183000 milliseconds"
    with pytest.raises(ValueError):
        ClockRules(most_late=timedelta(seconds=-1))


def test_jobs_agree_on_clocks(spark):
    """Between them events and rejects have every message once, on bounded tables too."""
    from clickweave.sources.envelope import to_envelope

    rows = [(str(i), "p", str(10**12 + i * 60_000), "u", 10**12 + i * 60_000 + lag * 60_000) for i, lag in enumerate([0, -4, -6, 9, 11, 600])]
    events = spark.createDataFrame(rows, "event_id string, page_name string, event_timestamp string, uuid string, arrived bigint")
    messages = to_envelope(events.drop("arrived"), time=F.timestamp_millis(F.lit(0))).drop("timestamp")
    assert {r.event_id for r in jobs.clickstream_events(messages).collect()} == set("012345")
    arrived = events.select(F.timestamp_millis("arrived").alias("timestamp"), F.to_json(F.struct("event_id", "event_timestamp", "uuid")).alias("value"))
    for clock, ahead, late in ((jobs.STREAM_CLOCK, {"2"}, {"4", "5"}), (jobs.BATCH_CLOCK, {"2"}, set()), (None, set(), set())):
        rejects = {(r.value.split('"')[3], r.reason) for r in jobs.clickstream_rejects(arrived, clock).collect()}
        assert rejects == {(e, "clock ahead") for e in ahead} | {(e, "late") for e in late}
        assert {r.event_id for r in jobs.clickstream_events(arrived, clock).collect()} == set("012345") - ahead - late
