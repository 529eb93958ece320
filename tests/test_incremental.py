"""Sessions taken in slice by slice against detection over the whole, and a stream that goes on from a slice."""

import random

import pytest
from brute import sessions as brute_sessions
from pyspark.sql import functions as F
from test_sessions import MINUTE, skewed_events
from test_streaming import SENTINEL, Feed

from clickweave.operators.busy_users import BusyUsers
from clickweave.operators.incremental import SessionTable
from clickweave.streaming.capped import stream_capped_sessions, stream_session_events

pytestmark = pytest.mark.usefixtures("few_partitions")

SCHEMA = "uuid string, event_time_ms bigint, event_id bigint"
LIMITS = {"inactivity_minutes": 2, "max_minutes": 9}


def expected(rows):
    return {event: found for event, found in brute_sessions(rows, 2 * MINUTE, 9 * MINUTE, "greedy").items()}


def found_in(table):
    return {
        r.event_id: (r.session_id, r.session_start_time_ms, r.session_end_time_ms)
        for r in table.rows().collect()
    }


@pytest.mark.parametrize("busy", [None, BusyUsers(rows=40, slice_minutes=3)])
@pytest.mark.parametrize("slices", [2, 7])
def test_slices_equal_the_whole(spark, tmp_path, slices, busy):
    rows = skewed_events(slices, events=400, span=2400)
    events = spark.createDataFrame(rows, SCHEMA).repartition(3)
    table = SessionTable(spark, str(tmp_path / "t"), busy=busy, **LIMITS)
    low, high = min(r[1] for r in rows), max(r[1] for r in rows)
    ends = [low + (high + 1 - low) * (k + 1) // slices for k in range(slices)]
    for end in ends:
        late = table.add(events, end)
        so_far = [r for r in rows if r[1] < end]
        # Everything is as if the slices had been one table, open sessions as they stand.
        assert found_in(table) == expected(so_far)
        # Slices that are done come back, as they were handed in again.
        before = [e for e in ends if e < end][-1:]
        assert late.count() == sum(r[1] < before[0] for r in rows) if before else late.count() == 0
    assert table.slices() == ends


def test_runs_can_be_repeated(spark, tmp_path):
    rows = skewed_events(3, events=200, span=1200)
    events = spark.createDataFrame(rows, SCHEMA)
    middle, end = sorted(r[1] for r in rows)[100], max(r[1] for r in rows) + 1
    table = SessionTable(spark, str(tmp_path / "t"), busy=None, **LIMITS)
    for until in (middle, middle, end):
        table.add(events, until)
    # A run that broke off has written rows, but no counts: it counts for nothing.
    counts = table._path(f"{table.root}/finished/slice={end}/_SUCCESS")
    counts.getFileSystem(spark._jsc.hadoopConfiguration()).delete(counts, False)
    assert table.slices() == [middle]
    assert found_in(table) == expected([r for r in rows if r[1] < middle])
    table.add(events, end)
    assert found_in(table) == expected(rows)
    with pytest.raises(ValueError):
        table.add(events, middle)


def test_a_run_reads_open_sessions_and_new_events_only(spark, tmp_path):
    rows = skewed_events(5, events=300, span=2000)
    table = SessionTable(spark, str(tmp_path / "t"), busy=None, **LIMITS)
    ends = [500_000 * (k + 1) + rows[0][1] for k in range(3)]
    for end in ends:
        spark.createDataFrame([r for r in rows if r[1] < end], SCHEMA).write.parquet(str(tmp_path / f"in{end}"))
        table.add(spark.read.parquet(str(tmp_path / f"in{end}")), end)
    read = table._open_rows(ends[-1]).inputFiles()
    assert all(f"slice={ends[-1]}/open=true" in path for path in read)
    open_users = [r.uuid for r in table.open_sessions().collect()]
    assert len(open_users) == len(set(open_users))
    # What is carried lasts no longer than the cap and the gap before the end.
    assert all(r.event_time_ms >= ends[-1] - 11 * MINUTE for r in table._open_rows(ends[-1]).collect())


def test_empty_slices_and_unusable_events(spark, tmp_path):
    events = spark.createDataFrame([("u", 10 * MINUTE, 1), (None, 10 * MINUTE, 2), ("u", None, 3), ("u", 50 * MINUTE, 4)], SCHEMA)
    table = SessionTable(spark, str(tmp_path / "t"), busy=None, **LIMITS)
    with pytest.raises(ValueError):
        table.rows()
    for minutes in (5, 8, 11, 20, 60):
        assert table.add(events, minutes * MINUTE).count() == (1 if minutes in (20, 60) else 0)
        opened = table.open_sessions().collect()
        assert [tuple(r) for r in opened] == ([("u", 10 * MINUTE, 10 * MINUTE, 1)] if minutes == 11 else [])
    assert {k: v[0] for k, v in found_in(table).items()} == {1: "u_session_1", 4: "u_session_2"}


@pytest.mark.parametrize("whole", [True, False])
def test_stream_goes_on_from_a_slice(spark, tmp_path, whole):
    """First half as a bounded table, second half as a stream: closed sessions, or event rows."""
    rows = sorted(skewed_events(11, events=300, span=1800), key=lambda r: r[1])
    middle = rows[150][1]
    table = SessionTable(spark, str(tmp_path / "t"), busy=None, **LIMITS)
    table.add(spark.createDataFrame(rows, SCHEMA), middle)
    opened = table.open_sessions()
    assert opened.count() > 0
    build = stream_capped_sessions if whole else stream_session_events
    feed = Feed(spark, tmp_path, lambda s: build(s, delay="30 seconds", initial=opened, **LIMITS))
    later = [r for r in rows if r[1] >= middle]
    feed.send(later[:70])
    feed.send(later[70:])
    feed.send([SENTINEL])
    everything = expected(rows)
    if whole:
        closed = table.rows().join(opened.select("uuid", "session_start_time_ms"), ["uuid", "session_start_time_ms"], "left_anti")
        before = closed.groupBy("uuid", "session_start_time_ms", "session_end_time_ms").agg(F.count(F.lit(1)).alias("event_count"))
        found = [(r.uuid, r.session_start_time_ms, r.session_end_time_ms, r.event_count) for r in [*before.collect(), *feed.rows()]]
        counts = {}
        for user, _, event in rows:
            key = (user, *everything[event][1:])
            counts[key] = counts.get(key, 0) + 1
        assert sorted(found) == sorted((*key, n) for key, n in counts.items())
    else:
        starts = {r.event_id: r.session_start_time_ms for r in feed.rows()}
        assert starts == {r[2]: everything[r[2]][1] for r in later}


def test_order_of_rows_does_not_matter(spark, tmp_path):
    rows = skewed_events(13, events=200, span=1200)
    random.Random(1).shuffle(rows)
    table = SessionTable(spark, str(tmp_path / "t"), busy=None, **LIMITS)
    table.add(spark.createDataFrame(rows, SCHEMA), rows[0][1])
    table.add(spark.createDataFrame(rows, SCHEMA), max(r[1] for r in rows) + 1)
    assert found_in(table) == expected(rows)
