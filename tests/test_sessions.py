import random

import pytest
from brute import sessions as brute_sessions
from pyspark.sql import functions as F

from clickweave.operators.busy_users import BusyUsers, list_busy, measure_busy
from clickweave.operators.sessions import (
    SessionRules,
    count_unusable,
    detect_sessions,
    rollup_sessions,
    session_gaps,
    session_islands,
    session_paths,
    tumbling_sessions,
    windowed_sessions,
)

MINUTE = 60_000
BASE = 1704103200000  # 2024-01-01 10:00 UTC
SCHEMA = "uuid string, event_time_ms bigint, event_id bigint, page_name string"

GOLDEN = {
    "user-001": ([0, 5, 10, 45, 50, 55], "home selection review home booking thankyou"),
    "user-002": ([0, 30, 60, 90, 120, 150, 180], "home selection review search profile booking payment"),
    "user-003": ([0, 60, 110, 150, 270, 290], "home search selection home review booking"),
}
SHARED = {
    "user-001_session_1": (0, 10, 3),
    "user-001_session_2": (45, 55, 3),
    "user-003_session_1": (0, 0, 1),
    "user-003_session_2": (60, 60, 1),
    "user-003_session_3": (110, 110, 1),
    "user-003_session_4": (150, 150, 1),
    "user-003_session_5": (270, 290, 2),
}
EXPECTED = {
    "bin": {f"{k}_0": v for k, v in SHARED.items()}
    | {"user-002_session_1_0": (0, 90, 4), "user-002_session_1_1": (120, 180, 3)},
    "greedy": SHARED | {"user-002_session_1": (0, 120, 5), "user-002_session_2": (150, 180, 2)},
    "truncate": SHARED | {"user-002_session_1": (0, 120, 7)},
}
SLICED = BusyUsers(rows=0, slice_minutes=7)


def make(spark, rows):
    return spark.createDataFrame([(*row, "p") if len(row) == 3 else row for row in rows], SCHEMA)


def golden(spark):
    rows = []
    for user, (minutes, pages) in GOLDEN.items():
        for minute, page in zip(minutes, pages.split()):
            rows.append((user, BASE + minute * MINUTE, len(rows), page))
    return make(spark, rows)


@pytest.mark.parametrize("busy", [None, SLICED], ids=["window", "sliced"])
@pytest.mark.parametrize("policy", ["bin", "greedy", "truncate"])
def test_golden(spark, policy, busy):
    rows = detect_sessions(golden(spark), policy=policy, busy=busy)
    rolled = rollup_sessions(rows, cap_minutes=120 if policy == "truncate" else None).collect()
    found = {
        r.session_id: (
            (r.session_start_time_ms - BASE) // MINUTE,
            (r.session_end_time_ms - BASE) // MINUTE,
            r.event_count,
        )
        for r in rolled
    }
    assert found == EXPECTED[policy]
    assert all(
        r.session_duration_seconds == (r.session_end_time_ms - r.session_start_time_ms) / 1000 for r in rolled
    )


def found_sessions(frame):
    return {
        r.event_id: (r.session_id, r.session_start_time_ms, r.session_end_time_ms)
        for r in frame.collect()
    }


def skewed_events(seed, users=12, events=900, share=0.4, span=6000):
    """Random events with ties; one user holds a large share and stays active for long runs."""
    chance = random.Random(seed)
    rows = []
    for event_id in range(events):
        if chance.random() < share:
            user, at = "bot", chance.randrange(span)
        else:
            user, at = f"u{chance.randrange(users)}", chance.randrange(span * 5)
        rows.append((user, at * 1000, event_id))
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("policy", ["bin", "greedy", "truncate"])
@pytest.mark.parametrize(
    "busy",
    [None, BusyUsers(rows=100, slice_minutes=3), BusyUsers(rows=0, slice_minutes=1)],
    ids=["window", "bot sliced", "all sliced"],
)
def test_matches_brute_force(spark, policy, busy, seed):
    rows = skewed_events(seed)
    frame = detect_sessions(
        make(spark, rows), inactivity_minutes=2, max_minutes=9, policy=policy, busy=busy
    )
    assert found_sessions(frame) == brute_sessions(rows, 2 * MINUTE, 9 * MINUTE, policy)


@pytest.mark.parametrize("busy", [None, BusyUsers(rows=0, slice_minutes=2)], ids=["window", "sliced"])
def test_custom_boundary(spark, busy):
    rows = skewed_events(3, events=500)
    cuts = frozenset(r[2] for r in rows if r[2] % 9 == 0)
    frame = detect_sessions(
        make(spark, rows),
        inactivity_minutes=2,
        max_minutes=9,
        policy="greedy",
        boundary=F.col("event_id") % 9 == 0,
        busy=busy,
    )
    assert found_sessions(frame) == brute_sessions(rows, 2 * MINUTE, 9 * MINUTE, "greedy", cuts)


@pytest.mark.parametrize("busy", [None, SLICED], ids=["window", "sliced"])
@pytest.mark.parametrize(
    "offset, count",
    [(30 * MINUTE - 1, 1), (30 * MINUTE, 1), (30 * MINUTE + 1, 2)],
)
def test_gap_limit(spark, busy, offset, count):
    frame = make(spark, [("u", BASE, 1), ("u", BASE + offset, 2)])
    assert rollup_sessions(detect_sessions(frame, busy=busy)).count() == count


@pytest.mark.parametrize("busy", [None, SLICED], ids=["window", "sliced"])
@pytest.mark.parametrize("policy, extra, count", [
    ("bin", -1, 1), ("bin", 0, 2), ("bin", 1, 2),
    ("greedy", -1, 1), ("greedy", 0, 1), ("greedy", 1, 2),
    ("truncate", 1, 1),
])
def test_cap_limit(spark, busy, policy, extra, count):
    times = [i * 25 * MINUTE for i in range(5)] + [120 * MINUTE + extra]
    frame = make(spark, [("u", BASE + t, i) for i, t in enumerate(times)])
    rows = detect_sessions(frame, policy=policy, busy=busy)
    assert rows.select("session_id").distinct().count() == count
    if policy == "truncate":
        assert {r.session_end_time_ms for r in rows.collect()} == {BASE + 120 * MINUTE}


def test_rows_without_user_or_time(spark):
    frame = make(spark, [("u", 5, 1), (None, 5, 2), ("u", None, 3)])
    assert [r.event_id for r in detect_sessions(frame).collect()] == [1]
    report = count_unusable(frame).first()
    assert (report.null_user, report.null_time, report.total) == (1, 1, 3)


def test_result_does_not_depend_on_order(spark):
    rows = skewed_events(4, events=300)
    one = detect_sessions(make(spark, rows), policy="greedy").collect()
    other = detect_sessions(make(spark, rows[::-1]).repartition(5), policy="greedy").collect()
    assert sorted(map(str, one)) == sorted(map(str, other))


@pytest.mark.parametrize(
    "settings",
    [{"inactivity_minutes": 0}, {"max_minutes": -1}, {"inactivity_minutes": 120}, {"policy": "other"}],
)
def test_bad_limits(settings):
    with pytest.raises(ValueError):
        SessionRules(**settings)


@pytest.mark.parametrize("busy", [None, BusyUsers(rows=50, slice_minutes=2)], ids=["window", "sliced"])
def test_islands_windows_and_gaps(spark, busy):
    rows = skewed_events(5, events=400)
    frame = make(spark, rows)
    expected = brute_sessions(rows, 2 * MINUTE, 10**15, "truncate")
    islands = session_islands(frame, inactivity_minutes=2, busy=busy).collect()
    assert {(r.event_id, f"{r.uuid}_session_{r.island}", r.island_start_ms) for r in islands} == {
        (event, session, start) for event, (session, start, _) in expected.items()
    }
    windows = windowed_sessions(frame, inactivity_minutes=2, busy=busy).collect()
    assert sorted((r.session_start_time_ms, r.session_end_time_ms, r.uuid) for r in windows) == sorted(
        {(start, end, session.split("_")[0]) for session, start, end in expected.values()}
    )
    previous, gaps = {}, {}
    for user, ms, event in sorted(rows, key=lambda r: (r[1], r[2])):
        gaps[event] = ms - previous[user] if user in previous else None
        previous[user] = ms
    assert {r.event_id: r.gap_ms for r in session_gaps(frame, busy=busy).collect()} == gaps


@pytest.mark.parametrize("busy", [None, BusyUsers(rows=50, slice_minutes=2)], ids=["window", "sliced"])
def test_paths_keep_every_page_in_order(spark, busy):
    rows = [(u, ms, e, f"page{e}") for u, ms, e in skewed_events(6, events=400)]
    found = detect_sessions(make(spark, rows), inactivity_minutes=2, max_minutes=9)
    parts = session_paths(found, part_events=4, busy=busy).collect()
    joined = {}
    for part in sorted(parts, key=lambda r: r.part):
        assert len(part.pages_visited) <= 4
        joined.setdefault(part.session_id, []).extend(part.pages_visited)
    sessions = brute_sessions([r[:3] for r in rows], 2 * MINUTE, 9 * MINUTE, "bin")
    expected = {}
    for _, _, event, page in sorted(rows, key=lambda r: (r[1], r[2])):
        expected.setdefault(sessions[event][0], []).append(page)
    assert joined == expected


def test_tumbling_keeps_all_columns(spark):
    frame = golden(spark).withColumn("event_time", F.timestamp_millis("event_time_ms"))
    row = tumbling_sessions(frame).filter("event_id = 1").first()
    assert row.page_name == "selection"
    assert row.session_id == f"user-001_session_{BASE + 5 * MINUTE}"
    assert row.session_duration_seconds == 300


def test_busy_list(spark):
    frame = make(spark, [("a", i, i) for i in range(5)] + [("b", i, 9 + i) for i in range(3)] + [("c", 1, 20)])
    listed = list_busy(frame, "uuid", BusyUsers(rows=2))
    assert {r.uuid for r in listed.collect()} == {"a", "b"}
    assert [r.uuid for r in list_busy(frame, "uuid", BusyUsers(rows=2, limit=1)).collect()] == ["a"]
    assert list_busy(frame, "uuid", BusyUsers(rows=9)) is None
    measured = measure_busy(frame, busy=BusyUsers(rows=2, slice_minutes=5))
    assert sorted(measured.known) == ["a", "b"] and measured.slice_minutes == 5
    with_list = detect_sessions(frame, busy=measured)
    assert sorted(map(str, with_list.collect())) == sorted(map(str, detect_sessions(frame, busy=None).collect()))


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_one_exchange_for_ordinary_users(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("user_id").cast("string").alias("uuid"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("event_time_ms"),
        "event_id",
    )
    plan = plan_of(rollup_sessions(detect_sessions(events, busy=None)))
    assert plan.count("Exchange ") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan
    assert plan_of(detect_sessions(events, busy=None)).count("Exchange ") == 1


@pytest.mark.parametrize("busy", [None, BusyUsers(rows=0, slice_minutes=1)])
def test_gaps_of_repeated_and_null_ids(spark, busy):
    rows = [("u", 1000, 1), ("u", 5000, 2), ("u", 5000, 2), ("u", 5000, None), ("u", 9000, 3), (None, 10, 4)]
    frame = spark.createDataFrame(rows, "uuid string, event_time_ms bigint, event_id bigint")
    found = [(r.event_time_ms, r.gap_ms) for r in session_gaps(frame, busy=busy).collect()]
    assert sorted(found, key=str) == sorted([(1000, None), (5000, 4000), (5000, 0), (5000, 0), (9000, 4000)], key=str)


@pytest.mark.parametrize("minutes", [2.01, 2.03, 2.05, 4.02])
def test_limits_are_whole_milliseconds(minutes):
    assert SessionRules(minutes, 10).gap_ms == round(minutes * 60_000)


@pytest.mark.parametrize("busy", [None, BusyUsers(rows=0, slice_minutes=1)])
def test_windows_leave_out_events_without_user(spark, busy):
    rows = [("u", 1000, 1), (None, 1000, 2), ("u", None, 3)]
    frame = spark.createDataFrame(rows, "uuid string, event_time_ms bigint, event_id bigint")
    found = windowed_sessions(frame.withColumn("event_time", F.timestamp_millis("event_time_ms")), busy=busy).collect()
    assert [(r.uuid, r.event_count) for r in found] == [("u", 1)]
