"""Busy users found through a summary of counters."""

import random
from collections import Counter

import pytest

from clickweave.operators.busy_users import BusyUsers, busy_counts, measure_busy


@pytest.fixture(scope="module")
def events(spark):
    own = random.Random(8)
    users = [f"u{i}" for i in range(300) for _ in range(own.choice([1, 1, 2, 5, 30, 31, 200]))] + [None] * 40
    own.shuffle(users)
    return users, spark.createDataFrame([(u, 1) for u in users], "uuid string, n int").repartition(5).cache()


@pytest.mark.parametrize("summary", [0, 1, 2, 7, 64, 1000, 1 << 20])
@pytest.mark.parametrize("rows", [0, 4, 30, 199, 10_000])
def test_every_user_over_the_limit_is_found(events, summary, rows):
    """However many users share a counter, and with exact counts."""
    users, frame = events
    found = {r.uuid: r["rows"] for r in busy_counts(frame, busy=BusyUsers(rows=rows, summary=summary)).collect()}
    expected = {u: n for u, n in Counter(users).items() if n > rows}
    assert found == expected


def test_largest_are_listed_first(events):
    users, frame = events
    busy = measure_busy(frame.dropna(), busy=BusyUsers(rows=3, limit=5, summary=16))
    most = sorted((n for u, n in Counter(users).items() if u), reverse=True)[:5]
    assert [Counter(users)[u] for u in busy.known] == most


def test_an_empty_table_has_none(events):
    assert measure_busy(events[1].limit(0)).known == ()
