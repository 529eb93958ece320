"""Files of session streams: as many as the rows of a partition need, and few tasks to read them."""

from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from brute import sessions as brute_sessions
from pyspark.sql import functions as F
from test_sessions import MINUTE
from test_stream_scale import Handle

from clickweave.functions.layout import USER_BUCKETS
from clickweave.plans import stream_queries
from clickweave.plans.session_queries import LIMITS
from clickweave.sinks import streams
from clickweave.sinks.streams import clustered
from clickweave.streaming.capped import BUCKETS, DAY_MS, MomentStarts, partition_rows


def test_small_partitions_are_one_file(spark, monkeypatch):
    """All partitions were dealt to four tasks each, however few rows they had."""
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 1000)
    about = F.when(F.col("kind") == "hot", 1_000_000).when(F.col("kind") == "warm", 1500).otherwise(1000)
    kind = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 4 == 1, "warm").otherwise("cold")
    rows = spark.range(2000).withColumn("kind", kind).withColumn("about", about)
    dealt = clustered(rows.repartition(16), ["kind"], 4, "about")
    assert dealt.columns == ["id", "kind"] and {r.id for r in dealt.collect()} == set(range(2000))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        tasks = dealt.select("kind", F.spark_partition_id().alias("task")).distinct().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    found = Counter(r.kind for r in tasks)
    assert found["cold"] == 1 and found["warm"] <= 2 and 2 < found["hot"] <= 4


def test_partition_rows():
    """A user's own events of the day, and a bucket's share of those of the others."""
    codes = np.array([0, 0, 0, 1, 1, 2])
    starts = np.array([5, 5, DAY_MS, 7, DAY_MS + 1, DAY_MS - 1])
    counts = np.array([1, 2, 50, 4, 900_000, 8])
    per = BUCKETS / USER_BUCKETS
    first, second = {0: 3, 1: 4, 2: 8}, {0: 50, 1: 900_000}
    expected = [int(own[c] + (sum(own.values()) - own[c]) * per) for c, own in zip(codes, (first, first, second, first, second, first))]
    assert partition_rows(codes, starts, counts).tolist() == expected


def test_starts_say_how_many_rows_their_partition_has():
    handle = Handle()
    runs = MomentStarts("uuid", "string", 60_000, 300_000)
    runs.init(handle)
    rows = [("busy", m, 1000, False) for m in range(300)] + [("other", DAY_MS + 5, 1, False)]
    frame = pd.DataFrame(rows, columns=["uuid", "moment", "events", "cut"]).sample(frac=1, random_state=2)
    found = pd.concat(runs.handleInputRows((1,), iter([frame]), handle))
    assert set(zip(found["uuid"], found["_rows"])) == {("busy", 300_000), ("other", 1)}


@pytest.mark.usefixtures("few_partitions")
@pytest.mark.parametrize("per_file", [100_000, 5])
def test_guarded_sessions_of_one_partition(spark, tmp_path, monkeypatch, per_file):
    """One user's events of a day were four files a batch; they are one, and several as before where there are many."""
    monkeypatch.setattr(streams, "ROWS_PER_FILE", per_file)
    begin = datetime(2024, 1, 1)
    rows = [(i, begin + timedelta(minutes=i + 25 * (i // 60)), 1, "click", 1.0, '{"k": 1}') for i in range(500)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(stream_queries, "scratch", lambda spark, label: f"{tmp_path}/{label}")
    frame = stream_queries.stream_guarded_sessions(spark, str(tmp_path))
    kept = [(str(u), round((at - datetime(1970, 1, 1)).total_seconds() * 1000), i) for i, at, u, *_ in rows if i % 13 != 5]
    limits = (LIMITS["inactivity_minutes"] * MINUTE, LIMITS["max_minutes"] * MINUTE)
    expected = {(str(i), s[1]) for i, s in brute_sessions(kept, *limits, "greedy").items()}
    found = [(r.event_id, r.session_start_time_ms) for r in frame.collect()]
    assert set(found) == expected and len(found) == len(kept)
    # The thirds come out in as many batches, and what is open then in one more.
    files = list((tmp_path / "guarded-out").rglob("*.parquet"))
    assert len({p.parent for p in files}) == 1
    assert len(files) <= 4 if per_file == 100_000 else 4 < len(files) <= 8
    assert frame.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
