"""Sketches of partitions, undeclared JSON, quality of streams, and tables that need no shuffle."""

from collections import Counter

import pytest
from brute import sessions as brute_sessions
from pyspark.sql import functions as F
from test_sessions import MINUTE, skewed_events

from clickweave.functions.json_columns import found_schema, parse_variant, variant_fields
from clickweave.operators import quality
from clickweave.operators.sessions import detect_sessions
from clickweave.operators.sketches import distinct_users, duration_quantile, merge_sketches, session_sketches
from clickweave.sinks.streams import batch_writer, write_stream
from clickweave.sinks.tables import write_bucketed
from clickweave.sources.files import stream_files


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sessions(spark):
    """300,000 sessions of 60,000 users on ten dates; one bucket holds a third of them."""
    n = spark.range(300_000)
    user = F.pmod(F.xxhash64("id"), F.lit(60_000))
    return n.select(
        user.cast("string").alias("uuid"),
        F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 10 + 1).cast("string"), 2, "0")).alias("session_date"),
        F.when(user % 3 == 0, 7).otherwise((user % 100).cast("int")).alias("user_hash_bucket"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(7_200_000)) / 1000.0).alias("session_duration_seconds"),
        (F.col("id") % 5).alias("event_count"),
    )


def test_merged_sketches_are_within_their_errors(spark, sessions, tmp_path):
    path = str(tmp_path / "sketches")
    session_sketches(sessions).write.partitionBy("session_date").parquet(path)
    stored = spark.read.parquet(path).withColumn("session_date", F.col("session_date").cast("string"))
    shares = (0.1, 0.5, 0.9, 0.99)
    for first, last, buckets in ((None, None, None), ("2024-01-03", "2024-01-05", None), (None, "2024-01-02", [7, 8, 10])):
        rows = sessions
        rows = rows if first is None else rows.filter(F.col("session_date") >= first)
        rows = rows if last is None else rows.filter(F.col("session_date") <= last)
        rows = rows if buckets is None else rows.filter(F.col("user_hash_bucket").isin(buckets))
        exact = rows.agg(F.count("*").alias("n"), F.sum("event_count").alias("e"), F.count_distinct("uuid").alias("u")).first()
        merged = merge_sketches(stored, first=first, last=last, buckets=buckets)
        found = merged.select("sessions", "events", distinct_users().alias("u"), *[duration_quantile(s).alias(str(s)) for s in shares]).first()
        assert (found.sessions, found.events) == (exact.n, exact.e)
        # Four standard errors of a count, and the stated error of a rank, twice.
        assert abs(found.u / exact.u - 1) < 4 * 0.0082
        for share in shares:
            below = rows.filter(F.col("session_duration_seconds") <= found[str(share)]).count()
            assert abs(below / exact.n - share) < 0.011
        assert "FileScan" in plan_of(merged) and "Range" not in plan_of(merged)
    assert "session_date" in plan_of(merge_sketches(stored, first="2024-01-09")).split("PartitionFilters")[1][:200]


def test_sketches_of_little_and_nothing(spark, sessions):
    few = sessions.limit(40).withColumn("uuid", F.when(F.col("event_count") > 0, F.col("uuid")))
    merged = merge_sketches(session_sketches(few)).select(distinct_users().alias("u"), duration_quantile(0.5).alias("q")).first()
    assert merged.u == few.select("uuid").dropna().distinct().count()
    durations = sorted(r[0] for r in few.select("session_duration_seconds").collect())
    assert merged.q == durations[19]
    blank = session_sketches(few.withColumn("session_duration_seconds", F.lit(None).cast("double")))
    assert merge_sketches(blank).select(duration_quantile(0.5).alias("q")).first().q is None
    assert session_sketches(few.limit(0)).count() == 0


MESSAGES = ['{"a": 1, "b": {"c": [1, "x"]}}', '{"a": 2.5, "d": true}', '{"a": "text"}', "{broken", None, "", "[1]", '{"b": null}']


def test_variant_fields(spark):
    df = spark.createDataFrame([(i, m, "kept") for i, m in enumerate(MESSAGES)], "id int, value string, other string")
    fields = {"a": ("$.a", "double"), "first": ("$.b.c[0]", "int"), "second": ("$.b.c[1]", "string"), "d": ("$.d", "boolean")}
    read = variant_fields(parse_variant(df), fields)
    found = {r.id: (r.a, r["first"], r.second, r.d) for r in read.collect()}
    none = (None,) * 4
    assert found == {0: (1.0, 1, "x", None), 1: (2.5, None, None, True), 2: none, 3: none, 4: none, 5: none, 6: none, 7: none}
    # A filter on a field does not parse the text once more.
    optimised = read.filter("a > 1 AND d")._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.count("parseJson") for line in optimised.splitlines()) == 1, optimised
    assert read.columns == ["id", "value", "other", "variant", "a", "first", "second", "d"]


def test_found_schema(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    row = found_schema(df.filter("value LIKE '{%'")).first()
    assert (row.parsed, row.malformed) == (4, 1)
    assert "b: OBJECT<c: ARRAY<VARIANT>>" in row.schema and "a: VARIANT" in row.schema and "d: BOOLEAN" in row.schema
    assert found_schema(df.limit(0)).first().parsed == 0


ROWS = [(i, None if i % 10 == 0 else f"n{i % 3}", i % 50) for i in range(400)]
RULES = {"not_null": ["name"], "ranges": {"age": {"max": 44}}, "allowed": {"name": ["n0", "n1"]}}


def people(spark, low, high):
    return spark.createDataFrame(ROWS[low:high], "id int, name string, age int").repartition(3)


def report(df):
    return {(r.check_name, r.column_name): (r.violations, r.row_count) for r in df.collect()}


def test_stream_reports_add_up(spark, tmp_path):
    source = str(tmp_path / "in")
    for at in (0, 150, 300):
        people(spark, at, min(400, at + 150)).coalesce(1).write.mode("append").parquet(source)
    stream = stream_files(spark, source, "id int, name string, age int", max_files_per_trigger=1)
    write = batch_writer(str(tmp_path / "ledger"), path=str(tmp_path / "out"))
    checked = quality.checked_writer(write, str(tmp_path / "reports"), **RULES)

    def twice(batch, batch_id):
        checked(batch, batch_id)
        checked(batch, batch_id)

    write_stream(stream, str(tmp_path / "c"), trigger={"availableNow": True}, each_batch=twice).awaitTermination()
    whole = quality.quality_report(people(spark, 0, 400), min_rows=500, **RULES)
    assert report(quality.stream_report(spark, str(tmp_path / "reports"), min_rows=500)) == report(whole)
    assert Counter(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == Counter(range(400))
    assert len(list((tmp_path / "reports").iterdir())) == 3


def test_stop_rule(spark, tmp_path):
    write = batch_writer(str(tmp_path / "ledger"), path=str(tmp_path / "out"))
    checked = quality.checked_writer(write, str(tmp_path / "reports"), most_share=0.3, not_null=["name"])
    checked(people(spark, 0, 100), 0)
    bad = people(spark, 100, 200).withColumn("name", F.lit(None).cast("string"))
    for _ in range(2):
        with pytest.raises(quality.QualityError, match=r"not_null\(name\): 100 of 100"):
            checked(bad, 1)
    # Rows and reports are there once all the same.
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200
    assert report(quality.stream_report(spark, str(tmp_path / "reports"))) == {("not_null", "name"): (110, 200)}
    with pytest.raises(ValueError):
        quality.checked_writer(write, "x")


def test_batch_that_broke_off_before_its_report(spark, tmp_path):
    write = batch_writer(str(tmp_path / "ledger"), path=str(tmp_path / "out"))
    write(people(spark, 0, 100), 0)
    quality.checked_writer(write, str(tmp_path / "reports"), **RULES)(people(spark, 0, 100), 0)
    assert report(quality.stream_report(spark, str(tmp_path / "reports"))) == report(quality.quality_report(people(spark, 0, 100), **RULES))


@pytest.mark.parametrize("policy", ["bin", "truncate"])
def test_bucketed_events_are_not_shuffled(spark, tmp_path, policy):
    rows = skewed_events(2, events=300, span=2000)
    events = spark.createDataFrame(rows, "uuid string, event_time_ms bigint, event_id bigint")
    spark.sql("DROP TABLE IF EXISTS bucketed_events")
    write_bucketed(events, "bucketed_events", "uuid", 4, ["event_time_ms"], location=str(tmp_path / "t"))
    found = detect_sessions(spark.table("bucketed_events"), inactivity_minutes=2, max_minutes=9, policy=policy, busy=None)
    assert "Exchange" not in plan_of(found) and "Exchange" in plan_of(detect_sessions(events, policy=policy, busy=None))
    expected = brute_sessions(rows, 2 * MINUTE, 9 * MINUTE, policy)
    assert {r.event_id: (r.session_id, r.session_start_time_ms, r.session_end_time_ms) for r in found.collect()} == expected
    spark.sql("DROP TABLE bucketed_events")
