"""Levels of dimensions of every kind, repeated rows, and files that readers can prune."""

import datetime
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clickweave.llm import hilbert

own = random.Random(3)
N = 2000
KINDS = {
    "site": ("string", lambda i: f"https://site{i % 50}.example/"),
    "deep": ("string", lambda i: "common/" * 40 + str(i % 37)),
    "unicode": ("string", lambda i: "é" * (i % 9) + str(i % 11)),
    "uneven": ("string", lambda i: "a" if i % 3 else f"b{i}"),
    "bytes": ("binary", lambda i: bytes([255, i % 256, i % 7])),
    "nulls": ("binary", lambda i: bytes(i % 9) + bytes([i % 5])),
    "fraction": ("decimal(12,10)", lambda i: Decimal(i) / N),
    "real": ("double", lambda i: i / N if i % 50 else float("nan")),
    "day": ("date", lambda i: datetime.date(2020, 1, 1) + datetime.timedelta(i % 600)),
    "time": ("timestamp", lambda i: datetime.datetime(2020, 1, 1) + datetime.timedelta(seconds=i)),
    "flag": ("boolean", lambda i: i % 2 == 0),
    "number": ("bigint", lambda i: (i * 7919) % N * 10**15),
}
#: Levels that so many rows of each kind can fill.
LEVELS = {"flag": 2, "uneven": 6, "nulls": 9}


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, f"t{i}", "same", *[None if i % 101 == 100 else make(i) for _, make in KINDS.values()]) for i in range(N)]
    own.shuffle(rows)
    schema = "doc_id bigint, text string, constant string, " + ", ".join(f"{k} {kind}" for k, (kind, _) in KINDS.items())
    return spark.createDataFrame(rows, schema).repartition(4).cache()


def sort_key(value):
    if isinstance(value, str):
        return value.encode()
    return bytes(value) if isinstance(value, bytearray) else value


@pytest.mark.parametrize("kind", KINDS)
def test_levels_follow_the_order_and_fill_up(table, kind):
    key = hilbert.order_key(table, kind)
    cuts = hilbert.quantile_cuts(table.select(key.alias("k")), 4)[0]
    found = table.select(kind, hilbert.level(key, cuts).alias("level")).collect()
    assert all(r.level == 0 for r in found if r[0] is None)
    rows = sorted(((sort_key(r[0]), r.level) for r in found if r[0] is not None and r[0] == r[0]), key=lambda x: x[0])
    assert [level for _, level in rows] == sorted(level for _, level in rows)
    counts = Counter(level for _, level in rows)
    assert len(counts) >= LEVELS.get(kind, 10) and max(counts) <= 15
    if kind == "nulls":
        return  # runs of zero bytes are told apart by their order only
    # No level holds much more than its share, but for a value that alone has more.
    most = max(Counter(k for k, _ in rows).values())
    assert max(counts.values()) <= max(2.6 * len(rows) / 16, 1.1 * most + len(rows) / 16)


def test_constant_and_missing_dimensions(table, spark):
    nothing = table.withColumn("none", F.lit(None).cast("string"))
    keys = nothing.select(*[hilbert.order_key(nothing, c).alias(c) for c in ("constant", "none")])
    cuts = hilbert.quantile_cuts(keys, 4)
    assert [len(c) for c in cuts] == [1, 0]
    found = hilbert.hilbert_shards(nothing, ("constant", "none"), 7).collect()
    assert len({r.curve for r in found}) == 1 and Counter(r.shard for r in found).keys() == set(range(7))
    with pytest.raises(ValueError):
        hilbert.hilbert_shards(table.withColumn("list", F.array("doc_id")), ("list",))


def test_one_row_again_and_again(spark):
    """Repeats of one row are dealt to many groups, and every one has a place of its own."""
    many = spark.range(100_000).select(F.lit(1).alias("doc_id"), F.lit("x").alias("text"), F.lit("s").alias("source"))
    found = hilbert.hilbert_shards(many, ("source",), 16)
    slots = defaultdict(list)
    for r in found.select("shard", "slot").collect():
        slots[r.shard].append(r.slot)
    assert {len(s) for s in slots.values()} == {6250} and all(sorted(s) == list(range(6250)) for s in slots.values())


def test_written_shards_are_pruned(spark, table, tmp_path):
    """A reader that asks for a small range of one dimension reads few files."""
    placed = hilbert.hilbert_shards(table, ("site", "number"), 16)
    path = str(tmp_path / "shards")
    hilbert.write_shards(table, placed, path)
    back = spark.read.parquet(path)
    assert Counter(back.select("doc_id", "text").collect()) == Counter(table.select("doc_id", "text").collect())
    ranges = back.groupBy(F.input_file_name()).agg(F.min("number").alias("low"), F.max("number").alias("high"), F.min("site").alias("a"), F.max("site").alias("b")).collect()
    tenth = N // 10 * 10**15
    assert len(ranges) >= 16
    assert sum(r.low is not None and r.low < tenth for r in ranges) <= len(ranges) / 2
    assert sum(r.a is not None and r.a < "https://site13" for r in ranges) <= len(ranges) / 2
    sizes = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1
