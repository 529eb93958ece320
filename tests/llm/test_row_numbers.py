"""Rows keep their numbers when a later job splits the scan otherwise, as it does when executors come or go."""

import hashlib
import random
from collections import Counter

import pytest

from clickweave.llm import exact_dedup, piece_lattice, suffix_dedup

SPLIT = "spark.sql.files.maxPartitionBytes"


def texts():
    own = random.Random(4)
    passage = " ".join(str(own.random()) for _ in range(40))
    out = [" ".join(str(own.random()) for _ in range(own.randrange(3, 60))) for _ in range(300)]
    return [f"{t} {passage} {n}" if n % 9 == 0 else (out[n - 1] if n % 10 == 5 else t) for n, t in enumerate(out)]


@pytest.fixture
def docs(spark, tmp_path, monkeypatch):
    """A scan that is dealt to more and more partitions each time that an operator writes a table."""
    from clickweave.llm.common import Scratch

    rows = [(i, t) for i, t in enumerate(texts())]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(12)
    frame.write.option("parquet.block.size", 8192).parquet(f"{tmp_path}/d")
    kept, sizes, before = Scratch.keep, iter([1 << 30, 40_000, 20_000, 8_000] * 20), spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, next(sizes))

    def keep(self, df):
        out = kept(self, df)
        spark.conf.set(SPLIT, next(sizes))
        return out

    monkeypatch.setattr(Scratch, "keep", keep)
    yield spark.read.parquet(f"{tmp_path}/d")
    spark.conf.set(SPLIT, before)


def test_repeats(docs):
    found = suffix_dedup.remove_repeats(docs).collect()
    data = {i: t.encode() for i, t in enumerate(texts())}
    seen = Counter(d[i : i + 400] for d in data.values() for i in range(len(d) - 399))
    for row in found:
        d, covered = data[row.doc_id], set()
        for i in range(len(d) - 399):
            if seen[d[i : i + 400]] > 1:
                covered |= set(range(i, i + 400))
        left = bytes(b for i, b in enumerate(d) if i not in covered)
        assert row.kept_sha256 == hashlib.sha256(left).hexdigest()


def test_exact_duplicates(docs):
    found = exact_dedup.exact_duplicates(docs).collect()
    last = {t: i for i, t in enumerate(texts())}
    assert sorted(r.doc_id for r in found if r.kept) == sorted(last.values())
    assert {r.doc_id: r.keep_id for r in found} == {i: last[t] for i, t in enumerate(texts())}


def test_pieces(docs):
    table = piece_lattice.load_pieces(piece_lattice.default_model())
    found = {r.doc_id: r.ids for r in piece_lattice.encode(docs).collect()}
    for i, text in list(enumerate(texts()))[:20]:
        ids = [x for w in table.words(text) for p in table.parts(w) for x in piece_lattice.best_ids(p, table)]
        assert found[i] == ids
    assert len(found) == 300


def test_numbers_tell_rows_apart_and_write_nothing(docs, spark):
    """By file and place for a scan, whatever is chosen or filtered; anything else is written once."""
    from clickweave.llm.common import Scratch, numbered

    scratch = Scratch(spark, "numbers")
    for scan in (docs, docs.select("text").where("text > '0.3'"), docs.withColumnRenamed("doc_id", "File_Path")):
        seen = [Counter(numbered(scan, "row", scratch).collect())]
        spark.conf.set(SPLIT, 5_000)
        named = numbered(scan, "row", scratch)
        assert named.columns == [*scan.columns, "row"]
        seen.append(Counter(named.collect()))
        assert seen[0] == seen[1] and len({r.row for r in seen[0]}) == scan.count() > 50
    assert scratch.count == 0
    for n, other in enumerate((docs.union(docs), docs.limit(7), spark.range(5), docs.withColumn("_metadata", docs["text"])), 1):
        found = numbered(other, "row", scratch).collect()
        assert scratch.count == n and len({r.row for r in found}) == len(found) > 4
    one = docs.coalesce(1)
    assert len({r.row for r in numbered(one, "row", scratch).collect()}) == 300


def test_one_file_and_none(spark, tmp_path):
    from clickweave.llm.common import Scratch, numbered

    scratch = Scratch(spark, "numbers")
    spark.range(10).coalesce(1).write.parquet(f"{tmp_path}/one")
    assert sorted(r.row for r in numbered(spark.read.parquet(f"{tmp_path}/one"), "row", scratch).collect()) == list(range(10))
    spark.range(0).write.parquet(f"{tmp_path}/none")
    assert numbered(spark.read.parquet(f"{tmp_path}/none"), "row", scratch).collect() == []


def test_collected_tables_are_dropped(spark):
    from clickweave.llm.common import Scratch, collecting

    with collecting():
        inner = Scratch(spark, "inner")
        inner.keep(spark.range(3))
    outer = Scratch(spark, "outer")
    outer.keep(spark.range(3))
    assert not _there(spark, inner) and _there(spark, outer)
    outer.drop(1)
    assert _there(spark, outer)
    outer.drop_all()
    assert not _there(spark, outer)


def _there(spark, scratch):
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch.root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
