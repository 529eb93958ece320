"""The pipeline's stages, each held against brute force on what the stage before it kept."""

import re
from collections import Counter

import corpus_pipeline
import pytest
from test_operators import LONG, ROWS, SCHEMA, folded, prose

from clickweave.llm import packing, simhash
from clickweave.llm.common import Scratch, numbered

NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
MORE = [
    (20, prose(300, 20), "r", 5, "b", "s", "en", 9),
    (21, prose(300, 20) + ".", "r", 5, "b", "s", "en", 9),
    (22, "Le chat et le chien sont allés à la maison " * 9, "r", 5, "b", "s", "fr", 9),
]


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """Rows after each stage, written and read back as the pipeline does."""
    root = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(ROWS + MORE, SCHEMA).repartition(2).write.parquet(f"{root}/documents.parquet")
    docs, out = spark.read.parquet(f"{root}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(root)).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out[name] = (docs.columns, [tuple(r) for r in docs.collect()])
    whole = corpus_pipeline.run(spark, str(root)).drop("sequence_id", "offset").collect()
    assert Counter(map(tuple, whole)) == Counter(r[:5] for r in out["best-fit packing"][1])
    return out


def test_stages(kept):
    assert list(kept) == ["language ID", "exact dedup", "SimHash near-dedup", "suffix-array dedup", "best-fit packing"]
    assert all(kept[name][0] == NAMES for name in list(kept)[:4])


def test_one_python_worker_a_task(spark, tmp_path):
    """Texts go to Python once a plan: a second evaluation holds a second worker for every task."""
    spark.createDataFrame(ROWS + MORE, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs, shared = spark.read.parquet(f"{tmp_path}/documents.parquet"), Scratch(spark, "test")
    for stage in (corpus_pipeline.language_id, corpus_pipeline.repeat_removal):
        plan = stage(spark, docs, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1, stage
    kept, plans = Scratch.keep, []

    def keep(self, df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(self, df)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Scratch, "keep", keep)
        corpus_pipeline.exact_dedup(spark, docs, str(tmp_path))
    assert max(p.count("ArrowEvalPython") for p in plans) == 1
    # The list of files does not pass through Python workers.
    assert "ExistingRDD" not in numbered(docs, "row", shared)._jdf.queryExecution().executedPlan().toString()


def test_language_stage(kept):
    lettered = Counter(r for r in ROWS + MORE if r[1] and re.search(r"[^\W\d_]", r[1]))
    assert Counter(kept["language ID"][1]) == lettered


def test_exact_stage(kept):
    before, after = kept["language ID"][1], kept["exact dedup"][1]
    groups = {}
    for row in before:
        groups.setdefault(folded(row[1]), []).append(row[0] if row[0] is not None else -1)
    assert Counter((folded(r[1]), r[0] if r[0] is not None else -1) for r in after) == Counter(
        (text, max(ids)) for text, ids in groups.items()
    )


def test_near_stage(kept):
    before, after = kept["exact dedup"][1], kept["SimHash near-dedup"][1]
    prints = {r: simhash.fingerprint_of(r[1], 3) & (2**64 - 1) for r in before}
    group = {r: r for r in before}
    for a in before:
        for b in before:
            if (prints[a] ^ prints[b]).bit_count() <= 3 and group[a] != group[b]:
                old = group[b]
                group = {r: group[a] if g == old else g for r, g in group.items()}
    assert {group[r] for r in after} == set(group.values()) and len(after) == len(set(group.values()))
    assert {20, 21} & {r[0] for r in after} and not {20, 21} <= {r[0] for r in after}


def test_repeat_stage(kept):
    before, after = kept["SimHash near-dedup"][1], kept["suffix-array dedup"][1]
    data = {r[0]: r[1].encode() for r in before}
    seen = Counter(d[i : i + 400] for d in data.values() for i in range(len(d) - 399))
    for row in before:
        d, covered = data[row[0]], set()
        for i in range(len(d) - 399):
            if seen[d[i : i + 400]] > 1:
                covered |= set(range(i, i + 400))
        left = bytes(b for i, b in enumerate(d) if i not in covered).decode()
        found = [r for r in after if r[0] == row[0]]
        assert [r[1] for r in found] == ([left] if left else [])
        assert all(r[7] == (len(left) if covered else row[7]) for r in found)


def test_packing_stage(kept):
    encode = packing.encoder(packing.tokenizer_folder())
    columns, rows = kept["best-fit packing"]
    lengths = Counter()
    for r in rows:
        lengths[r[columns.index("doc_id")]] += r[columns.index("length")]
    assert lengths == {r[0]: len(encode(r[1])) + 1 for r in kept["suffix-array dedup"][1]}
    assert len(LONG) > 20_000


def test_tables_on_the_way_are_dropped(spark, tmp_path, monkeypatch):
    """After a run only what the returned plan reads is left: the last but one output, and the pieces of the packing."""
    from clickweave.llm import common

    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path / "shared"))
    spark.createDataFrame(ROWS + MORE, SCHEMA).repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    left = {p.parent.relative_to(tmp_path / "shared") for p in (tmp_path / "shared").rglob("*.parquet")}
    roots = sorted(str(p).rsplit("-", 1)[0] for p in left)
    assert roots == ["packing", "pipeline"] or roots == ["pipeline"]
    assert {p.name for p in left if str(p).startswith("pipeline")} == {str(len(corpus_pipeline.STAGES) - 1)}
    assert out.count() > 0
