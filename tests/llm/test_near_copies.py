"""Near copies and the pipeline's stage for them, against brute-force Jaccard similarity."""

import itertools
import random

import corpus_pipeline
import pytest

from clickweave.llm import near_copies, simhash

SCHEMA = "doc_id bigint, text string, row string, component_id int"


def words_of(n, seed):
    own = random.Random(seed)
    return [f"w{own.randrange(5000)}" for _ in range(n)]


def changed(words, n, seed):
    own, out = random.Random(seed), list(words)
    for at in own.sample(range(len(out)), n):
        out[at] = f"x{own.randrange(10**6)}"
    return out


def texts():
    out = [None, "", "one", "ONE", "two words", "two  words", "five words are one shingle"]
    for group in range(12):
        base = words_of(60 + 40 * group, group)
        out += [" ".join(changed(base, n, 100 * group + n)) for n in range(0, 12 + group, 2)]
    return out + ["It " + " ".join(words_of(60, 0)).upper()]


ROWS = [(i if i % 11 else None, t, "r", 1) for i, t in enumerate(texts())]


def jaccard(a, b):
    def shingles(text):
        parts = (text or "").lower().split()
        return {tuple(parts[i : i + 5]) for i in range(max(1, len(parts) - 4))}

    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def components():
    group = list(range(len(ROWS)))
    pairs = [(i, j) for i, j in itertools.combinations(group, 2) if jaccard(ROWS[i][1], ROWS[j][1]) >= 0.8]
    for i, j in pairs:
        old, new = group[j], group[i]
        group = [new if g == old else g for g in group]
    return group, pairs


@pytest.mark.parametrize(("limit", "value"), [("GROUP_ROWS", 20_000), ("GROUP_ROWS", 2), ("GROUP_BYTES", 500)])
def test_components(spark, tmp_path, monkeypatch, limit, value):
    monkeypatch.setattr(near_copies, limit, value)
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/d")
    found = near_copies.near_copies(spark.read.parquet(f"{tmp_path}/d")).collect()
    group, pairs = components()
    assert len(found) == len(ROWS) and sum(r.kept for r in found) == len(set(group)) and len(pairs) > 40
    least = {}
    for g, (doc_id, *_) in zip(group, ROWS):
        if doc_id is not None:
            least[g] = min(doc_id, least.get(g, doc_id))
    expected = sorted((str(d), str(least.get(g))) for g, (d, *_) in zip(group, ROWS))
    assert sorted((str(r.doc_id), str(r.component_id_)) for r in found) == expected
    assert near_copies.near_copies(spark.read.parquet(f"{tmp_path}/d").limit(0)).count() == 0


def test_stage_keeps_one_of_each_component(spark, tmp_path):
    """Most of these pairs have fingerprints more than three bits apart, so op9's rule would leave them."""
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"{tmp_path}/d")
    kept = corpus_pipeline.near_dedup(spark, spark.read.parquet(f"{tmp_path}/d"), str(tmp_path)).collect()
    group, pairs = components()
    of = {text: g for g, (_, text, *_) in zip(group, ROWS)}
    assert sorted(of[r.text] for r in kept) == sorted(set(group))
    prints = [simhash.fingerprint_of(t, 3) & (2**64 - 1) for _, t, *_ in ROWS]
    assert sum((prints[i] ^ prints[j]).bit_count() > 3 for i, j in pairs) > len(pairs) / 2


def test_fingerprints_propose(spark, tmp_path, monkeypatch):
    """Without the bands, links come from SimHash alone: of similar texts, those that fingerprints within three bits connect."""
    monkeypatch.setattr(near_copies, "band_keys", lambda text, words: near_copies.F.array().cast("array<bigint>"))
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/d")
    found = near_copies.near_copies(spark.read.parquet(f"{tmp_path}/d")).collect()
    prints = [simhash.fingerprint_of(t, 5) & (2**64 - 1) for _, t, *_ in ROWS]
    group = list(range(len(ROWS)))
    for least in (0.0, 0.8):
        own = list(range(len(ROWS)))
        for i, j in itertools.combinations(range(len(ROWS)), 2):
            close = (prints[i] ^ prints[j]).bit_count() <= 3 if least == 0 else group[i] == group[j] and jaccard(ROWS[i][1], ROWS[j][1]) >= 0.8
            if close and own[i] != own[j]:
                own = [own[i] if g == own[j] else g for g in own]
        group = own
    assert sum(r.kept for r in found) == len(set(group)) < len(ROWS) - 5
