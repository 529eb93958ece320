"""Repeated passages of over 50 words, whatever their length in bytes, against brute force."""

import random
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest

from clickweave.llm import passages, suffix_array

SCHEMA = "doc_id bigint, text string, n_chars bigint"


def words(n, seed):
    own = random.Random(seed)
    return [own.choice("abcdefghijklmnopqrstuvwxyzé") + str(own.randrange(100)) for _ in range(n)]


def join(parts, seed):
    own = random.Random(seed)
    return "".join(p + own.choice([" ", " ", "\n", "  "]) for p in parts)


SHARED, FIFTY, TWICE = words(51, 1), words(50, 2), words(55, 3)
TEXTS = [
    join(words(30, 10) + SHARED + words(20, 11), 1),
    join(words(40, 12) + SHARED, 2),
    join(words(30, 13) + FIFTY + words(20, 14), 3),
    join(FIFTY + words(33, 15), 4),
    join(TWICE + words(5, 16) + TWICE + words(9, 17), 5),
    join(words(7, 18) * 13, 6),
    join(words(7, 19) * 30, 7),
    join(SHARED[1:] + words(10, 20), 8),
    join(words(300, 21), 9),
    join([*words(20, 22), *SHARED[20:], *words(31, 23)], 10),
    "",
    *[join(words(200, 30)[i : i + 90], 11) for i in range(0, 110, 9)],
]


def left(texts):
    """What a count of all windows leaves; a window recurs in two texts, or at places of one that do not overlap."""
    places = defaultdict(list)
    for t, text in enumerate(texts):
        parts = text.split()
        for i in range(len(parts) - 50):
            places[tuple(parts[i : i + 51])].append((t, i))
    covered = defaultdict(set)
    for found in places.values():
        if found[0][0] != found[-1][0] or found[-1][1] - found[0][1] >= 51:
            for t, i in found:
                covered[t] |= set(range(i, i + 51))
    out = []
    for t, text in enumerate(texts):
        kept, at, pos, before = [], 0, 0, False
        for n, word in enumerate(text.split()):
            at = text.index(word, pos)
            if not (before and n in covered[t]):
                kept.append(text[pos:at])
            if n not in covered[t]:
                kept.append(word)
            before, pos = n in covered[t], at + len(word)
        out.append("".join(kept) + text[pos:])
    return out, covered


@pytest.mark.parametrize("contents", [1024, 1])
def test_stage(spark, tmp_path, monkeypatch, contents):
    monkeypatch.setattr(passages, "GROUP_CONTENTS", contents)
    # No passage has 400 bytes, so bytes alone cut nothing.
    monkeypatch.setattr(corpus_pipeline, "REPEAT_BYTES", 4000)
    rows = [(i, t, len(t)) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/d")
    found = corpus_pipeline.repeat_removal(spark, spark.read.parquet(f"{tmp_path}/d"), str(tmp_path)).collect()
    expected, covered = left(TEXTS)
    assert {r.doc_id: r.text for r in found} == {i: t for i, t in enumerate(expected) if t or not covered[i]}
    assert all(r.n_chars == len(r.text) for r in found)
    assert covered[0] and covered[4] and covered[6] and not covered[2] and not covered[5] and not covered[7]


def test_short_bytes_are_cut(spark, tmp_path):
    """51 words of under 400 bytes."""
    assert len(" ".join(SHARED).encode()) < 400
    rows = [(i, t, len(t)) for i, t in enumerate(TEXTS[:2])]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/d")
    found = corpus_pipeline.repeat_removal(spark, spark.read.parquet(f"{tmp_path}/d"), str(tmp_path)).collect()
    assert {r.doc_id: r.text for r in found} == dict(enumerate(left(TEXTS[:2])[0]))


@pytest.mark.parametrize("length", [1, 2, 5, 51])
def test_prefix_ranks(length):
    items = np.random.default_rng(5).integers(0, 2, 400).astype(np.uint64)
    items[200:300] = items[:100]
    ranks = suffix_array.prefix_ranks(items, length)
    prefixes = [tuple(items[i : i + length]) for i in range(400 - length + 1)]
    order = {p: n for n, p in enumerate(sorted(set(prefixes)))}
    assert ranks.tolist() == [order[p] for p in prefixes]
