"""Runs of words against brute force over all periods."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from test_operators import ROWS, SCHEMA, prose

from clickweave.llm import periodic_runs
from clickweave.llm.queries import QUERIES


def brute(words, least=24, repeats=3):
    """For every period the maximal stretches; of equal stretches the smallest period counts."""
    n, found = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            # A multiple of the smallest period gives the same stretch.
            if length >= max(least, repeats * q) and (i, length) not in found:
                found[i, length] = q
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def tailed(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def strings(own):
    yield []
    yield ["a"] * 500
    yield list("abracadabra" * 30)
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    yield list(fib[-1])
    for _ in range(150):
        parts = []
        while len(parts) < own.randrange(10, 250):
            word = [own.choice("ab" if own.random() < 0.5 else "abcdefgh") for _ in range(own.randrange(1, 9))]
            inner = word * own.randrange(1, 9)
            parts += inner * own.randrange(1, 6)
        yield parts


@pytest.mark.parametrize(("least", "repeats"), [(24, 3), (2, 2), (5, 2), (7, 4), (16, 5)])
def test_runs_of_words(least, repeats, monkeypatch):
    own = random.Random(least)
    texts = list(strings(own))
    for batch in (1, 500, 1 << 18):
        monkeypatch.setattr(periodic_runs, "BATCH_WORDS", batch)
        monkeypatch.setattr(periodic_runs, "MUCH_LARGER", batch % 7)
        out = periodic_runs.analyse([" ".join(t) for t in texts], [None] * len(texts), least, repeats)
        for words, (starts, lengths, periods, best, kept) in zip(texts, out, strict=True):
            runs = list(zip(starts, lengths, periods))
            assert runs == brute(words, least, repeats)
            assert kept == collapsed(words, runs)
            if runs:
                assert runs[best] == min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
            else:
                assert best is None


def test_least_prefix():
    for least in range(2, 60):
        for repeats in range(2, min(least, 9) + 1):
            expected = min(max(least, repeats * q) - q for q in range(1, 200))
            assert periodic_runs.least_prefix(least, repeats) == max(1, expected)


def test_long_common_prefixes_are_compared_in_steps(monkeypatch):
    monkeypatch.setattr(periodic_runs, "MOST_CELLS", 64)
    words = (prose(40, 3).split() * 60)[:-7]
    ids = np.append(np.unique(words, return_inverse=True)[1] + 1, 0)
    assert periodic_runs.runs_of(ids, 24, 3) == brute(words)


EXTRA = [(i, " ".join(prose(9, i).split() * 7) + " x " + "la " * i, "r", 5, "b", "s", "en", 9) for i in range(100, 160)]


def test_query(spark, tmp_path):
    """The registered query over nulls, empty and long texts, repeats and clashing names."""
    rows = ROWS + EXTRA + [(300, " \t\n\x0b\x0c\r ", "r", 5, "b", "s", "en", 9), (301, "x\x1cy " * 30, "r", 5, "b", "s", "en", 9)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("row", "runs").withColumnRenamed("n_bytes", "done")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    expected = Counter()
    for doc_id, text, *_ in rows:
        words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
        if doc_id is not None:
            words = tailed(words, doc_id)
        runs = brute(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, runs))]
        expected[doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *digests] += 1
    found = QUERIES["op13_runs"](spark, str(tmp_path))
    assert Counter(map(tuple, found.collect())) == expected
    assert sum(r[1] > 0 for r in expected) > 20
    kinds = dict(found.dtypes)
    assert {kinds[c] for c in ("n_runs", "start", "length", "period", "exponent_milli")} == {"bigint"}
    whole = periodic_runs.find_runs(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    assert whole.columns[-3:] == ["runs_", "strongest", "collapsed_text"] and whole.count() == len(rows)
    assert periodic_runs.find_runs(frame.limit(0)).count() == 0
