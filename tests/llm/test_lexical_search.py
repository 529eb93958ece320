"""Ranked search against scores of all documents, and against the query's SQL."""

import math
import random
import re
from collections import Counter
from types import SimpleNamespace

import duckdb
import numpy as np
import pandas as pd
import pytest
from test_operators import LONG, ROWS, SCHEMA, prose

from clickweave.llm import lexical_search
from clickweave.llm.lexical_search import rank_documents
from clickweave.llm.queries import ORACLE_SQL, QUERIES

ITEMS = [
    (0, "alpha1 beta2 gamma3 Été4 naïve5"),
    (1, "ALPHA1, alpha1! words7; of8 -- the9"),
    (1, "ALPHA1, alpha1! words7; of8 -- the9"),
    (2, None),
    (3, ""),
    (4, "nothing of this is there"),
    (None, "same text here"),
    (6, LONG),
    (7, "12 34 no id ab" + "ab" * 699),
    (8, "the " * 60 + " ".join(f"the{i}" for i in range(50))),
]


def terms(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def brute(docs, items, wanted=10):
    bags = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    bags = [(doc_id, bag) for doc_id, bag in bags if bag]
    big_n, big_l = len(bags), sum(bag.total() for _, bag in bags)
    df = Counter(t for _, bag in bags for t in bag)
    out = Counter()
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            m, score = 25 + (75 * bag.total() * big_n) // big_l, 0
            for t, c in Counter(terms(text)).items():
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    score += c * w * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored, key=lambda s: s[:3])[:wanted], 1):
            out[item_id, rank, doc_id, -score] += 1
    return out


@pytest.fixture(scope="module")
def rows():
    own = random.Random(5)
    more = []
    for i in range(400):
        text = prose(own.randrange(1, 120), own.randrange(150))
        more.append((1000 + i, text + " the" * own.choice([0, 0, 1, 4, 30]), "r", 5, "b", "s", "en", 9))
    # Many copies, more than are wanted.
    return ROWS + more + [(2000 - i, "alpha1 beta2 gamma3", "r", 5, "b", "s", "en", 9) for i in range(40)]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    root = tmp_path_factory.mktemp("search")
    frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("row", "number").withColumnRenamed("n_bytes", "query")
    frame.repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(*i, 7) for i in ITEMS], "item_id bigint, text string, doc_id int").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def test_query(spark, rows, folder):
    found = QUERIES["op12_lexical"](spark, folder)
    assert dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert Counter(map(tuple, found.collect())) == brute([r[:2] for r in rows], ITEMS)


def test_against_sql(spark, folder, tmp_path):
    """Where ids are distinct, as the SQL takes it."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").dropna(subset=["doc_id"]).dropDuplicates(["doc_id"])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet").dropna(subset=["item_id"]).dropDuplicates(["item_id"])
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    base = duckdb.connect()
    for name in ("documents", "benchmark"):
        base.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    expected = Counter(base.sql(ORACLE_SQL["op12_lexical"]).fetchall())
    found = QUERIES["op12_lexical"](spark, str(tmp_path)).select("item_id", "rank", "doc_id", "score")
    assert Counter(map(tuple, found.collect())) == expected and len(expected) > 30


@pytest.mark.parametrize("small", [{"QUERY_BYTES": 60}, {"QUERY_ROWS": 3}, {"BROADCAST_BYTES": 0}])
def test_limits_change_no_result(spark, rows, folder, monkeypatch, small):
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = Counter(map(tuple, rank_documents(docs, items, 3).collect()))
    assert whole == brute([r[:2] for r in rows], ITEMS, 3)
    for key, value in small.items():
        monkeypatch.setattr(lexical_search, key, value)
    assert Counter(map(tuple, rank_documents(docs, items, 3).collect())) == whole


@pytest.mark.parametrize("small", [{}, {"BLOCK_DOCS": 8, "BLOCK_BYTES": 1}, {"CHUNK_TERMS": 3}, {"BITS": 1, "SLICES": 1}])
def test_bounds_hold_and_exclude(rows, monkeypatch, small):
    """Every document with a term is in a block, no bound is below its score, and few documents without a term have one."""
    for key, value in small.items():
        monkeypatch.setattr(lexical_search, key, value)
    texts = pd.DataFrame({"number": range(len(rows)), "text": [r[1] for r in rows]})
    bags = [Counter(terms(t)) for t in texts["text"]]
    big_n, big_l = sum(map(bool, bags)), sum(b.total() for b in bags)
    df = Counter(t.encode() for b in bags for t in b)
    asked = [Counter(t.encode() for t in terms(text)) for _, text in ITEMS]
    queries = lexical_search.Queries(asked, SimpleNamespace(documents=big_n, total=big_l), df)
    blocks = pd.concat(lexical_search._index(iter(np.array_split(texts, 3)))).to_dict("records")
    assert (sum(b["docs"] for b in blocks), sum(b["total"] for b in blocks)) == (big_n, big_l)
    seen, false = 0, 0
    for block in blocks:
        numbers = np.frombuffer(block["numbers"], np.int64)
        for q, bound in lexical_search.bounds(block, queries):
            for number, most in zip(numbers.tolist(), bound.tolist()):
                bag, score = bags[number], 0
                m = 25 + 75 * bag.total() * big_n // big_l
                for t, c in asked[q].items():
                    n = bag[t.decode()]
                    if n:
                        score += c * lexical_search.weight(big_n, df[t]) * (10**9 * n // (1000 * n + 8 * m))
                assert most >= score
                seen, false = seen + 1, false + (most > 0 == score)
    assert seen > 1000 and (false < seen / 50 or "BITS" in small)


def test_empty_tables(spark, folder):
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    assert rank_documents(docs.limit(0), items).count() == rank_documents(docs, items.limit(0)).count() == 0
    none = rank_documents(docs.where("text IS NULL"), items)
    assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.count() == 0
