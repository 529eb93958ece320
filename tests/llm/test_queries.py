"""Every registered query of the training-data operators, run as the driver runs it, against brute force or its SQL."""

import hashlib
import itertools
import os
import random
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from test_operators import ROWS, SCHEMA, folded, prose
from tokenizers import Tokenizer

from clickweave.llm import pieces
from clickweave.llm.queries import ORACLE_SQL, QUERIES

ROOT = Path(__file__).resolve().parents[2]
own = random.Random(11)
FRENCH = "le chat et le chien sont allés à la maison pour voir une très belle étoile dans la forêt profonde".split()
ENGLISH = "the cat and the dog went to the house for a look at one very bright star in that deep forest".split()


def speech(words, n):
    return " ".join(own.choice(words) for _ in range(n))


MORE = [(100 + i, speech(ENGLISH if i % 2 else FRENCH, 40), "r", 5, "b", f"s{i % 3}", "en" if i % 2 else "fr", 9) for i in range(60)]
MORE += [(300, prose(100, 1) + " mixed ☃𝄞 naïveɏɐ <|endoftext|> " + prose(50, 2), "r", 5, "b", "s", None, 9)]
MORE += [(301 + i, prose(300, 40) + " " * i + prose(20, 41 + i), "r", 5, "b", "s", "en", 9) for i in range(3)]
DOCS = [r for r in ROWS if r[0] != 7] + MORE
TEXTS = [(r[0], r[1] or "") for r in DOCS]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(DOCS, SCHEMA).repartition(3).write.parquet(f"{root}/documents.parquet")
    pages = [(i, f"http://x/{i}", h) for i, h in enumerate(["a" * 99, "a" * 99, "b" * 100, "b" * 100, None, "", "é" * 50, "é" * 50, prose(40_000, 1)] * 3)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(2).write.parquet(f"{root}/pages.parquet")
    vectors = planted_vectors()
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int").repartition(3).write.parquet(f"{root}/embeddings.parquet")
    items = [(i, speech(ENGLISH, 12)) for i in range(4)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def planted_vectors():
    draw, rows, noises = np.random.default_rng(2), [], random.Random(3)
    for group in range(40):
        centre = draw.normal(size=64)
        for _ in range(10):
            noise = draw.normal(size=64) * noises.choice([0.05, 0.2, 0.26])
            rows.append((len(rows), (centre + noise).astype(np.float32).tolist(), group % 3))
    return rows + [(1000, None, 1), (1001, [0.0] * 64, 1), (1002, rows[0][1], None), (1003, rows[1][1], 0)]


def rows_of(spark, folder, name, *columns):
    found = QUERIES[name](spark, folder)
    return [tuple(r) for r in found.select(*columns).collect()]


def test_op1(spark, folder):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = rows_of(spark, folder, "op1_packing", "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    expected, total = Counter(), 0
    for doc_id, text in TEXTS:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        total += len(ids)
        expected[doc_id, len(ids)] += 1
        for r in (r for r in found if r[0] == doc_id and r[2] + r[3] <= len(ids)):
            assert zlib.crc32(ids[r[2] : r[2] + r[3]].tobytes()) == r[4] or sum(d == doc_id for d, _ in TEXTS) > 1
    lengths = defaultdict(int)
    for r in found:
        lengths[r[0]] += r[3]
    assert lengths == {d: sum(n * c for (e, n), c in expected.items() if e == d) for d, _ in TEXTS}
    sequences = defaultdict(list)
    for r in found:
        sequences[r[5]].append((r[6], r[3]))
    for parts in sequences.values():
        parts.sort()
        assert [at for at, _ in parts] == [0, *itertools.accumulate(n for _, n in parts)][:-1] and sum(n for _, n in parts) <= 1024
    assert len(sequences) <= -(-total // 1024) + 1


def test_op2(spark, folder):
    rows = [r for r in planted_vectors() if r[0] < 1000 or r[0] == 1003]
    unit = np.array([r[1] for r in rows], np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & np.equal.outer([r[2] for r in rows], [r[2] for r in rows])
    np.fill_diagonal(near, False)
    found = {r[0]: r for r in rows_of(spark, folder, "op2_lattice", "vec_id", "n_links", "component_id", "kept")}
    assert len(found) == len(planted_vectors())
    links = sum(found[r[0]][1] for r in rows)
    assert all(found[r[0]][1] <= near[i].sum() for i, r in enumerate(rows))
    assert 300 < near.sum() and links >= 0.95 * near.sum()
    assert all(found[i] == (i, 0, i, True) for i in (1000, 1001, 1002))
    assert all(kept == (i == component) for i, _, component, kept in found.values())


def test_op3(spark, folder):
    data = [(d, t.encode()) for d, t in TEXTS]
    seen = Counter(b[i : i + 400] for _, b in data for i in range(len(b) - 399))
    expected = Counter()
    for doc_id, b in data:
        covered = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                covered[i : i + 400] = True
        kept = bytes(x for x, gone in zip(b, covered) if not gone)
        spans = int((np.diff(covered.astype(int), prepend=0) > 0).sum())
        expected[doc_id, len(b), len(b) - len(kept), len(kept), spans, hashlib.sha256(kept).hexdigest()] += 1
    found = rows_of(spark, folder, "op3_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_kept", "n_spans", "kept_sha256")
    assert Counter(found) == expected and sum(r[2] > 0 for r in found) > 3


def test_op3_text(spark, tmp_path):
    """What is left of each text is a column: passages of over 50 words go from 400 bytes on, shorter ones and other texts stay."""
    long, short = " ".join(f"étude{i:02}" for i in range(60)), " ".join(f"w{i:02}" for i in range(60))
    assert len(long.encode()) > 400 > len(short.encode())
    rows = [(0, f"{long} aa"), (1, f"bb {long}"), (2, f"{short} cc"), (3, f"dd {short}"), (4, prose(200, 77)), (5, None), (6, f"{'é' * 300}x"), (7, f"y{'é' * 300}")]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    left = dict(rows_of(spark, str(tmp_path), "op3_suffix_dedup", "doc_id", "text"))
    assert left == {**dict(rows), 0: " aa", 1: "bb ", 5: "", 6: "x", 7: "y"}
    digests = dict(rows_of(spark, str(tmp_path), "op3_suffix_dedup", "doc_id", "kept_sha256"))
    assert digests == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in left.items()}


@pytest.mark.parametrize(("name", "table"), [("op4_exact_dedup", "documents"), ("op10_warc", "pages")])
def test_against_sql(spark, folder, tmp_path, name, table):
    """Where ids are distinct and not null, as the SQL takes them."""
    frame, key = spark.read.parquet(f"{folder}/{table}.parquet"), {"documents": "doc_id", "pages": "page_id"}[table]
    frame.dropna(subset=[key]).dropDuplicates([key]).write.parquet(f"{tmp_path}/{table}.parquet")
    base = duckdb.connect()
    base.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    expected = base.sql(ORACLE_SQL[name])
    assert Counter(rows_of(spark, str(tmp_path), name, *expected.columns)) == Counter(expected.fetchall())


def test_op5(spark, folder):
    found = rows_of(spark, folder, "op5_langid", "doc_id", "held_out", "lang_pred", "score")
    assert len(found) == len(DOCS)
    right = {r[0]: r[6] for r in MORE if 100 <= r[0] < 160}
    for doc_id, held_out, lang, score in found:
        assert held_out == (doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert lang in ("en", "fr", "und") and 0 <= score <= 1
    assert all(lang == right[doc_id] for doc_id, held_out, lang, _ in found if doc_id in right and held_out)
    assert {r[2] for r in found if r[0] in (4, 5, 6)} == {"und"}


def test_op6(spark, folder):
    found = rows_of(spark, folder, "op6_hilbert", "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    assert Counter(r[:3] for r in found) == Counter((d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in TEXTS)
    slots = defaultdict(list)
    for r in found:
        slots[r[4]].append(r[5])
        assert r[3] == "rows" and r[6] is None
    sizes = [len(slots[i]) for i in range(16)]
    assert sum(sizes) == len(DOCS) and max(sizes) - min(sizes) <= 1 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def best_count(text, table):
    """Ids of the best path over a whole text, not cut into words."""
    marked, best = pieces.SPACE + text.replace(" ", pieces.SPACE), [(0.0, 0)]
    for end in range(1, len(marked) + 1):
        options = []
        for start in range(max(0, end - table.longest), end):
            piece = table.pieces.get(marked[start:end])
            if piece:
                options.append((best[start][0] + piece[1], best[start][1] - 1))
        if marked[end - 1] not in table.pieces:
            options.append((best[end - 1][0] + table.unknown_score, best[end - 1][1] - len(marked[end - 1].encode())))
        best.append(max(options))
    return -best[-1][1] if text else 0


def test_op7_and_op8(spark, folder):
    table = pieces.load_pieces(pieces.default_model())
    counted = Counter(rows_of(spark, folder, "op7_trie_counts", "doc_id", "n_tokens"))
    encoded = rows_of(spark, folder, "op8_piece_lattice", "doc_id", "n_ids", "decoded_sha256")
    assert Counter(r[:2] for r in encoded) == counted
    assert Counter((r[0], r[2]) for r in encoded) == Counter((d, hashlib.sha256(t.encode()).hexdigest()) for d, t in TEXTS)
    short = {d for d, t in TEXTS if len(t) < 1500 and sum(e == d for e, _ in TEXTS) == 1}
    expected = {d: best_count(t, table) for d, t in TEXTS if d in short}
    assert {d: n for d, n in counted if d in short} == expected and len(expected) > 50


def test_op9(spark, folder):
    def print_of(text):
        words = folded(text).encode().split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = [print_of(t) for _, t in TEXTS]
    root = list(range(len(TEXTS)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(TEXTS)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 3:
            root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(TEXTS):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    expected = Counter((d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(TEXTS, prints)))
    assert Counter(rows_of(spark, folder, "op9_simhash", "doc_id", "fingerprint", "component_id")) == expected


SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry_point", sys.argv[1])
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", sys.argv[3]).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
for name, query in entry.queries().items():
    if name.startswith("op") and name[2].isdigit() or name == "pipeline":
        print("DONE", name, query(spark, sys.argv[2]).count(), flush=True)
"""


def test_workers_that_cannot_import_the_package(folder, tmp_path):
    """From a folder of its own, without a path to the package."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = [sys.executable, "-c", SCRIPT, str(ROOT / "__spark_entry__.py"), folder, str(tmp_path / "shared")]
    out = subprocess.run(run, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    done = {line.split()[1]: int(line.split()[2]) for line in out.stdout.splitlines() if "DONE" in line and line.startswith("DONE")}
    assert set(done) == {*QUERIES, "pipeline"}, out.stderr[-2000:]
    assert all(done.values())
