"""Registered queries of the training-data operators, with the SQL to check them where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm import (
    exact_dedup,
    hilbert,
    langid,
    lattice,
    lexical_search,
    license_scan,
    packing,
    periodic_runs,
    piece_lattice,
    simhash,
    suffix_dedup,
    trie_counts,
    warc,
)
from clickweave.llm.common import Scratch, load
from clickweave.plans.registry import Query

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return function

    return register


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


@query("op2_lattice")
def op2_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(load(spark, sf_dir, "embeddings"), least=0.93)


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.remove_repeats(docs, length=400)
    return found.select("doc_id", "n_bytes", "n_removed", "n_kept", "n_spans", "kept_sha256", "text")


FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op4_exact_dedup",
    f"""
    WITH d AS (SELECT doc_id, sha256({FOLDED}) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    digest = exact_dedup.folded_digest(F.coalesce("text", F.lit("")))
    found = exact_dedup.exact_duplicates(docs.withColumn("text_sha256", F.lower(F.hex(digest))))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op5_langid")
def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = F.col("doc_id").isNotNull() & ~langid.held_out(F.col("doc_id"))
    model = langid.train(docs.where(out))
    found = langid.detect(docs.select("doc_id", "text", langid.held_out(F.col("doc_id")).alias("held_out")), model)
    return found.drop("text")


@query("op6_hilbert")
def op6_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.hilbert_shards(load(spark, sf_dir, "documents"))


@query("op7_trie_counts")
def op7_trie_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_counts.count_tokens(load(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query("op8_piece_lattice")
def op8_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = piece_lattice.encode(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_ids"),
        F.xxhash64("ids").alias("ids_xxhash64"),
        F.sha2(piece_lattice.decode(F.col("ids")).cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select("doc_id", simhash.hex_print(F.col("print")).alias("fingerprint"), "component_id")


@query(
    "op10_warc",
    """
    WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                      sha256(coalesce(html, '')) AS payload_digest FROM pages),
         f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
    FROM f
    """,
)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    warc.write_archives(warc.chunks(warc.records(load(spark, sf_dir, "pages"))), scratch.root)
    return warc.read_records(warc.read_archives(spark, scratch.root, with_payload=False))


@query("op11_licences")
def op11_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licences(load(spark, sf_dir, "documents").select("doc_id", "text"))
    f = F.col("licences")
    return found.select(
        "doc_id",
        f["n_words"].alias("n_words"),
        f["n_places"].alias("n_base"),
        f["first_place"].alias("first_word"),
        f["last_place"].alias("last_word"),
        F.array_join(f["phrase_labels"], ",").alias("base_labels"),
        F.array_join(f["labels"], ",").alias("labels"),
        f["score"].alias("score"),
    )


#: Terms of a text in DuckDB; two of the same id would count as one document.
TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(FOLDED)


@query(
    "op12_lexical",
    f"""
    WITH d AS (SELECT doc_id, {TERMS} AS terms FROM documents),
         s AS (SELECT count(*) AS big_n, CAST(sum(len(terms)) AS BIGINT) AS big_l FROM d WHERE len(terms) > 0),
         tf AS (SELECT doc_id, n, term, count(*) AS tf
                FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY doc_id, n, term),
         w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
               FROM tf, s GROUP BY term, big_n),
         q AS (SELECT item_id, term, count(*) AS c
               FROM (SELECT item_id, unnest({TERMS}) AS term FROM benchmark) GROUP BY item_id, term),
         found AS (SELECT item_id, doc_id,
                          CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l)))) AS BIGINT) AS score
                   FROM q JOIN w USING (term) JOIN tf USING (term), s GROUP BY item_id, doc_id),
         ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                           doc_id, score FROM found WHERE score > 0)
    SELECT * FROM ranked WHERE rank <= 10
    """,
)
def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query("op13_runs")
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.find_runs(docs, seed=F.crc32(F.col("doc_id").cast("string").cast("binary")))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )
