"""Ranked lexical search over bit-sliced Bloom signatures, exact by rescoring whatever they cannot exclude.

The index has blocks of documents with about as many distinct terms. A block is a bit matrix: a column for each document, a row
for each slice. A term sets a few slices of its document, chosen by hash, once for every one of ``LEVELS`` that its
number of occurrences reaches. The AND of a term's slices is a bitmap with every document of the block that has the term so
often, and some that do not. Summing a query's weights over its bitmaps, with the most that the occurrences of a level can
score, bounds every document's score from above.

A search takes the documents with the highest bounds first and scores them on their texts. The tenth best score is
a limit: what is bounded below it is excluded for certain, and everything else is scored on its text as well.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweave.llm.common import Scratch, bound_batches, column, numbered

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")

#: A term is entered once for every one of these numbers of occurrences that it reaches.
LEVELS = np.array([1, 2, 3, 5, 9, 17])
#: Slices of an entry, and bits for every entry that the documents of a block have at most.
SLICES, BITS = 4, 12
#: Documents of a block, and bytes of its matrix, at most; a document that needs more shares a block with seven others.
BLOCK_DOCS, BLOCK_BYTES = 1024, 2 << 20
#: Bytes of query texts that are searched for together, and so broadcast, and how many queries that may be.
QUERY_BYTES, QUERY_ROWS = 8 << 20, 20_000
#: Terms of queries whose bitmaps are held at a time.
CHUNK_TERMS = 1 << 12
#: Bytes of row numbers and query numbers that go to every executor; beyond, they are joined by shuffle.
BROADCAST_BYTES = 32 << 20

SCALE, WEIGHT_SCALE = 1_000_000_000, 1000


def terms_of(text: str | None) -> list[bytes]:
    """Terms in order: runs of ASCII letters and digits and of bytes beyond ASCII, A-Z lower-cased."""
    return TERM.findall(text.encode(errors="replace").lower()) if text else []


def lengths(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The length part of the score, for documents of ``n`` terms."""
    return 25 + 75 * n * documents // max(1, total)


def term_scores(occurrences: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term scores before its weight; it grows with the occurrences."""
    return SCALE * occurrences // (1000 * occurrences + 8 * m)


def weight(documents: int, frequency: int) -> int:
    return int(np.floor(WEIGHT_SCALE * np.log((2 * documents + 2) / (2 * frequency + 1))))


# --- the index ---------------------------------------------------------------------------------------------------------


def slices_of(hashes: np.ndarray, level: np.ndarray, rows: int) -> np.ndarray:
    """The slices of each (term, level), one row each."""
    with np.errstate(over="ignore"):
        mixed = (hashes + level.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(31)
    low, high = mixed & np.uint64(0xFFFFFFFF), (mixed >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + np.arange(SLICES, dtype=np.uint64) * high[:, None]) % np.uint64(rows)).astype(np.int64)


class Block:
    """Documents of one size class that are still to be written."""

    def __init__(self, entries: int):
        rows = BITS * entries
        room = max(8, min(BLOCK_DOCS, BLOCK_BYTES * 8 // rows // 8 * 8))
        self.matrix = np.zeros((rows, room // 8), np.uint8)
        self.numbers: list[int] = []
        self.terms: list[int] = []
        self.most: list[int] = []

    def add(self, number: int, terms: int, most: int, hashes: np.ndarray, level: np.ndarray) -> bool:
        """Whether the block is full now."""
        at = len(self.numbers)
        self.matrix[slices_of(hashes, level, len(self.matrix)).ravel(), at // 8] |= np.uint8(128 >> at % 8)
        self.numbers.append(number)
        self.terms.append(terms)
        self.most.append(most)
        return at + 1 == 8 * self.matrix.shape[1]

    def written(self) -> tuple:
        arrays = (np.array(x, np.int64).tobytes() for x in (self.numbers, self.terms, self.most))
        width = -(-len(self.numbers) // 8)
        return len(self.numbers), sum(self.terms), *arrays, self.matrix[:, :width].tobytes()


BLOCKS = "docs bigint, total bigint, numbers binary, terms binary, most binary, matrix binary"
BLOCK_COLUMNS = [c.split()[0] for c in BLOCKS.split(", ")]


def _index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    open_blocks: dict[int, Block] = {}
    for batch in batches:
        full = []
        for number, text in zip(batch["number"], batch["text"]):
            counts = Counter(terms_of(text))
            if not counts:
                continue
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, counts), np.uint64, len(counts))
            occurrences = np.fromiter(counts.values(), np.int64, len(counts))
            reached = occurrences[:, None] >= LEVELS
            of_term, level = np.nonzero(reached)
            # The next class has room for 1.4 times as many entries.
            size = int(np.ceil(2 * np.log2(len(level))))
            block = open_blocks.get(size)
            if block is None:
                block = open_blocks[size] = Block(int(np.ceil(2 ** (size / 2))))
            if block.add(number, int(occurrences.sum()), int(occurrences.max()), hashes[of_term], level):
                full.append(open_blocks.pop(size).written())
        if full:
            yield pd.DataFrame(full, columns=BLOCK_COLUMNS)
    for block in open_blocks.values():
        yield pd.DataFrame([block.written()], columns=BLOCK_COLUMNS)


class Index:
    """Blocks of signatures, under the shared folder, and the numbered texts they stand for."""

    def __init__(self, texts: DataFrame, blocks: DataFrame):
        self.texts, self.blocks = texts, blocks
        found = blocks.agg(F.sum("docs"), F.sum("total")).first()
        #: Documents with a term, and all their terms.
        self.documents, self.total = found[0] or 0, found[1] or 0


def build_index(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> Index:
    """Numbers every row, and writes the signatures of all texts that have a term."""
    bound_batches(docs.sparkSession)
    chosen = docs.select(column(docs, doc_id).alias("doc_id"), column(docs, text).alias("text"))
    texts = numbered(chosen, "number", scratch)
    blocks = texts.where("text IS NOT NULL").select("number", "text").mapInPandas(_index, BLOCKS)
    return Index(texts, scratch.keep(blocks))


# --- queries -----------------------------------------------------------------------------------------------------------


class Queries:
    """The weighted terms of each query of one block."""

    def __init__(self, counts: list[Counter], index: Index, frequency: dict[bytes, int]):
        self.documents, self.total = index.documents, index.total
        self.place: dict[bytes, int] = {}
        weights = []
        for term in dict.fromkeys(t for c in counts for t in c):
            # A term of no document scores nothing.
            if term in frequency:
                self.place[term] = len(weights)
                weights.append(weight(index.documents, frequency[term]))
        terms = list(self.place)
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))
        #: For each query, places of its terms and their weights times their number in the query.
        self.parts = []
        for count in counts:
            known = [t for t in count if t in self.place]
            at = np.fromiter((self.place[t] for t in known), np.int64, len(known))
            self.parts.append((at, np.fromiter((weights[self.place[t]] * count[t] for t in known), np.int64, len(known))))

    def chunks(self) -> Iterator[tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]]:
        """Runs of queries with not too many distinct terms together: the terms' places, and (query, places in them, weights)."""
        held: list[int] = []
        used: set[int] = set()
        for q, (at, _) in enumerate(self.parts):
            if held and len(used) + len(at) > CHUNK_TERMS:
                yield self._chunk(held, used)
                held, used = [], set()
            held.append(q)
            used.update(at.tolist())
        if used:
            yield self._chunk(held, used)

    def _chunk(self, held: list[int], used: set[int]) -> tuple[np.ndarray, list]:
        places = np.array(sorted(used), np.int64)
        return places, [(q, np.searchsorted(places, self.parts[q][0]), self.parts[q][1]) for q in held if len(self.parts[q][0])]


def bounds(block: dict, queries: Queries) -> Iterator[tuple[int, np.ndarray]]:
    """For each query that has a term, the most that each document of the block can score."""
    docs = block["docs"]
    terms, most = (np.frombuffer(block[c], np.int64) for c in ("terms", "most"))
    width = -(-docs // 8)
    matrix = np.frombuffer(block["matrix"], np.uint8).reshape(-1, width)
    m = lengths(terms, queries.documents, queries.total)
    # With so many levels reached, a term occurs less often than the next one asks for, and at most as the commonest term does.
    ceilings = np.minimum(np.append(LEVELS[1:] - 1, np.iinfo(np.int32).max)[:, None], most)
    table = np.concatenate([np.zeros((1, docs), np.int64), term_scores(ceilings, m)])
    columns = np.arange(docs)
    for places, asked in queries.chunks():
        hashes = queries.hashes[places]
        reached = np.zeros((len(places), docs), np.int8)
        alive = np.arange(len(places))
        for level in range(len(LEVELS)):
            slices = slices_of(hashes[alive], np.full(len(alive), level), len(matrix))
            bitmap = np.bitwise_and.reduce(matrix[slices], axis=1)
            some = bitmap.any(axis=1)
            alive, bitmap = alive[some], bitmap[some]
            if not len(alive):
                break
            bits = np.unpackbits(bitmap, axis=1, count=docs).view(bool)
            # Only what has reached the level below can have reached this one.
            reached[alive] += bits & (reached[alive] == level)
        for q, at, weights in asked:
            seen = np.flatnonzero(reached[at].any(axis=1))
            yield q, weights[seen] @ table[reached[at[seen]], columns]


def _first_look(queries, wanted: int):
    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The documents of each task with the highest bounds, for each query."""
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        q_of = queries.value
        for batch in batches:
            for block in batch.to_dict("records"):
                numbers = np.frombuffer(block["numbers"], np.int64)
                for q, bound in bounds(block, q_of):
                    some = np.flatnonzero(bound > 0)
                    if not len(some):
                        continue
                    had = best.get(q, (np.empty(0, np.int64), np.empty(0, np.int64)))
                    all_bounds, all_numbers = np.append(had[0], bound[some]), np.append(had[1], numbers[some])
                    order = np.lexsort((all_numbers, -all_bounds))[:wanted]
                    best[q] = all_bounds[order], all_numbers[order]
        for q, (bound, numbers) in best.items():
            yield pd.DataFrame({"query": np.full(len(bound), q, np.int32), "number": numbers, "bound": bound})

    return look


def _second_look(queries, limits):
    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Every document that some query cannot exclude, with those queries."""
        q_of, least = queries.value, limits.value
        for batch in batches:
            for block in batch.to_dict("records"):
                numbers = np.frombuffer(block["numbers"], np.int64)
                asked: list[list[int]] = [[] for _ in numbers]
                for q, bound in bounds(block, q_of):
                    for i in np.flatnonzero((bound > 0) & (bound >= least[q])).tolist():
                        asked[i].append(q)
                out = [(n, np.array(a, np.int32).tobytes()) for n, a in zip(numbers.tolist(), asked) if a]
                if out:
                    yield pd.DataFrame(out, columns=["number", "asked"])

    return look


def _rescore(queries):
    @F.pandas_udf("asked array<int>, scores array<bigint>")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        """Exact scores on the texts, for the queries that each document was asked for."""
        q_of = queries.value
        place = q_of.place
        scores = np.zeros(len(place), np.int64)
        for texts, asked_of in batches:
            out = []
            for text, asked in zip(texts, asked_of):
                terms = terms_of(text)
                counts = Counter(filter(place.__contains__, terms))
                at = np.fromiter((place[t] for t in counts), np.int64, len(counts))
                n = np.fromiter(counts.values(), np.int64, len(counts))
                scores[at] = term_scores(n, lengths(np.int64(len(terms)), q_of.documents, q_of.total))
                asked = np.frombuffer(asked, np.int32)
                out.append((asked, np.array([q_of.parts[q][1] @ scores[q_of.parts[q][0]] for q in asked.tolist()], np.int64)))
                scores[at] = 0
            yield pd.DataFrame(out, columns=["asked", "scores"])

    return score


def _frequencies(terms):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """In how many texts of the task each wanted term is."""
        wanted, found = terms.value, Counter()
        for batch in batches:
            for text in batch["text"]:
                found.update(wanted.intersection(terms_of(text)))
        if found:
            yield pd.DataFrame({"term": list(found), "n": list(found.values())})

    return count


def search(
    index: Index, items: DataFrame, scratch: Scratch, wanted: int = 10, item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """The ``wanted`` best documents of every row of ``items``: ``item_id``, ``rank``, ``doc_id``, ``score``.

    Exactly the scores of the whole texts decide, equal ones by ascending ``doc_id`` (null last). Only scores above 0
    count, so a query without a known term, or null or empty, has no rows. Every row of ``items`` is a query and every
    row of the index a document of its own, also where ids repeat or are null.

    Queries are searched for in blocks of at most ``QUERY_BYTES`` of text and ``QUERY_ROWS`` queries, or a single longer query.
    """
    spark = items.sparkSession
    chosen = items.select(column(items, item_id).alias("item_id"), column(items, text).alias("text"))
    rows = scratch.keep(chosen.where("octet_length(text) > 0").withColumn("query_row", F.monotonically_increasing_id()))
    parts = 1
    while True:
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("query_row", F.lit(parts)), F.lit(parts)).cast("int"))
        sizes = dealt.groupBy("part").agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("n"))
        too_large = sizes.where(f"(bytes > {QUERY_BYTES} OR n > {QUERY_ROWS}) AND n > 1").limit(1).count()
        if not too_large:
            break
        parts *= 2
    found = []
    for part in range(parts):
        block = dealt.where(F.col("part") == part).orderBy("query_row").collect()
        if block:
            found.append(_search(spark, index, block, scratch, wanted))
    result = f"item_id {rows.schema['item_id'].dataType.simpleString()}, rank int, doc_id {index.texts.schema['doc_id'].dataType.simpleString()}, score bigint"
    if not found:
        return spark.createDataFrame([], result)
    best = found[0]
    for other in found[1:]:
        best = best.unionByName(other)
    return best.join(rows.drop("text"), "query_row").select("item_id", "rank", "doc_id", "score")


def _search(spark: SparkSession, index: Index, block: list, scratch: Scratch, wanted: int) -> DataFrame:
    context = spark.sparkContext
    counts = [Counter(terms_of(row.text)) for row in block]
    texts = index.texts.where("text IS NOT NULL")
    terms = context.broadcast(frozenset(t for c in counts for t in c))
    in_tasks = texts.select("text").mapInPandas(_frequencies(terms), "term binary, n bigint")
    frequency = {bytes(r.term): r.n for r in in_tasks.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    queries = context.broadcast(Queries(counts, index, frequency))

    first = index.blocks.mapInPandas(_first_look(queries, wanted), "query int, number bigint, bound bigint")
    by_bound = Window.partitionBy("query").orderBy(F.desc("bound"), "number")
    first = first.withColumn("place", F.row_number().over(by_bound)).where(F.col("place") <= wanted)
    # At most so many rows for each query of the block.
    asked: dict[int, list[int]] = {}
    for row in first.select("query", "number").collect():
        asked.setdefault(row.number, []).append(row.query)
    packed = [(n, bytearray(np.array(a, np.int32).tobytes())) for n, a in asked.items()]
    first = spark.createDataFrame(packed, "number bigint, asked binary")
    scored = _scored(texts, F.broadcast(first), queries, scratch)
    limits = np.zeros(len(block), np.int64)
    enough = scored.groupBy("query").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    for row in enough.where(F.col("n") >= wanted).collect():
        limits[row.query] = row.least

    open_docs = scratch.keep(index.blocks.mapInPandas(_second_look(queries, context.broadcast(limits)), "number bigint, asked binary"))
    size = open_docs.agg(F.sum(F.octet_length("asked") + 8)).first()[0] or 0
    scored = _scored(texts, F.broadcast(open_docs) if size <= BROADCAST_BYTES else open_docs, queries, scratch)
    # Ties and all: the window keeps at most ``wanted`` rows of each query in a task before anything moves.
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "number")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= wanted)
    rows = spark.createDataFrame(list(enumerate(row.query_row for row in block)), "query int, query_row bigint")
    return ranked.join(F.broadcast(rows), "query").select("query_row", "rank", "doc_id", "score")


def _scored(texts: DataFrame, asked: DataFrame, queries, scratch: Scratch) -> DataFrame:
    """``query``, ``doc_id``, ``number`` and ``score`` above 0 of the documents that ``asked`` names."""
    found = texts.join(asked, "number").select("doc_id", "number", _rescore(queries)("text", "asked").alias("found"))
    each = found.select("doc_id", "number", F.explode(F.arrays_zip("found.asked", "found.scores")).alias("f"))
    return scratch.keep(each.select(F.col("f.asked").alias("query"), "doc_id", "number", F.col("f.scores").alias("score")).where("score > 0"))


def rank_documents(
    docs: DataFrame, items: DataFrame, wanted: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """The best documents for every row of ``items``; see ``search``. Other columns of both are not read."""
    scratch = Scratch(docs.sparkSession, "lexical-search")
    return search(build_index(docs, scratch, doc_id, text), items, scratch, wanted, item_id, text)
