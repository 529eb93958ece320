"""Near copies by the Jaccard similarity of word shingles: SimHash proposes, bands add what lies farther apart, the texts decide."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import Scratch, bound_batches, column, components, free_name, numbered
from clickweave.llm.simhash import fingerprint, near_prints

#: A band is the minima of ``ROWS`` hash functions. At a similarity of 0.8 two texts share no band once in 350,000 pairs.
BANDS, ROWS = 42, 6
SEED = 42
#: Shingles hashed at a time, which bounds the memory for a long text.
BLOCK = 512
#: Documents in a group that are compared in one task, and bytes of their texts; a larger one is compared band key by band key.
GROUP_ROWS, GROUP_BYTES = 20_000, 128 << 20

_draw = np.random.default_rng(SEED)
FLIPS = _draw.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64)
FACTORS = _draw.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64) | np.uint64(1)
MIXES = _draw.integers(0, 1 << 64, (BANDS, ROWS), np.uint64) | np.uint64(1)


def shingles_of(text: str | None, words: int) -> np.ndarray:
    """Distinct XXH64 of the shingles; A-Z are lower-cased, words are what ASCII white space separates, fewer words make one."""
    parts = text.encode().lower().split() if text else []
    if len(parts) <= words:
        shingles = [b" ".join(parts)]
    else:
        shingles = map(b" ".join, zip(*(parts[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s, SEED) for s in shingles), np.uint64, max(1, len(parts) - words + 1)))


def band_keys_of(shingles: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), BLOCK):
        part = (shingles[at : at + BLOCK] ^ FLIPS) * FACTORS
        np.minimum(least, part.min(axis=1), out=least)
    least ^= least >> np.uint64(32)
    return (least.reshape(BANDS, ROWS) * MIXES).sum(axis=1, dtype=np.uint64).view(np.int64)


def band_keys(text: Column, words: int) -> Column:
    @F.pandas_udf("array<bigint>")
    def keys(texts: pd.Series) -> pd.Series:
        return pd.Series([band_keys_of(shingles_of(t, words)) for t in texts], dtype=object)

    return keys(text)


def links_among(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Links that join the sets as all pairs with a Jaccard similarity of ``least`` would; fewer than there are sets."""
    sizes = np.array([len(s) for s in sets])
    ids, flat = np.unique(np.concatenate(sets), return_inverse=True)
    parts = np.split(flat, np.cumsum(sizes)[:-1])
    marked, links, waiting = np.zeros(len(ids), bool), [], np.arange(len(sets))
    while len(waiting):
        front, waiting = [waiting[0]], waiting[1:]
        held = None
        while front and len(waiting):
            at = front.pop()
            if held is None:
                held = np.concatenate([parts[w] for w in waiting])
                starts = np.cumsum(sizes[waiting]) - sizes[waiting]
            marked[parts[at]] = True
            common = np.add.reduceat(marked[held], starts, dtype=np.int64)
            marked[parts[at]] = False
            near = common / (sizes[at] + sizes[waiting] - common) >= least
            if near.any():
                links += [(int(at), int(x)) for x in waiting[near]]
                front += waiting[near].tolist()
                waiting, held = waiting[~near], None
    return links


def _links(words: int, least: float):
    def link(group: pd.DataFrame) -> pd.DataFrame:
        rows = group["row"].to_numpy()
        found = links_among([shingles_of(t, words) for t in group["text"]], least)
        return pd.DataFrame([(rows[i], rows[j]) for i, j in found], columns=["a", "b"], dtype="int64")

    return link


def print_keys(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """A ``key`` for each distinct fingerprint in ``print``, the same for all that links within three bits connect."""
    begun = scratch.count
    links = scratch.keep(near_prints(prints))
    roots = components(links, scratch)
    # Another kind of key than those of the bands, so it is hashed apart from them.
    key = F.xxhash64(F.lit("print"), F.coalesce("root", "print")).alias("key")
    keys = scratch.keep(prints.join(roots, F.col("print") == F.col("node"), "left").select("print", key))
    scratch.drop(*range(begun + 1, scratch.count))
    return keys


def similar_rows(texts: DataFrame, words: int, least: float, scratch: Scratch) -> DataFrame:
    """Verified links ``a``, ``b`` between rows of ``texts`` (``row``, ``text``), enough to connect all similar ones.

    Rows that share a key are candidates: the component of their SimHash fingerprints, linked within three bits, or a band, which
    also meets similar rows whose fingerprints lie farther apart. Each key points to its first row; what is connected that way is put
    into one group, and a group's texts are compared in one task, so texts move once and pairs never leave a task.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")
    text = F.col("text")
    hashed = scratch.keep(texts.select("row", size, fingerprint(text, words).alias("print"), band_keys(text, words).alias("keys")))
    of_print = print_keys(scratch.keep(hashed.select("print").distinct()), scratch)
    dealt = hashed.select("row", "size", F.explode(F.array_distinct("keys")).alias("key")).union(
        hashed.join(of_print, "print").select("row", "size", "key")
    )
    firsts = dealt.groupBy("key").agg(F.min("row").alias("first"), F.max("row").alias("last"))
    firsts = scratch.keep(firsts.where("first < last").select("key", "first"))
    shared = scratch.keep(dealt.join(firsts, "key").select("row", "size", "first", "key"))
    roots = components(shared.select(F.col("row").alias("a"), F.col("first").alias("b")), scratch)
    rows = shared.select("row", "size").distinct().join(roots, F.col("row") == F.col("node"), "left")
    rows = scratch.keep(rows.select("row", "size", F.coalesce("root", "row").alias("cluster")))
    wide = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    wide = scratch.keep(wide.where((F.col("n") > GROUP_ROWS) | (F.col("bytes") > GROUP_BYTES)).select("cluster"))
    # There are few: one for so many rows or bytes. Spark broadcasts them if the file is small.
    by_cluster = rows.join(wide, "cluster", "left_anti").select("row", F.lit(False).alias("wide"), F.col("cluster").alias("group"))
    of_wide = rows.join(wide, "cluster", "left_semi").select("row")
    by_key = shared.join(of_wide, "row").select("row", F.lit(True).alias("wide"), F.col("key").alias("group"))
    members = scratch.keep(by_cluster.union(by_key))
    groups = texts.join(members, "row").groupBy("wide", "group")
    return groups.applyInPandas(_links(words, least), "a bigint, b bigint")


def near_copies(
    docs: DataFrame, text: str = "text", order: str = "doc_id", words: int = 5, least: float = 0.8, row: str | None = None
) -> DataFrame:
    """``docs`` without the text, with ``component_id`` and ``kept`` for each row.

    Rows are linked if the sets of their ``words``-word shingles have a Jaccard similarity of at least ``least``, which is
    counted on the texts for every link. Texts without words, null and empty ones included, have one empty shingle and
    are near copies of each other; repeated rows are copies. ``component_id`` is the smallest ``order`` reachable over links, the row
    itself included; ``kept`` marks one row of each component, of smallest ``order`` (a null one is larger than any).
    ``row`` names a bigint column that tells rows apart and reads the same each time; without it rows are numbered by
    ``numbered``. Every row comes out once.
    """
    bound_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "near-copies")
    if own := row is None:
        row = free_name(docs, "row")
        docs = numbered(docs, row, scratch)
    component, kept, root, best = free_name(docs, "component_id", "kept", "root", "best")
    texts = docs.select(column(docs, row).alias("row"), column(docs, text).alias("text"))
    begun = scratch.count
    links = scratch.keep(similar_rows(texts, words, least, scratch))
    scratch.drop(*range(begun + 1, scratch.count))
    roots = components(links, scratch)
    labelled = docs.drop(text).join(roots.select(F.col("node").alias(row), F.col("root").alias(root)), row, "left")
    labelled = scratch.keep(labelled.withColumn(root, F.coalesce(F.col(root), F.col(row))))
    first = F.min(F.struct(F.col(order).isNull().alias("n"), F.col(order).alias("o"), F.col(row).alias("r")))
    bests = labelled.groupBy(root).agg(first.alias(best))
    out = labelled.join(bests, root).withColumns({component: F.col(best)["o"], kept: F.col(best)["r"] == F.col(row)})
    return out.drop(best, root, *[row] * own)
