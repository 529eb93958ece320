"""Passages of many words that occur again anywhere, found as ``suffix_dedup`` finds bytes, over word ids.

A word is what ASCII white space separates, and its id the XXH64 of its bytes. A window is ``length`` words in a row; it recurs
if it occurs in two texts, or at two places of one text that do not overlap (a text that goes on in a short period
is not a copy of itself). All occurrences of a window that recurs are covered. Texts fall into segments of windows with one
anchor; equal segments are combined, those of anchors that occur once stay out, and the others are put into shards,
whose suffixes are sorted by their first ``length`` words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import Scratch
from clickweave.llm.suffix_array import prefix_ranks
from clickweave.llm.suffix_dedup import MERGE, MOST_TASKS, same_anchor

#: Words in an anchor.
ANCHOR = 8
#: Words of contents that a shard is meant to hold.
SHARD_WORDS = 1 << 17
#: An anchor with more different contents is not sorted in one task.
GROUP_CONTENTS = 1024

SEGMENTS = "row bigint, start int, words int, anchor bigint, c1 bigint, c2 bigint"
RUNS = "anchor bigint, c1 bigint, c2 bigint, run_from int, run_to int"
PLACES = "row_lo bigint, row_hi bigint, at_lo int, at_hi int"
LOWS, HIGHS = ("row_lo", "at_lo"), ("row_hi", "at_hi")


def word_edges(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts and ends, as ``bytes.split`` has them."""
    text = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], (text != 32) & ((text < 9) | (text > 13)), [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_ids(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _segments(length: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in SEGMENTS.split(", ")]
        for batch in batches:
            parts: list[list] = [[] for _ in names]
            for row, text in zip(batch["row"], batch["text"]):
                words = text.encode().split()
                if len(words) < length:
                    continue
                ids = word_ids(words)
                starts, sizes, anchors, _ = same_anchor(ids, length, ANCHOR)
                view, digest = memoryview(ids.tobytes()), xxhash.xxh3_128_digest
                digests = b"".join([digest(view[8 * s : 8 * (s + n)]) for s, n in zip(starts.tolist(), sizes.tolist())])
                pairs = np.frombuffer(digests, np.int64).reshape(-1, 2)
                columns = (np.full(len(starts), row), starts, sizes, anchors.view(np.int64), pairs[:, 0], pairs[:, 1])
                for part, value in zip(parts, columns):
                    part.append(value)
            if parts[0]:
                yield pd.DataFrame({name: np.concatenate(part) for name, part in zip(names, parts)})

    return cut


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The word ids of the wanted segments of each text."""
    fixed = ["anchor", "c1", "c2", *LOWS, *HIGHS, "hot"]
    for batch in batches:
        out = []
        for text, wanted in zip(batch["text"], batch["wanted"]):
            words = text.encode().split()
            for w in wanted:
                ids = word_ids(words[w["start"] : w["start"] + w["words"]])
                out.append((*[w[c] for c in fixed], ids.tobytes()))
        yield pd.DataFrame(out, columns=[*fixed, "data"])


def repeated_runs(contents: list[np.ndarray], places: dict[str, np.ndarray], length: int) -> list[list[tuple[int, int]]]:
    """For each content, the runs of words covered by windows that recur; ``places`` are the extremes of where it occurs."""
    sizes = np.array([len(c) for c in contents])
    owner, at = np.repeat(np.arange(len(contents)), sizes), np.arange(sizes.sum())
    within = at - np.repeat(np.cumsum(sizes) - sizes, sizes)
    whole = np.flatnonzero(within + length <= sizes[owner])
    ranks = prefix_ranks(np.concatenate(contents), length)[whole]
    order = np.argsort(ranks, kind="stable")
    ranks, whole = ranks[order], whole[order]
    edges = np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]]))
    of, shift = owner[whole], within[whole]
    rows = np.maximum.reduceat(places["row_hi"][of], edges) > np.minimum.reduceat(places["row_lo"][of], edges)
    apart = np.maximum.reduceat(places["at_hi"][of] + shift, edges) - np.minimum.reduceat(places["at_lo"][of] + shift, edges)
    recurs = np.repeat(rows | (apart >= length), np.diff(np.append(edges, len(whole))))
    found: list[list[tuple[int, int]]] = [[] for _ in contents]
    last_owner = last = -1
    for p in np.sort(whole[recurs]).tolist():
        c, w = int(owner[p]), int(within[p])
        if c == last_owner and w <= last:
            found[c][-1] = (found[c][-1][0], w + length)
        else:
            found[c].append((w, w + length))
        last_owner, last = c, w + length
    return found


def _sort_shard(length: int):
    def sort(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        contents = [np.frombuffer(d, np.uint64) for d in shard["data"]]
        runs = repeated_runs(contents, {c: shard[c].to_numpy() for c in (*LOWS, *HIGHS)}, length)
        out = [(anchor, c1, c2, a, b) for anchor, c1, c2, found in zip(shard["anchor"], shard["c1"], shard["c2"], runs) for a, b in found]
        return pd.DataFrame(out, columns=["anchor", "c1", "c2", "run_from", "run_to"])

    return sort


def _windows(length: int):
    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Every window of a hot anchor's contents, by digest."""
        fixed = ["anchor", "c1", "c2", *LOWS, *HIGHS]
        for batch in batches:
            for *values, data in zip(*(batch[c] for c in (*fixed, "data"))):
                size, view, digest = len(data) // 8 - length + 1, memoryview(data), xxhash.xxh3_128_digest
                digests = b"".join([digest(view[8 * i : 8 * (i + length)]) for i in range(size)])
                pairs = np.frombuffer(digests, np.int64).reshape(-1, 2)
                yield pd.DataFrame({**dict(zip(fixed, values)), "at": np.arange(size), "w1": pairs[:, 0], "w2": pairs[:, 1]})

    return windows


def repeated_passages(docs: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """``row``, ``first``, ``last``: covered words [first, last) of each text; overlapping ones are not merged yet.

    ``docs`` has ``row`` (distinct, the same each time it is read) and ``text`` (not null).
    """
    content = ["anchor", "c1", "c2"]
    # Words of one byte and white space between them.
    long_enough = docs.where(F.octet_length("text") >= 2 * length - 1)
    segments = scratch.keep(long_enough.mapInPandas(_segments(length), SEGMENTS))
    contents = segments.groupBy(*content).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("row", "start", "words")).alias("sample"),
        F.min("row").alias("row_lo"),
        F.max("row").alias("row_hi"),
        F.min("start").alias("at_lo"),
        F.max("start").alias("at_hi"),
    )
    anchors = contents.groupBy("anchor").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    # A segment that holds its anchor once is shorter than two windows.
    alive = contents.join(anchors, "anchor").where(f"total > 1 OR sample.words >= {2 * length}").drop("total", "n")
    alive = scratch.keep(alive)
    alive_at = scratch.count
    # Where an anchor has one content, which several texts have, that content recurs whole.
    only = F.expr("kinds = 1 AND row_lo < row_hi")
    whole = alive.where(only).select(*content, F.lit(0).alias("run_from"), F.col("sample.words").alias("run_to"))

    hot = (F.col("kinds") > GROUP_CONTENTS).alias("hot")
    wanted = alive.where(~only).select(
        F.col("sample.row").alias("row"), F.struct(*content, *LOWS, *HIGHS, hot, "sample.start", "sample.words").alias("w")
    )
    wanted = scratch.keep(wanted.groupBy("row").agg(F.collect_list("w").alias("wanted")))
    slices = docs.join(wanted, "row").select("text", "wanted")
    slices = scratch.keep(
        slices.mapInPandas(_slices, f"anchor bigint, c1 bigint, c2 bigint, {PLACES}, hot boolean, data binary")
    )
    slices_at = scratch.count
    scratch.drop(slices_at - 1)
    cold = slices.where("NOT hot")
    size = cold.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    shards = max(1, -(-size // (8 * SHARD_WORDS)))
    dealt = cold.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).repartition(min(shards, MOST_TASKS), "shard")
    sorted_runs = scratch.keep(dealt.groupBy("shard").applyInPandas(_sort_shard(length), RUNS))

    # An anchor with more contents than a task should sort: its windows are counted by digest, each on its own.
    window = ["anchor", "w1", "w2"]
    windows = scratch.keep(
        slices.where("hot").mapInPandas(
            _windows(length), f"anchor bigint, c1 bigint, c2 bigint, {PLACES}, at int, w1 bigint, w2 bigint"
        )
    )
    places = (F.min("row_lo").alias("lo"), F.max("row_hi").alias("hi"), (F.max(F.expr("at_hi + at")) - F.min(F.expr("at_lo + at"))).alias("apart"))
    again = scratch.keep(windows.groupBy(*window).agg(*places).where(f"lo < hi OR apart >= {length}").select(*window))
    run = F.struct(F.col("at").alias("run_from"), (F.col("at") + length).alias("run_to"))
    hot_runs = windows.join(again, window).groupBy(*content).agg(F.sort_array(F.collect_list(run)).alias("runs"))
    hot_runs = hot_runs.select(*content, F.expr(MERGE).alias("r")).select(*content, "r.run_from", "r.run_to")

    runs = scratch.keep(whole.union(sorted_runs).union(hot_runs))
    scratch.drop(alive_at, *range(slices_at, scratch.count))
    return segments.select(*content, "row", "start").join(runs, content).select(
        "row", (F.col("start") + F.col("run_from")).alias("first"), (F.col("start") + F.col("run_to")).alias("last")
    )
