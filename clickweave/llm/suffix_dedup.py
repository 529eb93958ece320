"""Removal of long byte strings that occur again anywhere, decided by suffix arrays of shards.

A *window* is a string of ``length`` bytes. Its *anchor* is the smallest hash of its ``ANCHOR``-byte substrings, so
equal windows have equal anchors, and neighbouring windows mostly share theirs: a text falls into *segments*, runs of
windows with one anchor, and each window is in exactly one. Grouping segments by anchor brings equal windows together
without moving a byte of those whose anchor occurs once. Equal segments are combined into one *content* with a
count before any bytes move. What is left, different contents with one anchor, is put into shards; each shard is sorted
by induced sorting, and windows whose permuted common prefix with a neighbour reaches ``length`` recur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import Scratch, bound_batches, column, free_name, numbered
from clickweave.llm.suffix_array import common_prefixes, suffix_array

ANCHOR = 96
#: Windows in one segment at most; a longer run (a text that repeats a few bytes) is cut.
SEGMENT_WINDOWS = 2048
#: Bytes of contents that a shard is meant to hold. One anchor's contents stay together up to ``GROUP_CONTENTS``.
SHARD_BYTES = 1 << 19
#: Tasks that sort shards at most; beyond, a task sorts several, one after another.
MOST_TASKS = 100_000
GROUP_CONTENTS = 1024

# An odd base for rolling hashes and an odd factor that mixes them.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)

SEGMENTS = "row bigint, start bigint, bytes int, anchor bigint, c1 bigint, c2 bigint, looped boolean"
RUNS = "anchor bigint, c1 bigint, c2 bigint, run_from int, run_to int"


def substring_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every substring of ``size`` bytes, put together from those of powers of two."""
    power, width, total, done = data.astype(np.uint64) + np.uint64(1), 1, None, 0
    base = BASE
    with np.errstate(over="ignore"):
        while True:
            if size & width:
                if total is None:
                    total = power
                else:
                    n = len(data) - done - width + 1
                    total = total[:n] * base + power[done : done + n]
                done += width
            if done == size:
                break
            power = power[:-width] * base + power[width:]
            base, width = base * base, width * 2
        total = (total ^ (total >> np.uint64(32))) * MIX
        return total ^ (total >> np.uint64(29))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def same_anchor(items: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Start, size and anchor of the segments of at least ``length`` items, and the hashes of all its substrings."""
    hashes = substring_hashes(items, anchor)
    lowest = sliding_minimum(hashes, length - anchor + 1)
    starts = np.flatnonzero(np.concatenate([[True], lowest[1:] != lowest[:-1]]))
    sizes = np.diff(np.append(starts, len(lowest)))
    if sizes.max() > SEGMENT_WINDOWS:
        parts = -(-sizes // SEGMENT_WINDOWS)
        steps = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        ends = np.repeat(starts + sizes, parts)
        starts = np.repeat(starts, parts) + steps * SEGMENT_WINDOWS
        sizes = np.minimum(SEGMENT_WINDOWS, ends - starts)
    return starts, sizes + length - 1, lowest[starts], hashes


def segments_of(data: bytes, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Start, bytes and anchor of the segments of a text of at least ``length`` bytes, and whether the anchor is in one twice."""
    starts, sizes, anchors, hashes = same_anchor(np.frombuffer(data, np.uint8), length, anchor)
    ends = starts + sizes - anchor + 1
    # Only where its anchor is in it twice can a segment hold a window twice.
    looped = [np.count_nonzero(hashes[s:e] == a) > 1 for s, e, a in zip(starts.tolist(), ends.tolist(), anchors)]
    return starts, sizes, anchors.view(np.int64), np.array(looped)


def _segments(length: int, anchor: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in SEGMENTS.split(", ")]
        for batch in batches:
            parts: list[list] = [[] for _ in names]
            for row, text in zip(batch["row"], batch["text"]):
                data = text.encode()
                if len(data) < length:
                    continue
                starts, sizes, anchors, looped = segments_of(data, length, anchor)
                view, digest = memoryview(data), xxhash.xxh3_128_digest
                digests = b"".join([digest(view[s : s + n]) for s, n in zip(starts.tolist(), sizes.tolist())])
                pairs = np.frombuffer(digests, np.int64).reshape(-1, 2)
                columns = (starts, sizes, anchors, pairs[:, 0], pairs[:, 1], looped)
                for part, value in zip(parts, (np.full(len(starts), row), *columns)):
                    part.append(value)
            if parts[0]:
                yield pd.DataFrame({name: np.concatenate(part) for name, part in zip(names, parts)})

    return cut


def repeated_runs(contents: list[bytes], counts: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    """For each content, the byte runs covered by windows that occur again in it, in another one, or in a copy of it."""
    pieces, starts, at = [], [], 0
    separator, end = np.array([1], np.uint16), np.array([0], np.uint16)
    for data in contents:
        pieces += [np.frombuffer(data, np.uint8).astype(np.uint16) + np.uint16(2), separator]
        starts.append(at)
        at += len(data) + 1
    text = np.concatenate([*pieces, end])
    room = np.zeros(len(text), np.int64)
    for s, data in zip(starts, contents):
        room[s : s + len(data)] = np.arange(len(data), 0, -1)
    prefixes, before = common_prefixes(text, suffix_array(text, 258), room)
    again = np.flatnonzero(prefixes >= length)
    marked = np.zeros(len(text), bool)
    marked[again] = True
    marked[before[again]] = True
    found = []
    for s, data, count in zip(starts, contents, counts.tolist()):
        flags = np.flatnonzero(marked[s : s + len(data)]) if count == 1 else np.arange(len(data) - length + 1)
        if not len(flags):
            found.append([])
            continue
        # Windows that touch or overlap cover one run.
        breaks = np.flatnonzero(np.diff(flags) > length)
        firsts, lasts = flags[np.append(0, breaks + 1)], flags[np.append(breaks, len(flags) - 1)]
        found.append(list(zip(firsts.tolist(), (lasts + length).tolist())))
    return found


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the wanted segments of each text."""
    for batch in batches:
        out = []
        for text, wanted in zip(batch["text"], batch["wanted"]):
            data = text.encode()
            for w in wanted:
                out.append((w["anchor"], w["c1"], w["c2"], w["n"], w["hot"], data[w["start"] : w["start"] + w["bytes"]]))
        yield pd.DataFrame(out, columns=["anchor", "c1", "c2", "n", "hot", "data"])


def _sort_shard(length: int):
    def sort(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        runs = repeated_runs(shard["data"].tolist(), shard["n"].to_numpy(), length)
        out = [
            (anchor, c1, c2, a, b)
            for anchor, c1, c2, found in zip(shard["anchor"], shard["c1"], shard["c2"], runs)
            for a, b in found
        ]
        return pd.DataFrame(out, columns=["anchor", "c1", "c2", "run_from", "run_to"])

    return sort


def _windows(length: int):
    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Every window of a hot anchor's contents, by digest."""
        for batch in batches:
            for anchor, c1, c2, n, data in zip(*(batch[c] for c in ("anchor", "c1", "c2", "n", "data"))):
                size, view, digest = len(data) - length + 1, memoryview(data), xxhash.xxh3_128_digest
                digests = b"".join([digest(view[i : i + length]) for i in range(size)])
                pairs = np.frombuffer(digests, np.int64).reshape(-1, 2)
                fixed = {"anchor": anchor, "c1": c1, "c2": c2, "n": n}
                yield pd.DataFrame({**fixed, "at": np.arange(size), "w1": pairs[:, 0], "w2": pairs[:, 1]})

    return windows


#: Joins sorted runs that touch or overlap.
MERGE = """
explode(aggregate(runs, cast(array() AS array<struct<run_from: int, run_to: int>>), (done, r) ->
  CASE WHEN size(done) > 0 AND element_at(done, -1).run_to >= r.run_from
       THEN concat(slice(done, 1, size(done) - 1),
                   array(named_struct('run_from', element_at(done, -1).run_from,
                                      'run_to', greatest(element_at(done, -1).run_to, r.run_to))))
       ELSE concat(done, array(r)) END))
"""


def repeated_intervals(docs: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """``row``, ``first``, ``last``: covered bytes [first, last) of each text; overlapping ones are not merged yet.

    ``docs`` has ``row`` (distinct) and ``text`` (not null).
    """
    content = ["anchor", "c1", "c2"]
    long_enough = docs.where(F.octet_length("text") >= length)
    segments = scratch.keep(long_enough.mapInPandas(_segments(length, ANCHOR), SEGMENTS))
    contents = segments.groupBy(*content).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "start", "bytes")).alias("sample"), F.max("looped").alias("looped")
    )
    anchors = contents.groupBy("anchor").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    alive = scratch.keep(contents.join(anchors, "anchor").where("total > 1 OR looped").drop("total"))
    alive_at = scratch.count
    # Where an anchor has one content, that content recurs whole.
    whole = alive.where("kinds = 1 AND n > 1").select(*content, F.lit(0).alias("run_from"), F.col("sample.bytes").alias("run_to"))

    hot = (F.col("kinds") > GROUP_CONTENTS).alias("hot")
    wanted = alive.where("kinds > 1 OR n = 1").select(
        F.col("sample.row").alias("row"),
        F.struct(*content, "n", hot, F.col("sample.start").alias("start"), F.col("sample.bytes").alias("bytes")).alias("w"),
    )
    wanted = scratch.keep(wanted.groupBy("row").agg(F.collect_list("w").alias("wanted")))
    slices = scratch.keep(
        docs.join(wanted, "row")
        .select("text", "wanted")
        .mapInPandas(_slices, "anchor bigint, c1 bigint, c2 bigint, n bigint, hot boolean, data binary")
    )
    slices_at = scratch.count
    scratch.drop(slices_at - 1)
    cold = slices.where("NOT hot")
    size = cold.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    # A task for each shard: merged by size, a few tasks would sort all of them.
    dealt = cold.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).repartition(min(shards, MOST_TASKS), "shard")
    sorted_runs = scratch.keep(dealt.groupBy("shard").applyInPandas(_sort_shard(length), RUNS))

    # An anchor with more contents than a task should sort: its windows are counted by digest, each on its own.
    window = ["anchor", "w1", "w2"]
    windows = scratch.keep(
        slices.where("hot").mapInPandas(
            _windows(length), "anchor bigint, c1 bigint, c2 bigint, n bigint, at int, w1 bigint, w2 bigint"
        )
    )
    again = scratch.keep(windows.groupBy(*window).agg(F.sum("n").alias("times")).where("times > 1").drop("times"))
    run = F.struct(F.col("at").alias("run_from"), (F.col("at") + length).alias("run_to"))
    hot_runs = windows.join(again, window).groupBy(*content).agg(F.sort_array(F.collect_list(run)).alias("runs"))
    hot_runs = hot_runs.select(*content, F.expr(MERGE).alias("r")).select(*content, "r.run_from", "r.run_to")

    runs = scratch.keep(whole.union(sorted_runs).union(hot_runs))
    scratch.drop(alive_at, *range(slices_at, scratch.count))
    return segments.select(*content, "row", "start").join(runs, content).select(
        "row", (F.col("start") + F.col("run_from")).alias("first"), (F.col("start") + F.col("run_to")).alias("last")
    )


def merge(firsts: np.ndarray, lasts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the union."""
    out: list[list[int]] = []
    for a, b in sorted(zip(firsts, lasts)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(int(a), int(b)) for a, b in out]


def cut_out(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in runs:
        kept.append(data[at:a])
        at = b
    return b"".join([*kept, data[at:]])


def whole_characters(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without the characters that they cut in half."""
    out = []
    for a, b in runs:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if b > a:
            out.append((a, b))
    return out


FINISHED = "n_bytes bigint, n_removed bigint, n_kept bigint, n_spans bigint, kept_sha256 string"


def _finish(keep_text: bool):
    from clickweave.llm.passages import word_edges

    names = [field.split()[0] for field in FINISHED.split(", ")] + ["kept_text"] * keep_text

    @F.pandas_udf(FINISHED + ", kept_text string" * keep_text)
    def finish(texts: pd.Series, firsts: pd.Series, lasts: pd.Series, in_words: pd.Series) -> pd.DataFrame:
        out = []
        for text, first, last, by_word in zip(texts, firsts, lasts, in_words):
            data = text.encode()
            if first is not None and by_word.any():
                starts, ends = word_edges(data)
                by_word = by_word.astype(bool)
                # Words that touch are one passage, with what is between them.
                pairs = np.array(merge(first[by_word], last[by_word]))
                first = np.concatenate([first[~by_word], starts[pairs[:, 0]]])
                last = np.concatenate([last[~by_word], ends[pairs[:, 1] - 1]])
            runs = [] if first is None else merge(first, last)
            kept = cut_out(data, runs)
            done = (len(data), len(data) - len(kept), len(kept), len(runs), hashlib.sha256(kept).hexdigest())
            if keep_text:
                done += (cut_out(data, whole_characters(data, runs)).decode() if runs else text,)
            out.append(done)
        return pd.DataFrame(out, columns=names)

    # Else a filter on what it returns is pushed below it, and evaluates it again with a second Python worker for every task.
    return finish.asNondeterministic()


def remove_repeats(
    docs: DataFrame, length: int = 400, text: str = "text", keep_text: bool = True, least_words: int | None = None
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_kept``, ``n_spans``, ``kept_sha256`` and, in place of the text, what is left of it.

    Every byte is removed that is covered by a string of ``length`` bytes which starts anywhere else too, in the
    same text or another; the first occurrence is not spared, and strings are judged on the input. Matches do not cross
    texts; with ``least_words``, passages of that many words that recur (see ``passages``) are removed as well,
    however few bytes they have. A null text is empty; repeated rows are repeats of each other; an empty table gives an empty one. ``kept_sha256`` is over the remaining
    bytes; the text also keeps characters that a removed run would cut in half. Without ``keep_text`` the
    column is dropped. Names that clash get underscores added. Rows are numbered by ``numbered``; of the tables written on the
    way the last one stays, which the result reads.
    """
    bound_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "suffix-dedup")
    row, spans, done = free_name(docs, "row", "spans", "done")
    docs = numbered(docs, row, scratch)
    begun = scratch.count
    value = F.coalesce(column(docs, text), F.lit(""))
    texts = docs.select(F.col(row).alias("row"), value.alias("text"))
    found = repeated_intervals(texts, length, scratch).withColumn("in_words", F.lit(False))
    if least_words is not None:
        from clickweave.llm.passages import repeated_passages

        # Written first, so that the tables behind them can go.
        found = scratch.keep(found)
        scratch.drop(*range(begun + 1, scratch.count))
        passages = repeated_passages(texts, least_words, scratch).withColumn("in_words", F.lit(True))
        found = found.unionByName(passages)
    found = scratch.keep(
        found.groupBy(F.col("row").alias(row)).agg(F.collect_list(F.struct("first", "last", "in_words")).alias(spans))
    )
    scratch.drop(*range(begun + 1, scratch.count))
    out = docs.join(found, row, "left").withColumn(
        done, _finish(keep_text)(F.coalesce(F.col(text), F.lit("")), F.col(f"{spans}.first"), F.col(f"{spans}.last"), F.col(f"{spans}.in_words"))
    )
    keys = ("n_bytes", "n_removed", "n_kept", "n_spans", "kept_sha256")
    out = out.withColumns({n: F.col(done)[k] for n, k in zip(free_name(docs, *keys), keys)})
    out = out.withColumn(text, F.col(done)["kept_text"]) if keep_text else out.drop(text)
    return out.drop(row, spans, done)
