"""Periodic runs of words: stretches that go on in one period, found by uniting suffixes in falling order of their common prefix.

The suffixes of a text that share their first words form a class. Going down from the longest common prefix of neighbours
in suffix order, classes are united with union-find, each keeping its positions in order. Two positions that become
neighbours when their classes meet at a common prefix of l words, d <= l apart, have the period d over l + d words, and no
smaller one (it would have put a position between them earlier). Of the pairs of one run the leftmost is kept.

Only what may seed a run of the wanted length is ever sorted: most words of a text occur once in their context.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import bound_batches, column, free_name

#: Words of texts that are sorted together; a longer text is sorted alone.
BATCH_WORDS = 1 << 18
#: Words compared at a time at first; doubled while all pairs at hand go on.
STEP, MOST_CELLS = 16, 1 << 20
#: A set is put into one this many times larger item by item, else the two are merged.
MUCH_LARGER = 64

Run = tuple[int, int, int]


def least_prefix(least_words: int, repeats: int) -> int:
    """The shortest common prefix that two places one period apart in a wanted run can have."""
    most_short = least_words // repeats
    return max(1, min(least_words - most_short, (repeats - 1) * (most_short + 1)))


def recurring_suffixes(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts whose first ``least`` items recur, in suffix order, and whether each shares them with the one before.

    Items are grouped by first 1, 2, 4, ... items; what is alone in its group is never looked at again. Every
    text ends in an item of its own, so groups end before texts do.
    """
    order = np.argsort(ids, kind="stable")
    slots, key = np.arange(len(ids)), ids[order]
    rank = np.empty(len(ids), np.int64)
    sorted_at = np.empty(len(ids), np.int64)
    width, n, shared = 1, len(ids), None
    while True:
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        group = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
        rank[order], sorted_at[slots] = group, order
        alone = fresh & np.append(fresh[1:], True)
        if width == least:
            wanted = slots[~alone]
            shared = ~fresh[~alone]
        order, slots = order[~alone], slots[~alone]
        if not len(order):
            break
        step = width if width >= least else min(width, least - width)
        key = rank[order] * n + rank[order + step]
        by_key = np.argsort(key, kind="stable")
        order, key, width = order[by_key], key[by_key], width + step
    if shared is None:
        return np.empty(0, np.int64), np.empty(0, bool)
    return sorted_at[wanted], shared


def prefixes_with_before(ids: np.ndarray, order: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """For each start in ``order``, how many items it shares with the one before (0 where nothing is shared).

    Where the items in front of both agree too, it is one less than for the start in front; the others are compared.
    """
    before = np.full(len(ids), -1, np.int64)
    before[order[1:][shared[1:]]] = order[:-1][shared[1:]]
    at = np.flatnonzero(before >= 0)
    follows = (at > 0) & (before[at] > 0)
    follows[follows] = ids[at[follows] - 1] == ids[before[at[follows]] - 1]
    first = at[~follows]
    length, active, width = np.zeros(len(first), np.int64), np.arange(len(first)), STEP
    # Past its end a text's own last item makes the difference, so nothing runs over the end of the array.
    padded = np.concatenate([ids, np.full(2 * len(ids) + STEP, -1, ids.dtype)])
    while len(active):
        left = []
        for some in np.array_split(active, -(-len(active) * width // MOST_CELLS)):
            reach = np.arange(width)
            i, j = first[some] + length[some], before[first[some]] + length[some]
            differs = padded[i[:, None] + reach] != padded[j[:, None] + reach]
            ends = differs.any(axis=1)
            length[some] += np.where(ends, differs.argmax(axis=1), width)
            left.append(some[~ends])
        active = np.concatenate(left)
        width = min(2 * width, len(ids))
    found = np.zeros(len(ids), np.int64)
    found[first] = length
    source = np.zeros(len(ids), np.int64)
    source[first] = first
    source = np.maximum.accumulate(source)
    found[at] = found[source[at]] - (at - source[at])
    return found[order]


def runs_of(ids: np.ndarray, least_words: int, repeats: int) -> list[Run]:
    """(start, length, period) of every run in the concatenated texts, in no order."""
    if len(ids) < least_words:
        return []
    least = least_prefix(least_words, repeats)
    order, shared = recurring_suffixes(ids, least)
    if not len(order):
        return []
    prefixes = prefixes_with_before(ids, order, shared)
    edges = np.flatnonzero(shared)
    edges = edges[np.argsort(-prefixes[edges], kind="stable")]
    parent = list(range(len(order)))
    members: list[list[int]] = [[p] for p in order.tolist()]
    found: list[Run] = []
    for k, common in zip(edges.tolist(), prefixes[edges].tolist()):
        a, b = k - 1, k
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if len(members[a]) < len(members[b]):
            a, b = b, a
        large, small = members[a], members[b]
        parent[b], members[b] = a, []
        if len(small) * MUCH_LARGER <= len(large):
            for p in small:
                insort(large, p)
        else:
            # Two sorted stretches: sorting is merging.
            large += small
            large.sort()
        end, last = len(large) - 1, len(small) - 1
        for t, p in enumerate(small):
            place = bisect_left(large, p)
            if place and (t == 0 or large[place - 1] != small[t - 1]):
                _seed(large[place - 1], p, common, ids, least_words, repeats, found)
            if place < end and (t == last or large[place + 1] != small[t + 1]):
                _seed(p, large[place + 1], common, ids, least_words, repeats, found)
    return found


def _seed(i: int, j: int, common: int, ids: np.ndarray, least_words: int, repeats: int, found: list[Run]) -> None:
    period = j - i
    if (repeats - 1) * period <= common and common + period >= least_words and (i == 0 or ids[i - 1] != ids[j - 1]):
        found.append((i, common + period, period))


def with_tail(ids: list[int], seed: int) -> list[int]:
    """The words of a text whose seed is divisible by ten, made periodic from some word on; others as they are."""
    n, g = len(ids), seed // 10
    if seed % 10 or not n:
        return ids
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    return ids[:start] + [ids[start + i % period] for i in range(n - start)]


def analyse(texts: Iterable[str | None], seeds: Iterable[int | None], least_words: int, repeats: int) -> Iterator[tuple]:
    """Starts, lengths and periods of each text's runs in order, the place of the strongest one, and the text without repeats."""
    held: list[list[bytes]] = []
    numbers: list[np.ndarray] = []
    total = 0
    for text, seed in zip(texts, seeds):
        words = (text or "").encode(errors="replace").split()
        if seed is not None:
            words = with_tail(words, seed)
        number = {w: i for i, w in enumerate(dict.fromkeys(words), 1)}
        ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        held.append(words)
        # No item is in two texts, and each text ends in one that occurs once.
        numbers.append(np.append(ids, 0))
        total += len(words) + 1
        if total >= BATCH_WORDS:
            yield from _analyse(held, numbers, least_words, repeats)
            held, numbers, total = [], [], 0
    if held:
        yield from _analyse(held, numbers, least_words, repeats)


def _analyse(held: list[list[bytes]], numbers: list[np.ndarray], least_words: int, repeats: int) -> Iterator[tuple]:
    sizes = np.array([len(x) for x in numbers])
    starts = np.cumsum(sizes) - sizes
    letters = np.array([x.max() + 1 for x in numbers])
    ids = np.concatenate(numbers) + np.repeat(np.cumsum(letters) - letters, sizes)
    of: dict[int, list[Run]] = {}
    for start, length, period in runs_of(ids, least_words, repeats):
        text = int(np.searchsorted(starts, start, side="right")) - 1
        of.setdefault(text, []).append((start - int(starts[text]), length, period))
    for i, words in enumerate(held):
        runs = sorted(of.get(i, ()), key=lambda r: (r[0], r[2]))
        best = None
        if runs:
            best = max(range(len(runs)), key=lambda k: (Fraction(runs[k][1], runs[k][2]), -runs[k][0], -runs[k][2]))
            stays = np.ones(len(words), bool)
            for start, length, period in runs:
                stays[start + period : start + length] = False
            words = [words[k] for k in np.flatnonzero(stays).tolist()]
        yield [r[0] for r in runs], [r[1] for r in runs], [r[2] for r in runs], best, b" ".join(words).decode()


FOUND = "starts array<bigint>, lengths array<bigint>, periods array<bigint>, best int, collapsed string"


def find_runs(
    docs: DataFrame, text: str = "text", least_words: int = 24, repeats: int = 3, seed: Column | None = None
) -> DataFrame:
    """``docs`` with ``runs``, ``strongest`` and ``collapsed_text``.

    Words are what ASCII white space separates, and numbered from 0. ``runs`` has every stretch (start, length, period) with
    smallest period q (words q apart are equal) of at least ``least_words`` and ``repeats * q`` words that no neighbouring word
    extends, by start, then period. ``strongest`` is the one of the greatest length to period, exactly (ties: smallest start,
    then period), null if there is none. ``collapsed_text`` has the words joined by single spaces, without those that some
    run contains after its first q words.

    Null, empty and blank texts have no words, no runs and an empty collapsed text; a null seed changes nothing. Each row
    stands for itself, so repeated rows and ids are fine, and nothing is shuffled. Whole texts are read. Names that
    clash get underscores added. ``seed``, an unsigned number for each row, makes the words of rows whose seed is
    divisible by ten periodic first (see ``with_tail``).
    """
    if repeats < 2 or least_words < repeats:
        raise ValueError("a run has at least two periods, and at least as many words as periods")
    bound_batches(docs.sparkSession)

    @F.pandas_udf(FOUND)
    def runs(texts: pd.Series, seeds: pd.Series) -> pd.DataFrame:
        seeds = [None if pd.isna(s) else int(s) for s in seeds]
        out = pd.DataFrame(analyse(texts, seeds, least_words, repeats), columns=[c.split()[0] for c in FOUND.split(", ")])
        return out.astype({"best": "Int32"})

    done, runs_name, strongest, collapsed = free_name(docs, "done", "runs", "strongest", "collapsed_text")
    # Seeds are small or absent; a double would be exact as well, but text keeps null apart from 0.
    given = F.lit(None).cast("string") if seed is None else seed.cast("bigint").cast("string")
    out = docs.withColumn(done, runs(column(docs, text), given))
    found = F.col(done)
    zipped = F.arrays_zip(found["starts"].alias("start"), found["lengths"].alias("length"), found["periods"].alias("period"))
    kind = "array<struct<start: bigint, length: bigint, period: bigint>>"
    out = out.withColumn(runs_name, zipped.cast(kind))
    out = out.withColumns({strongest: F.get(F.col(runs_name), found["best"]), collapsed: found["collapsed"]})
    return out.drop(done)
