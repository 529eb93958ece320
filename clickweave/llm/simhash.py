"""Near duplicates by SimHash: fingerprints of word shingles, linked within a few bits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import Scratch, bound_batches, column, components, free_name

BITS = 64
SEED = 42
#: Shingles whose bits are counted at a time, which bounds the memory for a long text.
BLOCK = 1 << 16


def fingerprint_of(text: str | None, words: int) -> int:
    parts = text.encode().lower().split() if text else []
    if not parts:
        return 0
    if len(parts) <= words:
        shingles = [b" ".join(parts)]
    else:
        shingles = map(b" ".join, zip(*(parts[i:] for i in range(words))))
    digest, counts, n = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), max(1, len(parts) - words + 1)
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, n)
    for at in range(0, n, BLOCK):
        # Big-endian bytes, so that unpacked bits run from the highest to the lowest.
        part = hashes[at : at + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprint(text: Column, words: int = 3) -> Column:
    """64-bit SimHash, as a signed bigint, of the ``words``-word shingles of ``text``.

    A-Z are lower-cased and words are what ASCII white space separates; repeated shingles count again.
    Fewer words make one shingle; none, an empty or a null text give zero. A bit is set if it is set in
    more than half of the shingles' XXH64 (seed 42).
    """

    @F.pandas_udf("bigint")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, words) for t in texts], dtype="int64")

    return prints(text)


def masks(radius: int) -> list[int]:
    """The bits split into ``radius`` blocks, as masks."""
    edges = [BITS * i // radius for i in range(radius + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def variants(prints: DataFrame, radius: int) -> DataFrame:
    """(mask, key, print) for every fingerprint: its ball of radius ``(radius - 1) // 2`` outside each mask.

    For an odd radius of 3, half of it is one bit and a half. Of three differing bits, the mask takes up the middle
    one: there are three masks, some mask covers at least one of the differing bits, and the one or two left are met by
    the two sides' variants of at most one changed bit. So 3 + 2 * 64 variants do, where whole half-radius balls
    (up to two changed bits on one side) would take 2,081.
    """
    if radius != 3:
        raise ValueError("masked variants are worked out for a radius of three bits")

    def under(number: int, mask: int) -> Column:
        rest = ~mask & ((1 << BITS) - 1)
        base = F.col("print").bitwiseAND(F.lit(signed(rest)))
        flips = F.array(*[F.lit(signed(f)) for f in [0] + [1 << i for i in range(BITS) if rest >> i & 1]])
        return F.transform(flips, lambda f: F.struct(F.lit(number).cast("tinyint").alias("mask"), base.bitwiseXOR(f).alias("key")))

    keys = [under(number, mask) for number, mask in enumerate(masks(radius))]
    return prints.select("print", F.explode(F.concat(*keys)).alias("v")).select("v.mask", "v.key", "print")


def _links(radius: int):
    def forest(group: np.ndarray) -> list[tuple[int, int]]:
        """Links that join the fingerprints of one key as all their links within the radius would; fewer than its members."""
        if len(group) == 2:
            return [(0, 1)] if int(np.bitwise_count(group[0] ^ group[1])) <= radius else []
        links, waiting = [], np.arange(len(group))
        while len(waiting):
            front, waiting = waiting[:1], waiting[1:]
            while len(front) and len(waiting):
                at, front = front[0], front[1:]
                near = np.bitwise_count(group[waiting] ^ group[at]) <= radius
                links += [(int(at), int(x)) for x in waiting[near]]
                front, waiting = np.concatenate([front, waiting[near]]), waiting[~near]
        return links

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
        for batch in batches:
            mask, key, prints = (np.concatenate([h, batch[c].to_numpy()]) for h, c in zip(held, ("mask", "key", "print")))
            if not len(key):
                continue
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (mask[1:] != mask[:-1])]))
            held = (mask[new[-1] :], key[new[-1] :], prints[new[-1] :])
            yield _frame(prints, new)
        yield _frame(held[2], np.zeros(min(1, len(held[2])), np.int64), last=True)

    def _frame(prints: np.ndarray, starts: np.ndarray, last: bool = False) -> pd.DataFrame:
        ends = np.append(starts[1:], len(prints)) if last else starts[1:]
        found = []
        sizes = ends - starts[: len(ends)]
        for at in np.flatnonzero(sizes > 1):
            group = np.unique(prints[starts[at] : ends[at]])
            # Bits are counted on unsigned numbers; those of a signed one would be those of its absolute value.
            found += [(group[i], group[j]) for i, j in forest(group.view(np.uint64))]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return link


def near_prints(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Verified links ``a``, ``b`` between distinct fingerprints, enough to connect all that are within ``radius`` bits.

    ``prints`` has distinct bigints in ``print``. Variants are shuffled by key and sorted there; a task reads them as a
    stream, and the members of a key are compared without pairs leaving the task: a key yields fewer links than members.
    """
    dealt = variants(prints, radius).repartition("mask", "key").sortWithinPartitions("mask", "key")
    return dealt.mapInPandas(_links(radius), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", order: str = "doc_id", words: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` without the text, with ``print``, ``component_id`` and ``kept`` for each row.

    ``component_id`` is the smallest ``order`` reachable over links of at most ``radius`` bits, the row itself
    included (null if it is null in all of them); ``kept`` marks one row of each component, of smallest ``order``.
    Every row comes out once, of an empty table none. Texts without words, null and empty ones too, have the fingerprint zero and
    link like any other. Copies share a fingerprint and are one node, so groups of copies cost nothing after the
    first aggregate, which is combined before its shuffle.
    Rows are numbered and written with their fingerprints, so ``docs`` is read once.
    """
    name, row, component, kept, root, best = free_name(docs, "print", "row", "component_id", "kept", "root", "best")
    bound_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.keep(
        docs.withColumns({name: fingerprint(column(docs, text), words), row: F.monotonically_increasing_id()}).drop(text)
    )
    firsts = scratch.keep(
        rows.groupBy(F.col(name).alias("print")).agg(
            F.min(F.struct(F.col(order).isNull().alias("n"), F.col(order).alias("o"), F.col(row).alias("r"))).alias("first")
        )
    )
    links = scratch.keep(near_prints(firsts.select("print"), radius))
    roots = components(links, scratch)
    labelled = firsts.join(roots, firsts["print"] == roots["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    bests = labelled.groupBy("root").agg(F.min("first").alias("best"))
    of_print = labelled.join(bests, "root").select(F.col("print").alias(name), F.col("best").alias(best))
    out = rows.join(scratch.keep(of_print), name)
    return out.withColumns({component: F.col(best)["o"], kept: F.col(best)["r"] == F.col(row)}).drop(best, row)


def hex_print(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))
