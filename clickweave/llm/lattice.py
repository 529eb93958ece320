"""Near duplicates among embeddings by lattice hashing: projections decoded to points of the E8 lattice."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import Scratch, column, components

TABLES = 4
#: Neighbouring cells probed besides a vector's own, in every table.
PROBES = 4
#: Standard deviation of a projected coordinate of a unit vector. A pair of cosine 0.93 then lies about half a
#: cell apart: one table finds it with probability 0.7, four miss less than one in a hundred.
SPREAD = 0.5
#: Members of a cell compared by one task with those of another block of this size.
BLOCK = 2048

# Fixed numbers for mixing cell coordinates into a 64-bit key.
FACTOR = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=8)
def projections(dims: int) -> np.ndarray:
    """For every table a random projection to 8 dimensions, the same in every task."""
    drawn = np.random.default_rng(dims).normal(size=(TABLES, dims, 8))
    if dims >= 8:
        return np.stack([np.linalg.qr(d)[0] for d in drawn]) * np.sqrt(dims) * SPREAD
    return drawn * SPREAD


@lru_cache(maxsize=1)
def roots() -> np.ndarray:
    """The 240 lattice points nearest to the origin: steps to neighbouring cells."""
    pairs = []
    for (i, j), signs in product(combinations(range(8), 2), product((1, -1), repeat=2)):
        step = np.zeros(8)
        step[[i, j]] = signs
        pairs.append(step)
    halves = [s for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array([*pairs, *halves])


def _even(y: np.ndarray) -> np.ndarray:
    """Nearest points of whole coordinates with an even sum."""
    near = np.rint(y)
    off = y - near
    rows, worst = np.arange(len(y)), np.abs(off).argmax(axis=1)
    other = near.copy()
    other[rows, worst] += np.where(off[rows, worst] >= 0, 1, -1)
    return np.where((near.sum(axis=1) % 2 != 0)[:, None], other, near)


def decode(y: np.ndarray) -> np.ndarray:
    """Nearest E8 point: whole coordinates with an even sum, or those shifted by a half."""
    a, b = _even(y), _even(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1))[:, None], a, b)


def cell_keys(unit: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Keys (vector, table, cell) of the own cell first and then the probed ones; label and length are part of a key."""
    n, dims = unit.shape
    keys = np.empty((n, TABLES, 1 + PROBES), np.uint64)
    for table, projection in enumerate(projections(dims)):
        y = unit @ projection
        own = decode(y)
        steps = roots()
        # |y - own - step|^2 without the part that is the same for all; all steps have the same length.
        closeness = (y - own) @ steps.T
        best = np.argpartition(-closeness, PROBES - 1, axis=1)[:, :PROBES]
        cells = np.concatenate([own[:, None, :], own[:, None, :] + steps[best]], axis=1)
        codes = np.rint(2 * cells).astype(np.int64).view(np.uint64)
        key = np.broadcast_to((labels.view(np.uint64) + np.uint64(table * 1000 + dims))[:, None], codes.shape[:2])
        with np.errstate(over="ignore"):
            for axis in range(8):
                key = (key ^ codes[:, :, axis]) * FACTOR
                key ^= key >> np.uint64(29)
        keys[:, table] = key
    return keys.view(np.int64)


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    # Scaling by the largest component first keeps squares from overflowing.
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _add_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for _, part in batch.groupby(batch["vector"].map(len)):
            keys = cell_keys(_unit(part["vector"]), part["label"].to_numpy())
            yield part.assign(cells=list(keys.reshape(len(part), -1)))


def _met(own: np.ndarray, cells: np.ndarray, i: np.ndarray, j: np.ndarray, table: int) -> np.ndarray:
    """Whether members i and j meet in this table: the own cell of one is among the cells of the other."""
    a, b = own[i, table][:, None], own[j, table][:, None]
    return (cells[j, table] == a).any(axis=1) | (cells[i, table] == b).any(axis=1)


def verify_group(group: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links of the pairs that meet first in this cell: per node how many rows it links to, and a forest of the links."""
    unit, nodes, copies = _unit(group["vector"]), group["node"].to_numpy(), group["copies"].to_numpy()
    cells = np.stack(group["cells"].to_numpy()).reshape(len(group), TABLES, 1 + PROBES)
    own, key, table = cells[:, :, 0], group["key"].iloc[0], int(group["table"].iloc[0])
    is_own, block, labels = group["own"].to_numpy(), group["block"].to_numpy(), group["label"].to_numpy()
    two_blocks = group["lo"].iloc[0] != group["hi"].iloc[0]
    near = unit @ unit.T >= least
    near &= is_own[:, None] | is_own[None, :]
    near &= labels[:, None] == labels[None, :]
    near &= (block[:, None] != block[None, :]) if two_blocks else True
    i, j = np.nonzero(np.triu(near, 1))
    # A pair that meets more than once counts where it meets first: in its first table, in the own cell of the
    # smaller node if both own cells are among the other's.
    first = np.ones(len(i), bool)
    for earlier in range(table):
        first &= ~_met(own, cells, i, j, earlier)
    small, large = np.where(nodes[i] < nodes[j], i, j), np.where(nodes[i] < nodes[j], j, i)
    at_small = (cells[large, table] == own[small, table][:, None]).any(axis=1)
    first &= np.where(at_small, own[small, table], own[large, table]) == key
    i, j = i[first], j[first]
    links = np.bincount(i, copies[j], len(nodes)) + np.bincount(j, copies[i], len(nodes))
    parent = np.arange(len(nodes))
    while True:
        # Every node takes the smallest parent among its neighbours', then looks through to the parent's parent.
        new = parent.copy()
        np.minimum.at(new, i, parent[j])
        np.minimum.at(new, j, parent[i])
        new = new[new]
        if (new == parent).all():
            break
        parent = new
    linked = np.flatnonzero(links > 0)
    return pd.DataFrame(
        {"node": nodes[linked], "links": links[linked].astype(np.int64), "other": nodes[parent[linked]]}
    )


def _verify(least: float):
    names = ["key", "lo", "hi"]

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            keys = batch[names].to_numpy()
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
            held = batch.iloc[starts[-1] :]
            for a, b in zip(starts, starts[1:]):
                yield verify_group(batch.iloc[a:b], least)
        if held is not None and len(held):
            yield verify_group(held, least)

    return verify


def near_duplicates(
    vectors: DataFrame, least: float = 0.93, vector: str = "embedding", label: str = "label", order: str = "vec_id"
) -> DataFrame:
    """``order``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vectors``.

    Rows of equal, non-null label whose vectors have a cosine (in double precision) of at least ``least`` link,
    if their lattice cells meet in one of ``TABLES`` tables: no link found is below ``least``, and one of 0.93 is missed
    less than once in a hundred. Vectors that are null, empty, zero or hold null or non-finite components, and
    vectors of different lengths, link with nothing. ``component_id`` is the smallest ``order`` reachable; ``kept`` marks the
    rows that have it as their own. Every row comes out once; repeated rows are copies that link.

    Copies are one node with a count. Keys are counted first, and only members of cells where something can meet carry
    their vectors there. A cell is compared in pairs of blocks of ``BLOCK`` members, so a large group is
    many tasks. Pairs don't leave a task: a group yields one row per member, with its number of links and one link that
    keeps it connected.
    """
    scratch = Scratch(vectors.sparkSession, "lattice")
    value = column(vectors, vector).cast("array<double>")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    sound = F.coalesce(
        column(vectors, label).isNotNull() & ~bad & F.exists(value, lambda x: x != 0), F.lit(False)
    )
    tag = column(vectors, label).cast("string")
    # Adding zero makes -0.0 and 0.0 the same.
    plain = F.transform(value, lambda x: x + F.lit(0.0))
    rows = vectors.select(
        column(vectors, order).alias("id"),
        F.when(sound, F.xxhash64(tag)).alias("label"),
        F.when(sound, F.xxhash64(tag, plain)).alias("k1"),
        F.when(sound, F.xxhash64(F.lit(1), plain, tag)).alias("k2"),
        F.when(sound, plain).alias("vector"),
    )
    copies = rows.where("k1 IS NOT NULL").groupBy("label", "k1", "k2").agg(
        F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("least_id")
    )
    nodes = scratch.keep(copies.withColumn("node", F.monotonically_increasing_id()))
    fields = "node bigint, label bigint, copies bigint, vector array<double>, cells array<bigint>"
    members = scratch.keep(nodes.select("node", "label", "copies", "vector").mapInPandas(_add_cells, fields))
    places = members.select("node", F.posexplode("cells").alias("place", "key")).select(
        "node",
        "key",
        F.expr(f"place div {1 + PROBES}").cast("int").alias("table"),
        (F.col("place") % (1 + PROBES) == 0).alias("own"),
    )
    cells = places.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.max("own").alias("owned"))
    cells = scratch.keep(cells.where("m > 1 AND owned").select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    live = places.join(cells, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    live = live.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    live = live.select(
        "node", "key", "table", "own", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")
    )
    full = live.join(members, "node").repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    found = scratch.keep(full.mapInPandas(_verify(least), "node bigint, links bigint, other bigint"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    reach = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")), scratch)
    placed = nodes.drop("vector").join(links, "node", "left").join(reach, "node", "left")
    placed = scratch.keep(placed.withColumn("root", F.coalesce("root", "node")))
    least_ids = placed.groupBy("root").agg(F.min("least_id").alias("component"))
    result = scratch.keep(
        placed.join(least_ids, "root").select(
            "label", "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), "component"
        )
    )
    # Rows without a node get keys of their own, so that the join does not send them all to one task.
    keyed = rows.drop("vector").withColumn("k1", F.coalesce("k1", F.xxhash64("id")))
    out = keyed.join(result, ["label", "k1", "k2"], "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(order),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
    )
