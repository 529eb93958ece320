"""Sharding along a Hilbert curve over several metadata dimensions, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from clickweave.llm.common import Scratch, column, free_name, numbered

#: Bits per dimension. Three dimensions of four bits make 4,096 cells, which bounds every table of cells.
BITS = 4
#: Rows that one group of a window is meant to hold.
GROUP_ROWS = 1_000_000


#: Bytes by which texts are ordered; texts that agree in all of them are at one level.
TEXT_BYTES = 1024
#: Bytes of a text that are taken as one number; quantile summaries keep doubles, which are exact up to 53 bits.
STEP = 6
#: Steps of the share grid by which the rows that share a prefix are cut.
GRID = 64


def order_key(df: DataFrame, name: str) -> Column:
    """Something that sorts like the column: text and binary as their first ``TEXT_BYTES`` bytes, times as numbers."""
    kind, value = df.select(column(df, name)).schema[0].dataType.simpleString(), column(df, name)
    if kind == "string" or kind.startswith(("varchar", "char")) or kind == "binary":
        return F.substring(value.cast("binary"), 1, TEXT_BYTES)
    if kind == "date":
        return F.unix_date(value)
    if kind.startswith("timestamp"):
        return F.unix_micros(value.cast("timestamp"))
    if kind == "boolean":
        return value.cast("int")
    if kind in ("float", "double"):
        return F.nanvl(value.cast("double"), F.lit(float("inf")))
    if kind in ("tinyint", "smallint", "int", "bigint") or kind.startswith("decimal"):
        return value
    raise ValueError(f"{name} has type {kind}, which has no order to cut")


def level(key: Column, cuts: list) -> Column:
    """Number of cut points not above the key; zero for null."""
    if not cuts:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= key)), F.lit(0))


def quantile_cuts(keys: DataFrame, bits: int) -> list[list]:
    """Cut points per column that deal all rows out to ``2 ** bits`` levels as evenly as values allow.

    They come from mergeable summaries of all rows; some dozens of values reach the driver.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    plain = [f.name for f in keys.schema if f.dataType.typeName() != "binary"]
    row = keys.agg(*[F.percentile_approx(c, shares).alias(c) for c in plain]).first().asDict() if plain else {}
    return [sorted(set(row[c] or [])) if c in row else text_cuts(keys.select(c), shares) for c in keys.columns]


def text_cuts(keys: DataFrame, shares: list[float]) -> list[bytearray]:
    """Cut points of a binary column, found step by step.

    Numbers of ``STEP`` bytes are cut by their quantiles. Where several cuts fall on the same number, the rows behind it
    are looked at again, past all bytes that they have in common, until every cut is on its own or the rows are equal.
    Rounds grow with the length of what distinguishes the values, not with the rows, and each round is two aggregates.
    """
    key, found = F.col(f"`{keys.columns[0]}`"), set()
    total = keys.agg(F.count(key)).first()[0]
    # A prefix, the place in order of its first row, and the places at which its rows are to be cut.
    waiting = [(b"", [s * total for s in shares])] if total else []
    while waiting:
        inside = [F.substring(key, 1, len(p)) == F.lit(bytearray(p)) if p else key.isNotNull() for p, _ in waiting]
        lows = keys.agg(
            *[
                F.struct(F.count_if(key < F.lit(bytearray(p))), F.count_if(i), F.min(F.when(i, key)), F.max(F.when(i, key)))
                for (p, _), i in zip(waiting, inside)
            ]
        ).first()
        groups = []
        for (_, places), i, (below, count, low, high) in zip(waiting, inside, lows):
            common = len(_common(low, high))
            if low == high:
                found.add(bytes(low))
            else:
                groups.append((bytes(low[:common]), places, i, below, count))
        if not groups:
            break
        steps = [(F.substring(key, len(p) + 1, STEP), i) for p, _, i, _, _ in groups]
        grid = [g / GRID for g in range(1, GRID)]
        cut = keys.agg(*[F.percentile_approx(F.when(i, _number(part)), grid) for part, i in steps]).first()
        waiting = []
        for (prefix, places, _, below, count), numbers in zip(groups, cut):
            at: dict[bytes, list[float]] = {}
            for place in places:
                share = min(max((place - below) / count, 0), 1)
                number = numbers[min(len(grid) - 1, max(0, round(share * GRID) - 1))]
                at.setdefault(prefix + number.to_bytes(STEP, "big"), []).append(place)
            for longer, some in at.items():
                # Zeros at the end may stand for bytes that are not there.
                bare = longer.rstrip(b"\0")
                if len(some) == 1 or len(bare) < len(longer) or len(longer) >= TEXT_BYTES:
                    found.add(bare)
                else:
                    waiting.append((longer, some))
    return [bytearray(c) for c in sorted(found)]


def _common(a: bytes, b: bytes) -> bytes:
    n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[:n]


def _number(part: Column) -> Column:
    """Up to ``STEP`` bytes as a number that sorts like them."""
    return F.conv(F.rpad(F.hex(part), 2 * STEP, "0"), 16, 10).cast("bigint")


def hilbert_index(levels: list[Column], bits: int) -> Column:
    """Place on the Hilbert curve of the cell with these levels (each below ``2 ** bits``)."""
    axes = len(levels)
    turns = [(1 << b, i) for b in range(bits - 1, 0, -1) for i in range(axes)]
    steps = F.array(*[F.struct(F.lit(q).alias("q"), F.lit(i).alias("i")) for q, i in turns])

    def turn(x: Column, step: Column) -> Column:
        low, first, own = step["q"] - 1, x[0], F.get(x, step["i"])
        invert = own.bitwiseAND(step["q"]) != 0
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        return F.transform(
            x,
            lambda v, j: F.when(invert, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v)).otherwise(
                F.when((j == 0) | (j == step["i"]), v.bitwiseXOR(swap)).otherwise(v)
            ),
        )

    # Gray code: each axis takes up the one before it, then all take up the parity of the last one's bits.
    def gray(x: Column) -> Column:
        return F.aggregate(
            x,
            F.array().cast("array<int>"),
            lambda done, v: F.concat(
                done, F.array(v.bitwiseXOR(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0))))
            ),
        )

    def parity(x: Column) -> Column:
        masks = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)]).cast("array<int>")
        last = F.element_at(x, -1)
        return F.aggregate(
            masks, F.lit(0), lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t)
        )

    def interleave(x: Column) -> Column:
        places = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(axes)])
        return F.aggregate(
            places,
            F.lit(0).cast("bigint"),
            lambda h, p: h * 2 + F.when(F.get(x, p["i"]).bitwiseAND(p["q"]) != 0, F.lit(1)).otherwise(F.lit(0)),
        )

    start = F.aggregate(steps, F.array(*[v.cast("int") for v in levels]), turn) if turns else F.array(*[v.cast("int") for v in levels])
    # One-element arrays stand for local names: each stage is computed once and then used many times.
    grayed = F.transform(F.array(start), gray)
    evened = F.transform(grayed, lambda x: F.transform(F.array(parity(x)), lambda t: F.transform(x, lambda v: v.bitwiseXOR(t)))[0])
    return F.transform(evened, interleave)[0]


def hilbert_shards(
    docs: DataFrame,
    dimensions: tuple[str, ...] = ("source", "n_chars", "doc_id"),
    shards: int = 16,
    text: str = "text",
    order: str = "doc_id",
    bits: int = BITS,
) -> DataFrame:
    """``order``, ``size``, ``text_crc32``, ``curve``, ``law``, ``shard``, ``slot`` and ``grown_shard`` of every row.

    Dimensions are numbers, texts, dates, times or booleans; levels are cut at quantiles of all rows' values, so texts that share a
    long beginning are told apart. Law ``rows``: rows in the order of the curve are cut into runs whose counts are at most one apart, so a shard
    covers a compact range of every dimension. ``size`` is the text's UTF-8 bytes plus one, ``slot`` the place in the
    shard from 0. A null dimension is at the lowest level (NaN at the highest), a constant one has one level, a null text has no bytes. Every row comes out once,
    repeated ones too; rows that tie take places in any order.

    Rows are numbered by (cell, salt): the groups are salted by row so that one cell that holds most of the rows, or one row that
    is there again and again, is still dealt to many tasks, and their offsets come from counts. Only counts by cell meet in one task, at most
    ``2 ** (bits * dimensions)`` of them.
    """
    value = column(docs, text)
    keys = docs.select(*[order_key(docs, d).alias(f"d{i}") for i, d in enumerate(dimensions)])
    cuts = quantile_cuts(keys, bits)
    cells = hilbert_index([level(order_key(docs, d), c) for d, c in zip(dimensions, cuts)], bits)
    scratch = Scratch(docs.sparkSession, "hilbert")
    table = scratch.keep(
        docs.select(
            column(docs, order).alias("id"),
            (F.coalesce(F.octet_length(value), F.lit(0)) + 1).cast("bigint").alias("size"),
            F.crc32(F.coalesce(value, F.lit("")).cast("binary")).alias("text_crc32"),
            cells.alias("curve"),
        )
    )
    total = table.count()
    salts = max(8, min(1 << 16, total // GROUP_ROWS))
    rows = numbered(table, "row", scratch).withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts))).drop("row")
    counts = rows.groupBy("curve", "salt").agg(F.count(F.lit(1)).alias("n"))
    whole = counts.groupBy("curve").agg(F.sum("n").alias("cell_rows"))
    before = F.sum("cell_rows").over(Window.orderBy("curve")) - F.col("cell_rows")
    starts = whole.select("curve", before.alias("cell_start"))
    inside = F.sum("n").over(Window.partitionBy("curve").orderBy("salt")) - F.col("n")
    offsets = counts.withColumn("inside", inside).join(starts, "curve")
    offsets = offsets.select("curve", "salt", (F.col("cell_start") + F.col("inside")).alias("start"))
    place = F.row_number().over(Window.partitionBy("curve", "salt").orderBy("id", "text_crc32"))
    ranked = rows.join(offsets, ["curve", "salt"]).withColumn("rank", F.col("start") + place - 1)
    if total:
        ranked = ranked.withColumn("shard", F.expr(f"rank * {shards} div {total}"))
        ranked = ranked.withColumn("slot", F.expr(f"rank - (shard * {total} + {shards - 1}) div {shards}"))
    else:
        ranked = ranked.withColumns({"shard": F.lit(0).cast("bigint"), "slot": F.lit(0).cast("bigint")})
    return ranked.select(
        F.col("id").alias(order),
        "size",
        "text_crc32",
        "curve",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, order: str = "doc_id") -> None:
    """Write ``docs`` as one folder per shard, sorted along the curve, for readers that prune by file statistics.

    ``placed`` comes from ``hilbert_shards``; ids have to be unique here. Large shards become several files.
    """
    place, slot, curve = free_name(docs, "shard", "slot", "curve")
    where = placed.select(order, F.col("shard").alias(place), F.col("slot").alias(slot), F.col("curve").alias(curve))
    rows = docs.join(where, order).repartitionByRange(place, slot).sortWithinPartitions(place, slot)
    rows.drop(slot, curve).write.partitionBy(place).parquet(path)
