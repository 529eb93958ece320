"""Sum-of-squares packing of tokenised documents into sequences of bounded length."""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import Scratch, bound_batches, column

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
END_ID = 2
#: Pieces that one task packs at a time; the few sequences that a group leaves partly empty are what grouping costs.
GROUP_PIECES = 100_000

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


@lru_cache(maxsize=2)
def encoder(folder: str):
    """A function from text to token ids. Ids are those of ``tokenizers``' vocabulary file.

    Text up to U+024F without the special token goes through the same vocabulary's rank file, which encodes it to the same
    ids some four times as fast; whatever might be split in another way by another regex engine goes through
    ``tokenizers`` itself.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(os.path.join(folder, TOKENIZER))
    with open(os.path.join(folder, RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if "<|endoftext|>" in text or (not text.isascii() and max(text) > "ɏ"):
            return whole.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def tokenizer_folder() -> str:
    import public_tokenizers

    return os.path.dirname(public_tokenizers.path(TOKENIZER))


def cut(n: int, most: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: whole ones of ``most`` from the end, what is left comes first."""
    first = n % most or most
    yield 0, min(first, n)
    for start in range(first, n, most):
        yield start, most


def pieces(docs: DataFrame, text: str, order: str, most: int, folder: str | None) -> DataFrame:
    """``PIECE_SCHEMA`` for every document; a null text is empty."""
    folder = folder or tokenizer_folder()

    def tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(folder)
        for batch in batches:
            out = []
            for doc_id, value in zip(batch["id"], batch["text"]):
                ids = np.array([*encode(value), END_ID], "<u4")
                for piece, (start, length) in enumerate(cut(len(ids), most)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    out.append((None if pd.isna(doc_id) else int(doc_id), piece, start, length, crc))
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield frame.astype({"doc_id": "Int64"})

    rows = docs.select(
        column(docs, order).cast("string").alias("id"), F.coalesce(column(docs, text), F.lit("")).alias("text")
    )
    return rows.mapInPandas(tokenise, PIECE_SCHEMA)


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each item, placed in the given order.

    An item goes where the sum over gaps of the squared number of open bins with that gap becomes smallest (full
    bins do not count, ties go to the smallest gap). As no item is still to come that a fresh bin would suit better
    than the open ones, a bin is opened only where none has room.
    """
    counts = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, opened = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), 0
    for i, size in enumerate(sizes):
        before, after = counts[size:capacity], counts[: capacity - size]
        fits = np.flatnonzero(before)
        if len(fits):
            # Moving a bin from gap g to g - size changes the sum by 2 (N[g - size] - N[g]) + 2.
            change = 2 * (after[fits] - before[fits]) + 2
            if fits[0] == 0:
                change[0] = 1 - 2 * before[0]
            gap = int(fits[change.argmin()]) + size
            number = stacks[gap].pop()
            counts[gap] -= 1
        else:
            gap, number, opened = capacity, opened, opened + 1
        bins[i], offsets[i] = number, capacity - gap
        if gap > size:
            stacks[gap - size].append(number)
            counts[gap - size] += 1
    return bins, offsets


def pack(
    docs: DataFrame,
    most: int = 1024,
    text: str = "text",
    order: str = "doc_id",
    folder: str | None = None,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """``order``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset`` of every piece.

    A document's ids end with ``END_ID``, so an empty or null text is one id. Documents longer than ``most`` are cut into
    pieces of ``most``, of which the first may be shorter. Pieces of ``most`` ids are sequences of their own. All
    others are dealt at random into groups of about ``group_pieces``, and each group is packed by one task, large pieces
    first. A group is a fair sample of all sizes, so what grouping costs is the last few open sequences of each. Repeated
    rows are packed each, null ids stay null, and rows that tie are packed in any order.
    """
    bound_batches(docs.sparkSession)
    table = Scratch(docs.sparkSession, "packing").keep(pieces(docs, text, order, most, folder))
    row = F.monotonically_increasing_id()
    whole = table.where(F.col("length") == most).withColumns(
        {"sequence_id": -1 - row, "offset": F.lit(0).cast("bigint")}
    )
    loose = table.where(F.col("length") < most)
    groups = max(1, -(-loose.count() // group_pieces))

    def pack_group(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        out = group.drop(columns="group_id").sort_values("length", ascending=False, kind="stable")
        bins, offsets = sum_of_squares(out["length"].to_numpy(), most)
        return out.assign(sequence_id=bins + (int(key[0]) << 32), offset=offsets)

    dealt = loose.withColumn("group_id", F.pmod(F.xxhash64(row), F.lit(groups)))
    packed = dealt.groupBy("group_id").applyInPandas(pack_group, f"{PIECE_SCHEMA}, sequence_id bigint, offset bigint")
    return whole.unionByName(packed).withColumnRenamed("doc_id", order)
