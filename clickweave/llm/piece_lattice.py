"""SentencePiece encoding by a lattice of pieces, and decoding.

Texts are cut into parts, which no piece crosses. Distinct parts meet once for the whole table. Their substrings of bounded
length are joined to the piece table, a character at a time; what matches are the edges of a lattice per part, from which the
best path to every position follows (Viterbi), for all parts of a task together. Documents then take up the ids of their words.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import Scratch, bound_batches, column, free_name, numbered
from clickweave.llm.pieces import SPACE, Pieces, default_model, load_pieces
from clickweave.llm.trie_counts import BLOCK_CHARS, blocks

#: A word without the first space in front of it.
KEY = re.compile(" ( *[^ ]*)")
#: Bytes of text that a block of rows is meant to hold.
BLOCK_BYTES = 28 << 20
#: Bytes of text for which there is one deal of parts; a task folds a deal. Every block has a row for each deal: beyond so
#: many deals they get larger instead, and a task folds one in turns of ``HELD_PLACES``, so that rows grow with the blocks.
DEAL_BYTES, MOST_DEALS = 16 << 20, 256
#: Distinct words a task remembers before it hands them on; it bounds memory only.
HELD_WORDS = 200_000
#: Parts whose lattices are held together; it bounds memory only.
TASK_PARTS = 20_000
#: Parts' places in blocks that a task packs at a time; it bounds memory only.
HELD_PLACES = 500_000
#: Longer parts (no piece boundary for so many characters) are cut into edges the same way, but folded by the task
#: that holds the document: positions are the steps here, which are taken for all parts together.
LATTICE_CHARS = 256


class Lattice:
    """The piece table as steps: from a substring, by the character in front of it, to the substring that is longer by it.

    Only ends of pieces are substrings here. ``keys`` are the steps in order, ``piece_of`` is the piece that a substring
    is, if it is one: its place in ``ids`` and ``scores``.
    """

    def __init__(self, table: Pieces):
        self.table = table
        chars = sorted({c for piece in table.pieces for c in piece})
        self.width = len(chars) + 1
        #: Number of every character, 0 for those of no piece.
        self.classes = np.zeros(0x110000, np.int32)
        self.classes[[ord(c) for c in chars]] = np.arange(1, self.width)
        number = {c: i for i, c in enumerate(chars, 1)}
        steps: dict[int, int] = {}
        ends = {}
        for place, piece in enumerate(table.pieces):
            at = 0
            for c in reversed(piece):
                at = steps.setdefault(at * self.width + number[c], len(steps) + 1)
            ends[at] = place
        self.piece_of = np.full(len(steps) + 1, -1, np.int32)
        self.piece_of[list(ends)] = list(ends.values())
        self.keys = np.fromiter(steps, np.int64, len(steps))
        order = np.argsort(self.keys)
        self.keys, self.longer = self.keys[order], np.fromiter(steps.values(), np.int64, len(steps))[order]
        self.ids, self.scores = (np.array(v) for v in zip(*table.pieces.values()))
        #: Steps of one character, 0 if there is none.
        self.first = np.zeros(self.width, np.int64)
        self.first[self.keys[self.keys < self.width]] = self.longer[self.keys < self.width]
        #: Neighbours that some piece holds.
        self.joined = np.sort(np.array([number[p[0]] * self.width + number[p[1]] for p in table.joined], np.int64))

    def numbers(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Code points of a text, and the characters' numbers."""
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        return codes, self.classes[codes]

    def cut(self, keys: list[str]) -> tuple[list[str], np.ndarray]:
        """The parts of the words that ``word_keys`` stands for, in order, and where each word's parts begin and end."""
        if not keys:
            return [], np.zeros(1, np.int64)
        text = SPACE + SPACE.join([k.replace(" ", SPACE) for k in keys])
        numbers = self.numbers(text)[1].astype(np.int64)
        pairs = numbers[:-1] * self.width + numbers[1:]
        cuts = np.ones(len(text) + 1, bool)
        if len(self.joined):
            cuts[1:-1] = self.joined[np.minimum(np.searchsorted(self.joined, pairs), len(self.joined) - 1)] != pairs
        words = np.cumsum([0] + [len(k) + 1 for k in keys])
        cuts[words] = True
        places = np.flatnonzero(cuts)
        at = places.tolist()
        return [text[i:j] for i, j in zip(at, at[1:])], np.searchsorted(places, words)

    def fold(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the parts' best paths, one after another, and how many each has."""
        found = [self._fold(parts[i : i + TASK_PARTS]) for i in range(0, len(parts), TASK_PARTS)]
        if not found:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        ids, counts = zip(*found)
        return np.concatenate(ids), np.concatenate(counts)

    def _fold(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        codes, numbers = self.numbers("".join(parts))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        # Longest first: those that have a position are the first ones.
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
        having = np.searchsorted(-sizes, -np.arange(sizes[0] + 1), side="right")
        chars = [numbers[starts[:n] + i] for i, n in enumerate(having[1:].tolist())]
        # Best path to every position: its score and number of ids, the characters and the piece of its last edge.
        scores, counts = [np.zeros(len(parts))], [np.zeros(len(parts), np.int32)]
        widths, pieces = [np.zeros(len(parts), np.int16)], [np.full(len(parts), -1, np.int32)]
        for end, n in enumerate(having[1:].tolist(), 1):
            at = self.first[chars[end - 1]]
            piece = self.piece_of[at]
            known = piece >= 0
            # A character of no piece becomes as many ids as it has bytes.
            code = codes[starts[:n] + end - 1]
            octets = 1 + (code >= 0x80).astype(np.int32) + (code >= 0x800) + (code >= 0x10000)
            score = scores[end - 1][:n] + np.where(known, self.scores[piece], self.table.unknown_score)
            count = counts[end - 1][:n] + np.where(known, 1, octets).astype(np.int32)
            width = np.ones(n, np.int16)
            alive = np.flatnonzero(at)
            at = at[alive]
            for start in range(end - 2, max(-1, end - self.table.longest - 1), -1):
                if not len(alive):
                    break
                key = at * self.width + chars[start][alive]
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                found = self.keys[place] == key
                alive, at = alive[found], self.longer[place[found]]
                longer = self.piece_of[at]
                edge = longer >= 0
                of, longer = alive[edge], longer[edge]
                new, ids = scores[start][of] + self.scores[longer], counts[start][of] + 1
                # Ties go to fewer ids, then to the earlier start.
                old = score[of]
                better = (new > old) | ((new == old) & (ids <= count[of]))
                of = of[better]
                score[of], count[of], width[of], piece[of] = new[better], ids[better], end - start, longer[better]
            for kept, value in zip((scores, counts, widths, pieces), (score, count, width, piece)):
                kept.append(value)
        return self._paths(codes, starts, sizes, order, counts, widths, pieces)

    def _paths(self, codes, starts, sizes, order, counts, widths, pieces) -> tuple[np.ndarray, np.ndarray]:
        """Walks back from the ends of all parts, an edge at a time."""
        bases = np.cumsum([0] + [len(c) for c in counts])
        counts, widths, pieces = map(np.concatenate, (counts, widths, pieces))
        rows, at = np.arange(len(sizes)), sizes
        total = np.zeros(len(sizes), np.int64)
        total[order] = counts[bases[at] + rows]
        out, place = np.zeros(total.sum(), np.int32), np.cumsum(total)[order]
        while len(rows):
            here = bases[at] + rows
            before = at - widths[here]
            place = place - (counts[here] - counts[bases[before] + rows])
            piece = pieces[here]
            known = piece >= 0
            out[place[known]] = self.ids[piece[known]]
            for i in np.flatnonzero(~known).tolist():
                ids = self.table.byte_ids(chr(codes[starts[rows[i]] + before[i]]))
                out[place[i] : place[i] + len(ids)] = ids
            on = before > 0
            rows, at, place = rows[on], before[on], place[on]
        return out, total


def best_ids(part: str, table: Pieces) -> list[int]:
    """The same for one part, edge by edge."""
    best: list[tuple] = [(0.0, 0, 0, [])]
    for end in range(1, len(part) + 1):
        found = None
        for start in range(max(0, end - table.longest), end):
            known = table.pieces.get(part[start:end])
            if known is None and end - start > 1:
                continue
            ids, score = ([known[0]], known[1]) if known else (table.byte_ids(part[start]), table.unknown_score)
            path = (best[start][0] + score, best[start][1] + len(ids), start, ids)
            if found is None or path[0] > found[0] or (path[0] == found[0] and path[1] < found[1]):
                found = path
        best.append(found)
    out, at = [], len(part)
    while at > 0:
        out.append(best[at][3])
        at = best[at][2]
    return [i for ids in reversed(out) for i in ids]


@lru_cache(maxsize=2)
def load_lattice(model: str) -> Lattice:
    return Lattice(load_pieces(model))


def _texts(sizes, payload: bytes) -> Iterator[str]:
    data, at = zstandard.decompress(payload), 0
    for size in sizes:
        yield data[at : at + size].decode()
        at += size


def word_keys(text: str) -> list[str]:
    """The words of a text in order, each without the first mark in front of it, and with spaces for others."""
    if not text:
        return []
    text = text.replace(SPACE, " ")
    return KEY.findall(" " + text) if text[0] == " " or "  " in text else text.split(" ")


def pack_parts(parts: list[bytes]) -> bytes:
    """How long the parts are, and the parts, compressed. Parts have at most ``LATTICE_CHARS`` characters."""
    return zstandard.compress(np.array([len(parts)], "<i4").tobytes() + np.array(list(map(len, parts)), "<u2").tobytes() + b"".join(parts), 3)


def unpack_parts(payload: bytes) -> list[bytes]:
    data = zstandard.decompress(payload)
    n = int(np.frombuffer(data, "<i4", 1)[0])
    ends = (4 + 2 * n + np.cumsum(np.frombuffer(data, "<u2", n, 4), dtype=np.int64)).tolist()
    return [data[a:b] for a, b in zip([4 + 2 * n, *ends], ends)]


PARTS = "block bigint, part struct<deal: int, packed: binary>"


def _distinct_parts(model: str, deals: int):
    """The distinct parts of a block's texts, packed by deal; a part may come twice if memory is short or a block is split."""
    kind = pa.struct([("deal", pa.int32()), ("packed", pa.binary())])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, words, parts, block = load_lattice(model), set(), set(), None

        def learn() -> None:
            parts.update(lattice.cut(list(words))[0])
            words.clear()

        def take() -> pa.RecordBatch:
            learn()
            dealt = defaultdict(list)
            for data in [p.encode() for p in sorted(parts) if len(p) <= LATTICE_CHARS]:
                dealt[crc32(data) % deals].append(data)
            parts.clear()
            packed = [{"deal": deal, "packed": pack_parts(some)} for deal, some in dealt.items()]
            return pa.RecordBatch.from_pydict({"block": pa.array([block] * len(packed), pa.int64()), "part": pa.array(packed, kind)})

        for batch in batches:
            for number, text in zip(batch["block"].to_pylist(), batch["text"].to_pylist()):
                if number != block:
                    if block is not None:
                        yield take()
                    block = number
                words.update(word_keys(text))
                if len(words) > HELD_WORDS:
                    learn()
                    if len(parts) > 4 * HELD_WORDS:
                        yield take()
        if block is not None:
            yield take()

    return collect


def _pack_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of a block's texts, compressed together for the one shuffle that they take part in: (block, keys, sizes, payload)."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        at, out, rows = 0, [], zip(batch["block"], batch["text"])
        for block, of_block in groupby(rows, lambda row: row[0]):
            for texts in blocks((text for _, text in of_block), BLOCK_CHARS // 4):
                data = [t.encode() for t in texts]
                keys = [None if pd.isna(k) else k for k in batch["id"].iloc[at : at + len(texts)]]
                out.append((block, keys, list(map(len, data)), squeeze.compress(b"".join(data))))
                at += len(texts)
        if out:
            yield pd.DataFrame(out, columns=["block", "keys", "sizes", "payload"])


def _lexicon(parts: list[bytes], counts: np.ndarray, ids: np.ndarray) -> bytes:
    head = np.concatenate([[len(parts)], list(map(len, parts)), counts]).astype("<i4")
    # The ids' lowest bytes together, then those above: most of them are equal.
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(-1, 4).T.tobytes() for a in (head, ids.astype("<i4"))]
    return np.array([len(head)], "<i4").tobytes() + zstandard.compress(b"".join([*planes, *parts]), 3)


def pack_lexicon(parts: list[bytes], ids: list[np.ndarray]) -> bytes:
    """How many parts there are, their bytes, how many ids each has, the ids and the parts themselves, compressed."""
    return _lexicon(parts, np.array(list(map(len, ids)), np.int64), np.concatenate([np.zeros(0, "<i4"), *ids]))


def unpack_lexicon(payload: bytes) -> dict[str, bytes]:
    """The ids of each part, four bytes each."""

    def plain(n: int, at: int) -> bytes:
        return np.frombuffer(data, np.uint8, 4 * n, at).reshape(4, n).T.tobytes()

    data, n = zstandard.decompress(payload[4:]), int(np.frombuffer(payload, "<i4", 1)[0])
    sizes, counts = np.frombuffer(plain(n, 0), "<i4")[1:].reshape(2, -1)
    total = int(counts.sum())
    ids = plain(total, 4 * n)
    ends, stops = (4 * n + 4 * total + np.cumsum(sizes)).tolist(), (4 * np.cumsum(counts)).tolist()
    starts, begins = [4 * n + 4 * total, *ends], [0, *stops]
    return {data[a:b].decode(): ids[c:d] for a, b, c, d in zip(starts, ends, begins, stops)}


def _fold_parts(model: str):
    """(block, payload): the parts of a task with their ids, for every block that has them."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, known, held = load_lattice(model), {}, 0
        places: dict[int, list[np.ndarray]] = defaultdict(list)

        def take() -> Iterator[pa.RecordBatch]:
            parts = sorted(known)
            ids, counts = lattice.fold([p.decode() for p in parts])
            ends = np.cumsum(counts)
            rank = np.empty(len(parts), np.int64)
            rank[[known[p] for p in parts]] = np.arange(len(parts))
            for block, some in places.items():
                of = np.unique(rank[np.concatenate(some)])
                n = counts[of]
                at = np.repeat(ends[of] - np.cumsum(n), n) + np.arange(n.sum())
                payload = _lexicon([parts[i] for i in of.tolist()], n, ids[at])
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "payload": pa.array([payload], pa.binary())})
            known.clear()
            places.clear()

        for batch in batches:
            for block, packed in zip(batch["block"].to_pylist(), batch["packed"].to_pylist()):
                places[block].append(np.array([known.setdefault(p, len(known)) for p in unpack_parts(packed)], np.int64))
                held += len(places[block][-1])
                if held > HELD_PLACES:
                    yield from take()
                    held = 0
        if known:
            yield from take()

    return fold


class Words(dict):
    """The ids of words, four bytes each, put together from those of their parts."""

    def __init__(self, lattice: Lattice):
        self.lattice, self.lexicon = lattice, {}

    def ids_of(self, part: str) -> bytes:
        return self.lexicon[part] if len(part) <= LATTICE_CHARS else np.array(best_ids(part, self.lattice.table), "<i4").tobytes()

    def learn(self, keys: set[str]) -> None:
        if len(self) + len(keys) > HELD_WORDS:
            self.clear()
        if fresh := list(keys - self.keys()):
            parts, ends = self.lattice.cut(fresh)
            ids, ends = list(map(self.ids_of, parts)), ends.tolist()
            self.update((key, b"".join(ids[a:b])) for key, a, b in zip(fresh, ends, ends[1:]))


def _encode_blocks(model: str):
    """Encodes the texts of each block; its lexicon comes first."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, words = None, Words(load_lattice(model))
        for batch in batches:
            # Payloads one by one: a batch's are not held twice.
            for number, keys, sizes, payload in zip(*(batch[c] for c in ("block", "keys", "sizes", "payload"))):
                if number.as_py() != block:
                    block, words.lexicon = number.as_py(), {}
                    words.clear()
                if not keys.is_valid:
                    words.lexicon.update(unpack_lexicon(payload.as_py()))
                    continue
                texts = [word_keys(text) for text in _texts(sizes.as_py(), payload.as_py())]
                words.learn(set().union(*texts))
                ids = [b"".join(map(words.__getitem__, text)) for text in texts]
                ends = np.cumsum([0] + [len(i) // 4 for i in ids])
                # One run of texts at a time, so that a batch's ids are never held together.
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))
                yield pa.RecordBatch.from_arrays([pa.array(keys.as_py(), pa.string()), lists], ["id", "ids"])

    return encode


def encode(docs: DataFrame, text: str = "text", order: str = "doc_id", model: str | None = None) -> DataFrame:
    """``order`` and ``ids`` of every row of ``docs``.

    A null or an empty text has no ids. Whole texts are encoded, repeated rows each. A block is a run of rows, by the
    numbers that ``numbered`` gives them, so that the table can be read again. The distinct parts of the blocks meet for the
    lattice, packed by the block that has them and the deal that a part's checksum puts it into. A task folds the parts of a
    deal, each once while ``HELD_PLACES`` lasts. The ids go back to the blocks, packed for
    each, where the block's texts meet them in one task. So a shuffle carries a part once a block, and the texts once;
    both are compressed, and texts are not written beside. A part of over ``LATTICE_CHARS`` characters is folded in that task.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    path = model or default_model()
    scratch = Scratch(spark, "pieces")
    row = free_name(docs, "row")
    rows = numbered(docs.select(*[column(docs, name) for name in dict.fromkeys((order, text))]), row, scratch)
    begun = scratch.count
    value = F.coalesce(column(rows, text), F.lit(""))
    n, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length(value).cast("bigint"))).first()
    n_blocks = max(1, -(-(size or 0) // BLOCK_BYTES))
    deals = min(MOST_DEALS, max(1, -(-(size or 0) // DEAL_BYTES)))
    block = F.expr(f"{row} div {max(1, -(-n // n_blocks))}").alias("block")
    texts = rows.select(block, column(rows, order).cast("string").alias("id"), value.alias("text"))
    parts = scratch.keep(texts.select("block", "text").mapInArrow(_distinct_parts(path, deals), PARTS))
    dealt = parts.select("block", "part.deal", "part.packed").repartitionById(deals, "deal")
    lexicon = scratch.keep(dealt.mapInArrow(_fold_parts(path), "block bigint, payload binary"))
    scratch.drop(begun + 1)
    packed = texts.mapInPandas(_pack_texts, "block bigint, keys array<string>, sizes array<int>, payload binary")
    both = lexicon.unionByName(packed, allowMissingColumns=True)
    # As many tasks as blocks and some to spare, as several blocks may be dealt to one.
    dealt = both.withColumn("last", F.col("keys").isNotNull()).repartition(2 * n_blocks, "block")
    found = dealt.sortWithinPartitions("block", "last").mapInArrow(_encode_blocks(path), "id string, ids array<int>")
    return found.select(F.col("id").cast(docs.schema[order].dataType).alias(order), "ids")


def decode(ids: Column, model: str | None = None) -> Column:
    """The text of an array of ids: the pieces' bytes, spaces for marks, without the space in front."""
    table = load_pieces(model or default_model())
    last = max(table.surface)
    surfaces = F.split(F.lit(",".join(table.surface.get(i, b"").hex() for i in range(last + 1))), ",")
    data = F.unhex(F.array_join(F.transform(ids, lambda i: F.get(surfaces, i)), ""))
    return F.substring(F.decode(data, "UTF-8"), F.lit(2), F.lit((1 << 31) - 1))
