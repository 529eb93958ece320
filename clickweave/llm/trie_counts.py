"""Token counts by dynamic programming over a trie of distinct words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import bound_batches, column, free_name
from clickweave.llm.pieces import Pieces, default_model, load_pieces

#: Text that is cut into words at a time, and words whose counts a task remembers; they bound its memory only.
BLOCK_CHARS = 1 << 20
REMEMBERED = 1_000_000


def shared_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle)
    return low


def trie_counts(words: Iterable[str], table: Pieces) -> dict[str, int]:
    """Number of ids of each word's best path.

    Sorted words are the trie in depth-first order: the forward scores along the current path are kept, and a word
    adds only those of the nodes that it does not share with the word before. The count of a terminal node is stored.
    """
    pieces, longest, unknown = table.pieces, table.longest, table.unknown_score
    scores, counts, path, out = [0.0], [0], "", {}
    for word in sorted(words):
        depth = shared_prefix(path, word)
        del scores[depth + 1 :], counts[depth + 1 :]
        for end in range(depth + 1, len(word) + 1):
            last = word[end - 1]
            if last in pieces:
                best, fewest = None, 0
            else:
                best, fewest = scores[end - 1] + unknown, counts[end - 1] + len(last.encode())
            for start in range(max(0, end - longest), end):
                piece = pieces.get(word[start:end])
                if piece is not None:
                    score, count = scores[start] + piece[1], counts[start] + 1
                    if best is None or score > best or (score == best and count < fewest):
                        best, fewest = score, count
            scores.append(best)
            counts.append(fewest)
        path = word
        out[word] = counts[len(word)]
    return out


class Counter:
    """Counts ids of texts, remembering words seen before."""

    def __init__(self, model: str):
        self.table = load_pieces(model)
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        words = [self.table.words(t) for t in texts]
        fresh = set().union(*words) - self.known.keys()
        if len(self.known) + len(fresh) > REMEMBERED:
            fresh, self.known = set().union(*words), {}
        parts = {w: self.table.parts(w) for w in fresh}
        found = trie_counts({p for ps in parts.values() for p in ps}, self.table)
        for word, ps in parts.items():
            self.known[word] = sum(map(found.__getitem__, ps))
        return [sum(map(self.known.__getitem__, ws)) for ws in words]


def blocks(texts: Iterable[str], size: int) -> Iterator[list[str]]:
    """Runs of texts of about ``size`` characters together; a longer text is a run of its own."""
    held, chars = [], 0
    for text in texts:
        if held and chars + len(text) > size:
            yield held
            held, chars = [], 0
        held.append(text)
        chars += len(text)
    if held:
        yield held


def count_tokens(docs: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``: ids of the best unigram path over the model's pieces and scores.

    Null and empty texts have none. Whole texts are counted, and every row for itself; a clashing column name gets
    underscores. Tasks need nothing of each other, so nothing is shuffled.
    """
    bound_batches(docs.sparkSession)
    path = model or default_model()

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(path)
        for batch in batches:
            texts = ["" if t is None else t for t in batch]
            yield pd.Series([n for block in blocks(texts, BLOCK_CHARS) for n in counter.count(block)], dtype="int64")

    return docs.withColumn(free_name(docs, "n_tokens"), count(column(docs, text)))
