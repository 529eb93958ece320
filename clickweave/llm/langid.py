"""Language ID by mixture inference: the proportions of languages in a text from its letter trigrams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import bound_batches, column, free_name

UNKNOWN = "und"
#: Trigrams have 18 bits; with many languages they are folded so that a model never has more cells than this.
GRAM_BITS = 18
MODEL_CELLS = 1 << 22
#: Added to every count of a trigram that any language has.
SMOOTHING = 0.2
#: A further language must raise the log-likelihood by this many times log(trigrams). Overlapping trigrams are
#: not independent, so it is more than the half of the usual criterion.
PENALTY = 3.0
ROUNDS = 200
TOLERANCE = 1e-4

#: Letters a-z are 1 to 26, bytes of other letters 27 to 63, all else is 0, a boundary.
CLASSES = np.zeros(256, np.uint32)
CLASSES[97:123] = np.arange(1, 27)
CLASSES[128:] = 27 + (np.arange(128, 256) & 63) % 37

LETTER = re.compile(r"[^\W\d_]")


def grams(text: str, cells: int) -> np.ndarray:
    """Codes of all trigrams of the whole text, runs of other characters counting as one boundary."""
    classes = CLASSES[np.frombuffer(f" {text.lower()} ".encode(errors="replace"), np.uint8)]
    classes = classes[np.concatenate([[True], (classes[1:] > 0) | (classes[:-1] > 0)])]
    return (classes[:-2] << 12 | classes[1:-1] << 6 | classes[2:]) % cells


def count_grams(rows: DataFrame, languages: list[str], cells: int) -> DataFrame:
    """``language`` (its number), ``gram`` and ``n`` over the whole texts of ``rows`` (``text``, ``lang``).

    A task adds up its own rows first and so sends at most ``len(languages) * cells`` rows.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros((len(languages), cells), np.int64)
        number = {name: i for i, name in enumerate(languages)}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                codes, n = np.unique(grams(text, cells), return_counts=True)
                found[number[lang], codes] += n
        at = np.nonzero(found)
        yield pd.DataFrame({"language": at[0], "gram": at[1], "n": found[at]})

    counted = rows.mapInPandas(count, "language int, gram int, n bigint")
    return counted.groupBy("language", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Trigram likelihoods of the learned languages, at most ``MODEL_CELLS`` numbers."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.cells = counts.shape[1]
        self.known = counts.sum(axis=0) > 0
        smooth = counts + SMOOTHING
        self.likelihood = (smooth / smooth[:, self.known].sum(axis=1, keepdims=True)).T.astype(np.float32)

    def proportions(self, text: str | None) -> np.ndarray | None:
        """Share of every language in the text; None for a text without letters."""
        if not text or not self.languages or not LETTER.search(text):
            return None
        codes, counts = np.unique(grams(text, self.cells), return_counts=True)
        known = self.known[codes]
        codes, counts = codes[known], counts[known].astype(np.float64)
        if not len(codes):
            return np.full(len(self.languages), 1 / len(self.languages))
        p = self.likelihood[codes].astype(np.float64)
        # Scaling a row changes neither shares nor differences of likelihoods.
        p /= p.max(axis=1, keepdims=True)
        return self._select(p, counts)

    def _select(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        price = PENALTY * np.log(1 + counts.sum())
        single = counts @ np.log(p)
        chosen, level = [int(single.argmax())], float(single.max())
        shares = np.eye(len(single))[chosen[0]]
        # What all languages together can gain bounds what any set of them can.
        if len(single) == 1 or self._fit(p, counts)[1] - level < price:
            return shares
        while len(chosen) < len(single):
            trials = [(*self._fit(p[:, [*chosen, i]], counts), i) for i in range(len(single)) if i not in chosen]
            weights, gained, best = max(trials, key=lambda x: x[1])
            if gained - level < price:
                break
            chosen, level = [*chosen, best], gained
            shares = np.zeros(len(single))
            shares[chosen] = weights
        return shares

    @staticmethod
    def _fit(p: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
        """Expectation-maximisation of the shares; returns them and the log-likelihood."""
        shares, total = np.full(p.shape[1], 1 / p.shape[1]), counts.sum()
        for _ in range(ROUNDS):
            mixed = p @ shares
            new = shares * (p.T @ (counts / mixed)) / total
            moved, shares = np.abs(new - shares).max(), new
            if moved < TOLERANCE:
                break
        return shares, float(counts @ np.log(p @ shares))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learn from all rows with a text and a language. Only names and counts, bounded by ``MODEL_CELLS``, reach the driver.

    With more than ``MODEL_CELLS >> GRAM_BITS`` (16) languages, trigrams share cells so that the model stays as large; more than
    ``MODEL_CELLS >> 8`` (16,384) raise an error. A table without such rows, an empty one too, gives a model of no languages,
    under which every text is ``und``. Repeated rows count again.
    """
    rows = labelled.select(column(labelled, text).alias("text"), column(labelled, lang).alias("lang")).dropna()
    bound_batches(labelled.sparkSession)
    most = MODEL_CELLS >> 8
    languages = sorted(r[0] for r in rows.select("lang").distinct().limit(most + 1).collect())
    if len(languages) > most:
        raise ValueError(f"more than {most} languages")
    if not languages:
        return Model([], np.zeros((0, 1), np.int64))
    cells = 1 << min(GRAM_BITS, (MODEL_CELLS // len(languages)).bit_length() - 1)
    found = count_grams(rows, languages, cells).toPandas()
    counts = np.zeros((len(languages), cells), np.int64)
    counts[found["language"], found["gram"]] = found["n"]
    return Model(languages, counts)


def detect(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``: the language of the largest share of each whole text, and that share.

    Null texts and texts without a letter are ``und`` with score 0; a text none of whose trigrams was ever seen goes to the
    first language with equal shares. Nothing but the text is an input. Names that clash get underscores.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        known = shared.value
        out = []
        for value in texts:
            shares = known.proportions(value)
            best = None if shares is None else int(shares.argmax())
            out.append((UNKNOWN, 0.0) if best is None else (known.languages[best], float(min(1.0, shares[best]))))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    found, pred, score = free_name(docs, "found", "lang_pred", "score")
    out = docs.withColumn(found, predict(column(docs, text)))
    return out.withColumns({pred: F.col(found)["lang_pred"], score: F.col(found)["score"]}).drop(found)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: CRC-32 of its id modulo 3 is 1; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
