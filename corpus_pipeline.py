"""A corpus pipeline over the table of documents; every stage is written and read back before the next one."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm.common import Scratch, collecting, free_name, load, numbered
from clickweave.llm.exact_dedup import exact_duplicates
from clickweave.llm.langid import UNKNOWN, detect, train
from clickweave.llm.near_copies import near_copies
from clickweave.llm.packing import pack
from clickweave.llm.suffix_dedup import remove_repeats

#: A document needs one language that makes up at least this share of it.
LEAST_SHARE = 0.5
#: Texts this similar over shingles of so many words are near copies.
SHINGLE_WORDS, NEAR = 5, 0.8
#: Byte strings of this length that occur again are removed.
REPEAT_BYTES = 400
#: So are passages of this many words.
REPEAT_WORDS = 51
#: Token ids in a packed sequence.
SEQUENCE_IDS = 1024
#: Row numbers of dropped rows go to every executor up to this many; beyond, they are joined by shuffle.
BROADCAST_ROWS = 2_000_000


def _without_dropped(docs: DataFrame, operator) -> DataFrame:
    """The rows of ``docs`` that ``operator`` marks as kept, with all their columns.

    Rows are numbered, as ids may repeat. The operator sees the id and the text only, so clashing names of other columns
    do not matter. Only the list of dropped rows stays on disk, which the result reads.
    """
    row = free_name(docs, "row_number")
    scratch = Scratch(docs.sparkSession, "dropped")
    docs = numbered(docs, row, scratch)
    with collecting():
        marked = operator(docs.select("doc_id", "text", F.col(row).alias("row_number")), row="row_number")
        dropped = scratch.keep(marked.where(~F.col("kept")).select(F.col("row_number").alias(row)))
    if dropped.count() <= BROADCAST_ROWS:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, row, "left_anti").drop(row)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no text, no letter, or no language that makes up ``LEAST_SHARE`` of them.

    The model is learned from all rows with a text and a ``lang``; predictions see the text only. Where no
    row has a language nothing can be learned, and nothing goes.
    """
    model = train(docs)
    if not model.languages:
        return docs
    pred, score = free_name(docs, "lang_pred", "score")
    found = detect(docs, model)
    return found.where((F.col(pred) != UNKNOWN) & (F.col(score) >= LEAST_SHARE)).drop(pred, score)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (null is empty, A-Z lower-cased) the one with the largest doc_id stays."""
    return _without_dropped(docs, exact_duplicates)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest doc_id stays.

    Near copies have a Jaccard similarity of ``NEAR`` or more over shingles of ``SHINGLE_WORDS`` words, counted on the texts.
    SimHash fingerprints within three bits propose them; bands of minima add the pairs that are as similar but farther apart.
    """
    return _without_dropped(docs, partial(near_copies, words=SHINGLE_WORDS, least=NEAR))


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ``REPEAT_WORDS`` words or more that occur again are cut from the texts, wherever they are.

    However few bytes they have. Texts with long or no words are covered by bytes: strings of ``REPEAT_BYTES`` or more go too.

    Whole characters only are cut. ``n_chars`` follows the text; documents of which nothing is left go, others stay.
    """
    names = free_name(docs, "n_bytes", "n_removed", "n_spans", "kept_sha256")
    found = remove_repeats(docs, REPEAT_BYTES, least_words=REPEAT_WORDS)
    cut = F.col(names[1]) > 0
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(cut, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return found.where(~cut | (F.char_length("text") > 0)).select(*[F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of at most ``SEQUENCE_IDS`` ids."""
    return pack(docs, SEQUENCE_IDS)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", repeat_removal),
    ("best-fit packing", packing),
]

#: Learned models and graph components have no SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; all but the last are written under the shared folder and read back.

    Once a stage's output is written, what the stage read and wrote on its way is dropped. So at any time two outputs at
    most are on disk, and in the end what the returned plan reads.
    """
    docs, scratch = load(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        with collecting():
            docs = scratch.keep(stage(spark, docs, sf_dir))
        scratch.drop(scratch.count - 1)
    return STAGES[-1][1](spark, docs, sf_dir)
