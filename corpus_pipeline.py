"""From raw documents to packed token sequences: five stages over whole tables.

Each stage is written to the shared folder and read again as the next one's documents. All but
the last return the columns of the documents they are given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import importance, multi_index, raking, sum_squares, zstd_language
from lakeloom.llm.shared import bounded_batches, col, settle, table
from lakeloom.llm.tokens import default_tokenizer

_OWN = ("doc_id", "text", "source", "lang")


def _rows(docs: DataFrame) -> DataFrame:
    """Each document whole, in one column, beside the columns that the operators look at."""
    whole = F.struct(*[col(c) for c in docs.columns]).alias("document")
    return docs.select(whole, *[col(c) for c in _OWN])


def _kept(decided: DataFrame, condition: Column | str) -> DataFrame:
    return decided.filter(condition).select("document.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling towards the documents that are labelled good."""
    bounded_batches(spark)
    model = importance.fit(docs, table(spark, sf_dir, "labels"))
    return _kept(importance.scored(_rows(docs), model), "kept")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the dictionaries tell; nothing is learned from the held-out quarter."""
    bounded_batches(spark)
    known = docs.filter(~zstd_language.held_out(col("doc_id")))
    judged = zstd_language.judged(_rows(docs), zstd_language.learn(known))
    return _kept(judged, ~zstd_language.rejected())


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles are linked within two bits."""
    bounded_batches(spark)
    return multi_index.one_of_each(docs, words=3, distance=2)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow flattened shares of source, language and topic."""
    bounded_batches(spark)
    return _kept(raking.mixed(_rows(docs)), "kept")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2048 ids."""
    bounded_batches(spark)
    return sum_squares.pack(docs, default_tokenizer())


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_copies", near_copies),
    ("mixing", mixing),
    ("packing", packing),
]

#: tokenizers, compression and hashed models are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
