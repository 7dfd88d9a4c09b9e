"""Language of a text by compression.

Each language has a raw-content zstandard dictionary made of training text. A text is cut into
blocks, every block of it is compressed with every dictionary, and the language whose dictionary
needs the fewest bytes in all is chosen. The score is the share of bytes saved against the second
best; a text with a smaller score than a given margin can be rejected.
"""

from __future__ import annotations

import functools
import re
import string

import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.shared import col

#: bytes of training text in a dictionary; the sample of each language is bounded by it
DICTIONARY_BYTES = 256 << 10
#: texts of a language that are looked at for its dictionary
SAMPLE_TEXTS = 400
#: a block is compressed on its own, so that a long text does not become its own dictionary
BLOCK_BYTES = 2048
LEVEL = 5

UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_OTHER = bytes(b if chr(b) in string.ascii_letters or b >= 128 else 32 for b in range(256))


def plain(text: str | None) -> bytes:
    """Lower-case letters of the text, one space between words; empty if it has no letter."""
    if not text or not _LETTER.search(text):
        return b""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_OTHER).split())


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, on which nothing is learned."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    dictionary_bytes: int = DICTIONARY_BYTES,
    sample_texts: int = SAMPLE_TEXTS,
) -> dict[str, bytes]:
    """Dictionary of each non-null language, the most common first, from a bounded sample of texts.

    The sample is the distinct texts of smallest hash, cut only where the dictionary is full; the driver
    holds ``dictionary_bytes`` for each language.
    """
    known = labelled.select(col(lang).cast("string").alias("lang"), col(text).cast("string").alias("text"))
    known = known.filter("lang is not null and text is not null")
    known = known.withColumn("mark", F.xxhash64("text"))
    texts_of = known.groupBy("lang", "mark").agg(F.count("*").alias("copies")).groupBy("lang")
    counted = texts_of.agg(F.sum("copies").alias("copies"), F.count("*").alias("distinct_texts")).collect()
    common = sorted((-r["copies"], r["lang"]) for r in counted)
    # hashes are even, so a share of the distinct ones holds the smallest, however often a text is repeated
    share = F.lit(1.0)
    for r in counted:
        part = min(1.0, 8 * sample_texts / r["distinct_texts"])
        share = F.when(F.col("lang") == r["lang"], F.lit(part)).otherwise(share)
    few = known.filter(F.shiftrightunsigned("mark", 11) / F.lit(float(1 << 53)) < share)
    few = few.groupBy("lang", "mark").agg(F.min("text").alias("text"))
    ranked = few.withColumn(
        "place", F.row_number().over(Window.partitionBy("lang").orderBy(F.shiftrightunsigned("mark", 11), "mark"))
    ).filter(F.col("place") <= sample_texts)
    # no more text leaves a task than the dictionary can hold
    before = Window.partitionBy("lang").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    taken = (
        ranked.withColumn("before", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0)))
        .filter(F.col("before") < 2 * dictionary_bytes)
        .select("lang", "place", F.substring("text", 1, dictionary_bytes).alias("text"))
    )
    texts: dict[str, list[bytes]] = {}
    for name, _, sample in sorted(tuple(r) for r in taken.collect()):
        texts.setdefault(name, []).append(plain(sample))
    joined = {name: b" ".join(dict.fromkeys(texts[name]))[:dictionary_bytes] for _, name in common if name in texts}
    return {name: content for name, content in joined.items() if content}


class Judge:
    def __init__(self, dictionaries: tuple[tuple[str, bytes], ...]):
        self.names = [name for name, _ in dictionaries]
        self.compress = []
        for _, content in dictionaries:
            made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(level=LEVEL)
            packer = zstandard.ZstdCompressor(
                level=LEVEL, dict_data=made, write_checksum=False, write_content_size=False, write_dict_id=False
            )
            self.compress.append(packer.compress)

    def __call__(self, text: str | None) -> tuple[str, float, int]:
        letters = plain(text)
        if not letters or not self.names:
            return UNKNOWN, 0.0, len(letters)
        blocks = [letters[at : at + BLOCK_BYTES] for at in range(0, len(letters), BLOCK_BYTES)]
        sizes = [sum(len(compress(block)) for block in blocks) for compress in self.compress]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.names[0], 1.0, len(letters)
        second = min(size for i, size in enumerate(sizes) if i != best)
        return self.names[best], 1.0 - sizes[best] / second, len(letters)


_FOUND = ("lang_pred", "score", "letters")


@functools.lru_cache(maxsize=2)
def _judge(dictionaries: tuple[tuple[str, bytes], ...]) -> Judge:
    return Judge(dictionaries)


def judged(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and letters (bytes of them that were compressed).

    Columns of these names are replaced. The most common language wins a tie, with score 0. Null texts and texts
    without a letter are ``und`` with score 0. All columns but the text stay untouched, and
    nothing but the text is looked at.
    """
    order = tuple(dictionaries.items())

    @F.pandas_udf("lang_pred string, score double, letters long")
    def judge(texts):
        import pandas as pd

        call = _judge(order)
        return pd.DataFrame([call(t) for t in texts], columns=list(_FOUND))

    names = [c for c in docs.columns if c not in _FOUND]
    found = docs.select(*[col(c) for c in names], judge(col(text).cast("string")).alias("judged_text"))
    return found.select(*[col(c) for c in names], *(f"judged_text.{c}" for c in _FOUND))


def rejected(min_score: float = 0.004, enough: int = 100) -> Column:
    """Texts without a language, and those of ``enough`` letters whose margin is narrow all the same.

    A narrow margin says nothing of a shorter text.
    """
    narrow = (F.col("score") < min_score) & (F.col("letters") >= enough)
    return (F.col("lang_pred") == UNKNOWN) | narrow


def predict(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learned from those not held out.

    Rows without a doc_id are not held out. Without any labelled text every prediction is
    ``und``. Repeated rows stay repeated; an empty table gives none.
    """
    kept = docs.select(col(doc_id).alias("doc_id"), col(text).cast("string").alias("text"), col(lang).alias("lang"))
    kept = kept.withColumn("held_out", held_out(F.col("doc_id")))
    dictionaries = learn(kept.filter("not held_out"))
    return judged(kept.select("doc_id", "held_out", "text"), dictionaries).drop("text", "letters")
