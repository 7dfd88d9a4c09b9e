"""Registered queries of the operators in this package, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import (
    clause_grammar,
    importance,
    lyndon_runs,
    main_region,
    multi_index,
    nn_descent,
    raking,
    re_pair,
    spill_count,
    sum_squares,
    syncmers,
    warc,
    zstd_language,
)
from lakeloom.llm.shared import table
from lakeloom.llm.tokens import default_tokenizer

Query = Callable[[SparkSession, str], DataFrame]


def op1_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_edits(table(spark, sf_dir, "documents"))


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_re_pair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return re_pair.round_trip(table(spark, sf_dir, "documents"), default_tokenizer())


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op5_main_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_region.extract(table(spark, sf_dir, "pages"))


def op6_zstd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zstd_language.predict(table(spark, sf_dir, "documents"))


def op7_raked_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raking.mix(table(spark, sf_dir, "documents"))


def op8_multi_index_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_copies(table(spark, sf_dir, "documents"))


def op9_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sum_squares.pack(table(spark, sf_dir, "documents"), default_tokenizer())


def op10_sharded_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages"), revisit_bytes=0)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_spill_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spill_count.align(table(spark, sf_dir, "documents"))


def op12_clause_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clause_grammar.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lyndon_runs.detect(table(spark, sf_dir, "documents"), planted=True)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_closed_syncmers,
        op2_importance_resampling,
        op3_re_pair_ids,
        op4_nn_descent,
        op5_main_region,
        op6_zstd_language,
        op7_raked_mixing,
        op8_multi_index_simhash,
        op9_sum_of_squares_packing,
        op10_sharded_warc,
        op11_spill_counting,
        op12_clause_grammar,
        op13_lyndon_runs,
    )
}

#: SHA-1 in base32: each five hexadecimal digits are four characters
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGEST = f"""list_aggregate(flatten(list_transform(range(8), lambda i: list_transform(range(4), lambda j:
    substr('{_BASE32}', CAST(((('0x' || substr(hash, 5 * i + 1, 5))::BIGINT >> (15 - 5 * j)) & 31) + 1 AS BIGINT), 1)
))), 'string_agg', '')"""

SQL: dict[str, str] = {
    "op10_sharded_warc": f"""
        WITH hashed AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hash FROM pages
        ), answers AS (SELECT hash, max(page_id) AS response FROM hashed GROUP BY hash)
        SELECT page_id,
            CAST(strlen(payload) AS BIGINT) AS payload_bytes,
            {_DIGEST} AS payload_digest,
            CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id = response THEN NULL ELSE response END AS refers_to
        FROM hashed JOIN answers USING (hash)
    """,
}
