"""Quality by importance resampling.

Two hashed n-gram models are counted: one over all texts (raw), one over texts labelled good
(target). A text's log weight is the log ratio of its probability under both; documents are drawn
without replacement, in proportion to their weights, by adding Gumbel noise to the log weights and
keeping the k largest. Unless k is given it is the number of documents above the key that best
tells good from bad labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.runs import mixed, runs
from lakeloom.llm.shared import col, settle

BUCKETS = 1 << 16
#: labelled documents that the target model and the cut are fitted on, at most
LABELLED = 20_000
#: pseudo-counts of the target model for each bucket, on average; they are spread like the raw text
SHRINK = 20
#: share of raw text in the target model, which bounds what one gram can say against a text
MIXED = 0.01
#: bins of the key in which labels are counted to place the cut
BINS = 4000
#: keys beyond this, either way, count as this when the cut is placed
REACH = 100.0

_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


def grams(text: str | None) -> np.ndarray:
    """Buckets of the words and marks of the text and of their neighbouring pairs."""
    hashes = runs((text or "").encode("utf-8", "surrogatepass"))[3]
    pairs = mixed(hashes[:-1] * _SECOND + hashes[1:])
    return (np.concatenate([hashes, pairs]) & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Log ratio of each bucket, and the smallest key that is kept (None before it is placed)."""

    ratios: np.ndarray
    seed: int = 0
    cut: float | None = None

    def log_weight(self, text: str | None) -> float:
        return float(self.ratios[grams(text)].sum())


def _labels(labels: DataFrame, doc_id: str, quality: str, bound: int) -> dict[int, int]:
    """Quality of at most ``bound`` labelled documents, those of smallest hash.

    A document that is labelled more than once counts as good if the mean is at least a half.
    """
    each = (
        labels.select(col(doc_id).cast("long").alias("doc_id"), col(quality).cast("double").alias("quality"))
        .filter("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    )
    return {r[0]: r[1] for r in each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound).collect()}


def _counted(docs: DataFrame, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each bucket in all texts and in the good ones; each task sends one total a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = np.zeros(BUCKETS, dtype=np.int64)
        target = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            chosen = np.isin(ids, good) & np.asarray(batch.column(0).is_valid())
            for is_good, text in zip(chosen.tolist(), batch.column(1)):
                some = np.bincount(grams(text.as_py()), minlength=BUCKETS)
                raw += some
                if is_good:
                    target += some
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], names=["bucket", "raw", "target"]
        )

    totals = (
        docs.mapInArrow(count, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toPandas()
    )
    raw = np.zeros(BUCKETS)
    target = np.zeros(BUCKETS)
    raw[totals["bucket"]] = totals["raw"]
    target[totals["bucket"]] = totals["target"]
    return raw, target


def _gumbel(noise: np.ndarray) -> np.ndarray:
    """Gumbel noise from 64 hashed bits."""
    uniform = ((noise.view(np.uint64) >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
    return -np.log(-np.log(uniform))


def _noise(doc_id: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), doc_id, F.xxhash64(text))


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    k: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    bound: int = LABELLED,
    seed: int = 0,
) -> Model:
    """Models over all ``docs`` and over the good ones of ``bound`` labelled documents, and the cut.

    Without good labels both models are the same and every weight is 1. Without labels of either
    kind, or with k at least the number of rows, everything is kept.
    """
    kept = _texts(docs, doc_id, text)
    known = _labels(labels, doc_id, quality, bound)
    good = np.array(sorted(d for d, q in known.items() if q), dtype=np.int64)
    raw, target = _counted(kept, good)
    share = (raw + 1e-9) / (raw.sum() + BUCKETS * 1e-9)
    pseudo = SHRINK * BUCKETS
    ratios = (target + pseudo * share) / (target.sum() + pseudo) / share
    ratios = np.log((1 - MIXED) * ratios + MIXED)
    model = Model(ratios, seed)
    if k is not None:
        return Model(ratios, seed, kth_largest(settle(scored(docs, model, doc_id, text).select("key"), "keys"), k))
    return Model(ratios, seed, _best_cut(kept, known, model))


def _best_cut(kept: DataFrame, known: dict[int, int], model: Model) -> float | None:
    """The key that best tells good from bad among the labelled documents (their rates count alike)."""
    ids = np.array(sorted(known), dtype=np.int64)
    is_good = np.array([known[i] for i in ids.tolist()], dtype=np.int64)
    if not is_good.any() or is_good.all():
        return None

    ratios, seed = model.ratios, model.seed

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.isin(batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False), ids)
            some = batch.filter(pa.array(found & np.asarray(batch.column(0).is_valid())))
            weights = np.array([ratios[grams(t.as_py())].sum() for t in some.column(1)], dtype=np.float64)
            keys = weights + _gumbel(some.column(2).to_numpy(zero_copy_only=False).astype(np.int64))
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(keys)], names=["doc_id", "key"])

    marked = kept.withColumn("noise", _noise(F.col("doc_id"), F.col("text"), seed))
    # at most ``bound`` documents, and their repeats, in bins: what reaches the driver is bounded
    near = F.least(F.greatest("key", F.lit(-REACH)), F.lit(REACH))
    bins = marked.mapInArrow(labelled, "doc_id long, key double").select(
        "doc_id", F.floor(near * (BINS / 2 / REACH)).alias("bin")
    )
    named = kept.sparkSession.createDataFrame(list(zip(ids.tolist(), is_good.tolist())), "doc_id long, good int")
    counts = np.zeros((2, BINS + 1))
    tallied = bins.join(named, "doc_id")
    for one, at, n in tallied.groupBy("good", "bin").count().collect():
        counts[one, int(at) + BINS // 2] += n
    if not counts[0].any() or not counts[1].any():
        return None
    lost = np.concatenate([[0], np.cumsum(counts[1])]) / counts[1].sum()
    caught = np.concatenate([[0], np.cumsum(counts[0])]) / counts[0].sum()
    gain = caught - lost
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float((best[len(best) // 2] - BINS // 2) * 2 * REACH / BINS)


def kth_largest(keys: DataFrame, k: int, name: str = "key") -> float | None:
    """The k-th largest value, by counting in ever narrower bins; None if there are no more than k."""
    low, high, n = keys.agg(F.min(name), F.max(name), F.count(name)).first()
    if n <= k:
        return None
    if k <= 0:
        return float("inf")
    above = 0
    while True:
        width = (high - low) / 1024
        inside = keys.filter(F.col(name).between(low, high))
        if not width or low + width == low:
            return low
        bins = inside.groupBy(F.least(F.floor((F.col(name) - low) / width), F.lit(1023)).alias("bin"))
        found = {int(r[0]): r for r in bins.agg(F.count("*"), F.min(name), F.max(name)).collect()}
        for at in sorted(found, reverse=True):
            if above + found[at][1] >= k:
                break
            above += found[at][1]
        _, count, least, most = found[at]
        if least == most:
            return least
        if above + count == k:
            return least
        low, high = least, most


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with log_weight, key and kept; columns of these names are replaced.

    Keys depend on doc_id, text and seed alone, so rows that repeat share them, and rows that tie
    with the k-th are all kept. Null and empty texts have weight 1 (log 0).
    """
    ratios, seed, cut = model.ratios, model.seed, model.cut

    @F.pandas_udf("log_weight double, key double")
    def weigh(texts, noise):
        import pandas as pd

        weights = np.array([ratios[grams(t)].sum() for t in texts], dtype=np.float64)
        return pd.DataFrame({"log_weight": weights, "key": weights + _gumbel(noise.to_numpy(dtype=np.int64))})

    names = [c for c in docs.columns if c not in ("log_weight", "key", "kept")]
    body = col(text).cast("string")
    noise = _noise(col(doc_id).cast("long"), body, seed)
    found = docs.select(*[col(c) for c in names], weigh(body, noise).alias("weighed_text"))
    key = F.col("weighed_text.key")
    kept = F.lit(True) if cut is None else key >= F.lit(cut)
    return found.select(*[col(c) for c in names], "weighed_text.log_weight", "weighed_text.key", kept.alias("kept"))


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, **options) -> DataFrame:
    """doc_id, log_weight, key and kept of every row."""
    names = {n: options[n] for n in ("doc_id", "text") if n in options}
    model = fit(docs, labels, k, **options)
    found = scored(_texts(docs, names.get("doc_id", "doc_id"), names.get("text", "text")), model)
    return found.drop("text")
