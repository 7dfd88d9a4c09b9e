"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted in cells of source, language and topic. The cells' weights are raked: one
dimension after the other is scaled to its target shares until all agree. A cell's calibrated
weight over its tokens, scaled to the wanted amount of text, is the probability with which each of
its documents is kept. Cells, not documents, go through the rounds, as Spark joins over a written
table; nothing but a few sums reaches the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.runs import runs
from lakeloom.llm.shared import col, settle

TOPICS = 16
#: letters, digits and bytes above 127 that make a content word
LONG_WORD = 5
#: target shares are the observed ones to this power, then scaled to one
FLATTEN = 0.7
SWEEPS = 20
#: how far a margin of the sample may be off its target, as a share of it
TOLERANCE = 5e-3
#: share of all tokens that the sample keeps, where the targets allow it
KEEP = 0.5
#: a value of a dimension is asked for no larger a part of its tokens; with less room raking hardly converges
FULL = 0.9


def _counted(text: str | None) -> tuple[int, int]:
    """Words, and the topic: that of the content word most often used (of ties the smallest hash)."""
    start, end, kind, hashes = runs((text or "").encode("utf-8", "surrogatepass"))
    word = kind == 1
    content = hashes[word & (end - start >= LONG_WORD)]
    if not len(content):
        return int(word.sum()), -1
    distinct, times = np.unique(content, return_counts=True)
    return int(word.sum()), int(distinct[times.argmax()] % np.uint64(TOPICS))


def described(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with tokens and topic; columns of these names are replaced.

    A document has at least one token; topic -1 is that of texts without a content word, null
    and empty ones among them.
    """

    @F.pandas_udf("tokens long, topic int")
    def describe(texts):
        import pandas as pd

        found = pd.DataFrame([_counted(t) for t in texts], columns=["tokens", "topic"])
        found["tokens"] = found["tokens"].clip(lower=1)
        return found

    names = [c for c in docs.columns if c not in ("tokens", "topic")]
    found = docs.select(*[col(c) for c in names], describe(col(text).cast("string")).alias("described_text"))
    return found.select(*[col(c) for c in names], "described_text.tokens", "described_text.topic")


def _bounded(seen: DataFrame, keep: float) -> DataFrame:
    """Flattened shares, none above what its texts can give to a sample of ``keep``: what is cut off goes to the others.

    ``seen`` has tokens and share (not scaled); the shares come back scaled to one.
    """
    total, flat = seen.agg(F.sum("tokens"), F.sum("share")).first()
    if not total:
        return seen
    most = F.col("tokens") / F.lit(float(total)) * F.lit(max(FULL, keep) / keep)
    scale = 1 / flat
    for _ in range(100):
        full = F.col("share") * scale >= most
        held, free = seen.agg(
            F.sum(F.when(full, most).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("share")))
        ).first()
        if not free:
            break
        again = max(0.0, 1 - held) / free
        if abs(again - scale) <= 1e-12 * scale:
            break
        scale = again
    return seen.withColumn("share", F.least(F.col("share") * F.lit(scale), most))


def _targets(cells: DataFrame, dimension: str, wanted: Mapping | None, flatten: float, keep: float) -> DataFrame:
    """(value, tokens, share) of a dimension: as given (values that are not named get nothing), else flattened."""
    spark = cells.sparkSession
    seen = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").cast("double").alias("tokens"))
    if wanted is None:
        seen = settle(seen.withColumn("share", F.pow("tokens", F.lit(flatten))), f"flat-{dimension}")
        return settle(_bounded(seen, keep), f"target-{dimension}")
    given = spark.createDataFrame(
        [(None if v is None else str(v), float(x)) for v, x in wanted.items()], "named string, given double"
    )
    seen = seen.join(given, F.col("value").cast("string").eqNullSafe(F.col("named")), "left").select(
        "value", "tokens", F.coalesce("given", F.lit(0.0)).alias("share")
    )
    total = seen.agg(F.sum("share")).first()[0] or 0.0
    if not total:
        raise ValueError(f"no document has a {dimension} with a target")
    return settle(seen.withColumn("share", F.col("share") / F.lit(total)), f"target-{dimension}")


def _scaled(raked: DataFrame, dimension: str, size: float) -> DataFrame:
    """``raked`` with free scaled to the margin of a dimension, and off at least what that was off before."""
    uncut = F.col("free") < 1
    margin = raked.groupBy(F.col(dimension).alias("value")).agg(
        F.sum(F.least(F.col("free"), F.lit(1.0)) * F.col("tokens")).alias("given"),
        F.sum(F.when(uncut, 0.0).otherwise(F.col("tokens"))).alias("held"),
        F.sum(F.when(uncut, F.col("free") * F.col("tokens")).otherwise(0.0)).alias("moved"),
        F.max(f"{dimension}_share").alias("share"),  # the same in all cells of a value
    )
    asked = F.col("share") * F.lit(size)
    up = F.greatest(F.coalesce(F.try_divide(asked - F.col("held"), "moved"), F.lit(1.0)), F.lit(1.0))
    factor = F.when(F.col("given") < asked, up).otherwise(F.coalesce(F.try_divide(asked, "given"), F.lit(0.0)))
    away = F.when(asked > 0, F.abs(F.col("given") / asked - 1)).otherwise(0.0)
    factors = margin.select("value", factor.alias("factor"), away.alias("away"))
    kept = [col(c) for c in raked.columns if c not in ("free", "off")]
    return raked.join(factors, F.col(dimension).eqNullSafe(F.col("value"))).select(
        *kept, (F.col("free") * F.col("factor")).alias("free"), F.greatest("off", "away").alias("off")
    )


def rake(
    cells: DataFrame,
    targets: Mapping[str, DataFrame],
    keep: float = KEEP,
    sweeps: int = SWEEPS,
    tolerance: float = TOLERANCE,
) -> tuple[DataFrame, float]:
    """``cells`` (the dimensions, tokens) with ``probability`` and ``weight``, and how far the worst margin is off.

    The expected tokens of the sample are raked, under the bound that no cell gives more than it
    has: a probability is a product of one factor for each value of the cell, cut at 1, and the
    factors are set in turn so that the sample's margins are the targets. The sample holds ``keep``
    of all tokens, or less if a value's target could not be met from its texts otherwise. Stops
    when no margin is off by more than ``tolerance`` of its target, or after ``sweeps``; targets that
    the cells cannot meet together leave a worst margin above the tolerance. Null is a value like
    any other. The weight is the cell's share of the sample's expected tokens.
    """
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return cells.withColumns({"probability": F.lit(0.0), "weight": F.lit(0.0)}), 0.0
    size = keep * total
    for target in targets.values():
        least = target.filter("share > 0").agg(F.min(F.col("tokens") / F.col("share"))).first()[0]
        # equal only where targets are bounded by this amount already
        size = min(size, least if least >= size * (1 - 1e-9) else least * FULL)
    names = [col(c) for c in cells.columns]
    raked, worst = cells.withColumn("free", F.lit(size / total)), 0.0
    for dimension, target in targets.items():
        shares = target.select("value", F.col("share").alias(f"{dimension}_share"))
        raked = raked.join(shares, F.col(dimension).eqNullSafe(F.col("value"))).drop("value")
    raked = settle(raked, "cells-asked")
    for sweep in range(sweeps):
        raked = raked.withColumn("off", F.lit(0.0))
        for dimension in targets:  # each written, or the plan of a sweep would double with each dimension
            raked = settle(_scaled(raked, dimension, size), f"raked-{sweep}-{dimension}")
        worst = raked.agg(F.max("off")).first()[0]
        if worst <= tolerance:
            break
    chance_of = F.least(F.col("free"), F.lit(1.0))
    sample = raked.agg(F.sum(chance_of * F.col("tokens"))).first()[0]
    return raked.select(
        *names, chance_of.alias("probability"), F.coalesce(F.try_divide(chance_of * F.col("tokens"), F.lit(sample)), F.lit(0.0)).alias("weight")
    ), worst


def chance(*columns: Column) -> Column:
    """A number from 0 to 1 that the columns' values alone decide."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def mixed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    targets: Mapping[str, Mapping] | None = None,
    flatten: float = FLATTEN,
    keep: float = KEEP,
    seed: int = 0,
) -> DataFrame:
    """``docs`` with tokens, topic, weight (calibrated share of its cell), probability, kept and margin_off.

    Columns of these names are replaced. ``targets`` may give the wanted shares of ``source``,
    ``lang`` or ``topic`` by value; a dimension without them gets its observed shares flattened, as
    far as its texts suffice. margin_off, the same in all rows, is how far the worst of the
    sample's expected shares is from its target, as a part of it.
    Null sources and languages are values like any other. Whether a row is kept depends on its
    doc_id and text alone, so repeated rows stay or go together. An empty table gives none.
    """
    added = ("tokens", "topic", "weight", "probability", "kept", "margin_off")
    rows = described(docs.select(*[col(c) for c in docs.columns if c not in added]), text)
    dimensions = {"mix_source": col(source), "mix_lang": col(lang), "mix_topic": F.col("topic")}
    cells = settle(
        rows.groupBy(*[c.alias(n) for n, c in dimensions.items()]).agg(F.sum("tokens").alias("tokens")), "cells"
    )
    given = targets or {}
    goals = {n: _targets(cells, n, given.get(n.removeprefix("mix_")), flatten, keep) for n in dimensions}
    raked, worst = rake(cells, goals, keep)
    shares = settle(raked.select(*dimensions, "weight", "probability"), "shares")
    match = None
    for name, column in dimensions.items():
        one = column.eqNullSafe(F.col(name))
        match = one if match is None else match & one
    names = [c for c in docs.columns if c not in added]
    drawn = chance(F.lit(seed), col(doc_id), F.xxhash64(col(text)))
    return rows.join(shares, match, "left").select(
        *[col(c) for c in names], "tokens", "topic", "weight", "probability", (drawn < F.col("probability")).alias("kept"),
        F.lit(float(worst)).alias("margin_off"),
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """doc_id, tokens, topic, weight, probability, kept and margin_off of every row."""
    return mixed(docs, doc_id, **options).select(
        col(doc_id).alias("doc_id"), "tokens", "topic", "weight", "probability", "kept", "margin_off"
    )
