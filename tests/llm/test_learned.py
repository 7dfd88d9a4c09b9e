"""Quality, language, mixing and the pipeline."""

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakeloom.llm import importance, multi_index, raking, runs, zstd_language
from lakeloom.llm.queries import QUERIES
from lakeloom.llm.shared import settle
from tests.conftest import SF, rows

ODD = [None, "", "   ", "1234 !!", "a", "The words of a text", "The words of a text", "long one " * 40_000, "Ünïcödé ß"]


def frame(spark, texts, ids=None):
    """Columns that operators add are there already."""
    ids = list(range(len(texts))) if ids is None else ids
    data = [(i, t, None if k % 3 == 0 else "s", None if k % 4 == 0 else "en", 7, "x") for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(data, "doc_id long, text string, source string, lang string, kept int, key string")


def labels(spark, values):
    return spark.createDataFrame(values, "doc_id long, quality int")


# --- quality -------------------------------------------------------------------------------


def test_runs_have_equal_hashes_wherever_they_stand():
    a = runs.runs("one, two  one!! two".encode())
    assert [a[2].tolist(), (a[1] - a[0]).tolist()] == [[1, 2, 1, 1, 2, 1], [3, 1, 3, 3, 2, 3]]
    assert a[3][0] == a[3][3] and a[3][2] == a[3][5] and len(set(a[3].tolist())) == 4
    was, runs.STRETCH = runs.STRETCH, 7
    try:
        again = runs.runs("one, two  one!! two".encode())
    finally:
        runs.STRETCH = was
    assert all(np.array_equal(x, y) for x, y in zip(a, again))


def plain_weights(spark, model_docs, known):
    """Log weight of each document from plainly counted grams."""
    raw, target = collections.Counter(), collections.Counter()
    grams = {i: importance.grams(t).tolist() for i, t in model_docs}
    for i, own in grams.items():
        raw.update(own)
        if known.get(i):
            target.update(own)
    n, m, pseudo = sum(raw.values()), sum(target.values()), importance.SHRINK * importance.BUCKETS
    ratio = {}
    for g, c in raw.items():
        share = (c + 1e-9) / (n + importance.BUCKETS * 1e-9)
        odds = (target[g] + pseudo * share) / (m + pseudo) / share
        ratio[g] = np.log((1 - importance.MIXED) * odds + importance.MIXED)
    return {i: sum(ratio[g] for g in own) for i, own in grams.items()}


def test_weights_of_the_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    quality = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect()}
    expected = plain_weights(spark, [tuple(r) for r in docs.select("doc_id", "text").collect()], quality)
    found = {r.doc_id: r for r in QUERIES["op2_importance_resampling"](spark, SF).collect()}
    assert found.keys() == expected.keys()
    assert all(abs(found[i].log_weight - w) < 1e-6 * (1 + abs(w)) for i, w in expected.items())
    cut = min(r.key for r in found.values() if r.kept)
    assert all(r.kept == (r.key >= cut) for r in found.values())


def test_good_documents_stay_and_bad_ones_go(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    quality = spark.read.parquet(f"{sf}/labels.parquet")
    shares = QUERIES["op2_importance_resampling"](spark, sf).join(quality, "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int"))
    )
    kept = {r[0]: r[1] for r in shares.collect()}
    assert kept[1] > 0.97 and kept[0] < 0.1


@pytest.mark.parametrize("k", [0, 1, 40, 199, 200, 500])
def test_the_k_largest_keys_are_kept(spark, k):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = importance.resample(docs, spark.read.parquet(f"{SF}/labels.parquet"), k).collect()
    order = sorted((r.key for r in found), reverse=True)
    chosen = sorted((r.key for r in found if r.kept), reverse=True)
    if k and k < len(order):
        assert chosen == [x for x in order if x >= order[k - 1]]
    else:
        assert len(chosen) == (len(order) if k else 0)


def test_gumbel_keys_sample_in_proportion_to_weights(spark):
    noise = spark.range(20_000).select(F.xxhash64("id")).toPandas().iloc[:, 0].to_numpy()
    one, other = importance._gumbel(noise[:10_000]), importance._gumbel(noise[10_000:])
    assert abs((np.log(3) + one > other).mean() - 0.75) < 0.02


def test_kth_largest_with_ties(spark):
    df = spark.createDataFrame([(float(x),) for x in [5] * 2000 + [7, 7, 9] + [-1] * 10], "key double")
    assert [importance.kth_largest(df, k) for k in (1, 2, 3, 4, 2003, 2004)] == [9, 7, 7, 5, 5, -1]
    assert importance.kth_largest(df, 2013) is None


def test_quality_of_odd_rows(spark):
    df = frame(spark, ODD, [0, 1, 2, None, 4, 5, 5, 7, 8])
    found = importance.resample(df, labels(spark, [(5, 1), (5, None), (2, 0), (None, 1)]))
    assert found.count() == len(ODD)
    assert {r.log_weight for r in found.filter("doc_id in (0, 1, 2)").collect()} == {0.0}
    assert found.filter("doc_id = 5").select("key").distinct().count() == 1
    everything = importance.resample(df, labels(spark, []))
    assert everything.filter("kept").count() == len(ODD)
    assert importance.resample(df.limit(0), labels(spark, [(5, 1)])).count() == 0


# --- language ------------------------------------------------------------------------------


def test_languages_of_the_query(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    found = QUERIES["op6_zstd_language"](spark, sf).collect()
    assert sorted(r.doc_id for r in found) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_predictions_come_from_the_text_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    own = zstd_language.learn(docs)
    one = zstd_language.judged(docs, own).select("doc_id", "lang_pred", "score")
    other = zstd_language.judged(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)), own)
    assert rows(one) == rows(other.select("doc_id", "lang_pred", "score"))


def test_nothing_is_learned_from_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    changed = F.when(zstd_language.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))
    assert rows(zstd_language.predict(docs)) == rows(zstd_language.predict(docs.withColumn("lang", changed)))


def test_language_of_odd_rows(spark):
    df = frame(spark, [*ODD, "more words of a text"], [0, 1, 2, None, 4, 5, 5, 7, 8, None])
    found = zstd_language.predict(df)
    und = {r.doc_id for r in found.filter("lang_pred = 'und'").collect()}
    assert und == {0, 1, 2, None} and found.count() == len(ODD) + 1
    assert zstd_language.predict(df.withColumn("lang", F.lit(None).cast("string"))).filter("lang_pred != 'und'").count() == 0
    assert zstd_language.predict(df.limit(0)).count() == 0
    judged = zstd_language.judged(df.withColumn("score", F.lit("mine")), {"en": b"the words of a text"})
    assert judged.filter(zstd_language.rejected()).count() == 4


def test_a_language_of_copies_has_a_dictionary(spark):
    """Whatever the hash of the one text is, also among rows of a language with many texts."""
    texts = {f"l{i}": f"{w} only words of this language {w} {w}" for i, w in enumerate("abelu kodri mintas ferrog sulipe".split())}
    df = spark.createDataFrame(list(texts.items()), "lang string, text string")
    copies = df.crossJoin(spark.range(10_000)).select("lang", "text")
    varied = spark.range(9000).select(F.lit("en").alias("lang"), F.concat(F.lit("the number "), F.sha1(F.col("id").cast("string"))).alias("text"))
    found = zstd_language.learn(copies.union(varied))
    assert {name: found.get(name) for name in texts} == {name: zstd_language.plain(t) for name, t in texts.items()}
    assert found["en"].count(b"the number") == zstd_language.SAMPLE_TEXTS


# --- mixing --------------------------------------------------------------------------------


def plain_targets(seen, keep):
    """Shares to the power FLATTEN, none above FULL of what a sample of ``keep`` could take; the rest is shared out."""
    total = sum(seen.values())
    most = {v: t / total / keep * raking.FULL for v, t in seen.items()}
    flat, full = {v: t**raking.FLATTEN for v, t in seen.items()}, set()
    while True:
        left = 1 - sum(most[v] for v in full)
        scale = left / sum(f for v, f in flat.items() if v not in full)
        more = {v for v, f in flat.items() if v not in full and f * scale > most[v]}
        if not more:
            return {v: most[v] if v in full else f * scale for v, f in flat.items()}
        full |= more


def margins(both, amount):
    """Shares of the amounts by source, language and topic."""
    total = sum(map(amount, both))
    out = [collections.Counter() for _ in range(3)]
    for r in both:
        for d, v in enumerate((r.source, r.lang, r.topic)):
            out[d][v] += amount(r) / total
    return out


def check_margins(both, tolerance, sampled):
    """Expected shares are the targets; those of the rows kept are so within what drawing allows."""
    targets = [
        plain_targets({v: t for v, t in m.items()}, raking.KEEP) for m in margins(both, lambda r: r.tokens)
    ]
    for wanted, expected, kept in zip(targets, margins(both, lambda r: r.tokens * r.probability), margins(both, lambda r: r.tokens * r.kept)):
        assert all(abs(expected[v] / w - 1) < tolerance for v, w in wanted.items())
        assert all(abs(kept[v] - w) < sampled for v, w in wanted.items())
    assert all(0 < r.probability <= 1 for r in both) and max(r.margin_off for r in both) <= raking.TOLERANCE
    assert abs(sum(r.tokens * r.probability for r in both) / sum(r.tokens for r in both) - raking.KEEP) < 0.01


def test_mixing_of_the_query(spark):
    """Production parameters: shares of source, language and topic in the sample follow their targets."""
    sf = SF.replace("sf0.001", "sf0.01")
    found = QUERIES["op7_raked_mixing"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    both = found.join(docs.select("doc_id", "source", "lang", "text"), "doc_id").collect()
    for r in both:
        tokens, topic = raking._counted(r.text)
        assert (r.tokens, r.topic) == (max(1, tokens), topic)
    check_margins(both, 0.01, 0.06)
    # a probability is one factor for each value of a cell, cut at 1: two by two cells agree
    odds = {(r.source, r.lang, r.topic): r.probability for r in both if r.probability < 1}
    checked = 0
    for (s, lang, topic), p in odds.items():
        for other in {c[0] for c in odds} - {s}:
            for topic2 in {c[2] for c in odds} - {topic}:
                square = [odds.get(c) for c in ((other, lang, topic2), (other, lang, topic), (s, lang, topic2))]
                if None not in square:
                    assert p * square[0] == pytest.approx(square[1] * square[2], rel=1e-6)
                    checked += 1
    assert checked > 100


def test_mixing_with_a_hot_source(spark):
    docs = spark.read.parquet(f"{SF.replace('sf0.001', 'sf0.01')}/documents.parquet")
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))
    check_margins(raking.mixed(docs).collect(), 0.01, 0.06)


def test_given_targets_are_met(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"),
        F.when(F.col("id") % 5 < 2, "en").when(F.col("id") % 5 == 3, "fr").alias("lang"),
        F.lit("some words here").alias("text"),
    )
    goals = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.2, "fr": 0.3, None: 0.5}}
    kept = raking.mixed(docs, targets=goals, keep=0.3).filter("kept")
    n = kept.count()
    assert abs(kept.filter("source = 'a'").count() / n - 0.5) < 0.06
    assert abs(kept.filter("lang is null").count() / n - 0.5) < 0.06
    with pytest.raises(ValueError, match="target"):
        raking.mix(docs, targets={"source": {"nowhere": 1.0}})


def test_mixing_of_odd_rows(spark):
    df = frame(spark, ODD, [0, 1, 2, None, 4, 5, 5, 7, 8])
    found = raking.mixed(df)
    assert found.count() == len(ODD) and found.filter("probability is null or probability > 1").count() == 0
    assert found.filter("doc_id = 5").select("kept").distinct().count() <= 2
    assert raking.mixed(df, keep=1.0).filter("not kept").count() == 0
    assert raking.mixed(df.limit(0)).count() == 0


def test_a_step_of_raking_is_one_join(spark, monkeypatch):
    """Plans do not grow with the dimensions: what the driver holds of them does not either."""
    joins = []

    def seen(df, label):
        joins.append((label, df._jdf.queryExecution().optimizedPlan().toString().count("Join ")))
        return settle(df, label)

    monkeypatch.setattr(raking, "settle", seen)
    df = frame(spark, ["some words here", "other words", "more of them there"] * 4, list(range(12)))
    raking.mixed(df.withColumn("source", F.col("doc_id") % 3).withColumn("lang", F.col("doc_id") % 2))
    steps = [n for label, n in joins if label.startswith("raked-")]
    assert len(steps) >= 3 and max(steps) == 1


# --- pipeline ------------------------------------------------------------------------------


def test_pipeline_stages_take_effect(spark):
    """Each stage against what its operator says of the rows that it was given."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    given = docs
    for name, stage in corpus_pipeline.STAGES:
        found = settle(stage(spark, given, SF), f"test-{name}")
        if name == "packing":
            assert found.select("doc_id").distinct().count() == given.count()
            break
        assert found.columns == columns and found.subtract(given).count() == 0
        kept = {r[0] for r in found.select("doc_id").collect()}
        if name == "near_copies":
            groups = multi_index.near_copies(given).collect()
            assert kept == {r.component_id for r in groups}
        if name == "quality":
            says = importance.resample(given, spark.read.parquet(f"{SF}/labels.parquet")).filter("kept")
            assert kept == {r.doc_id for r in says.collect()}
        if name == "mixing":
            assert kept == {r.doc_id for r in raking.mix(given).filter("kept").collect()}
        assert found.count() > 0
        given = found
    whole = corpus_pipeline.run(spark, SF)
    assert rows(whole.select("doc_id", "start", "length", "ids_crc32")) == rows(
        found.select("doc_id", "start", "length", "ids_crc32")
    )


def test_pipeline_stages_on_odd_rows(spark):
    df = frame(spark, [*ODD, "The words of a text"], [0, 1, 2, None, 4, 5, 5, 7, 8, 5]).withColumn("document", F.lit(1))
    for name, stage in corpus_pipeline.STAGES:
        for given in (df, df.limit(0)):
            found = stage(spark, given, SF)
            if name != "packing":
                assert found.columns == df.columns and found.count() <= given.count()
            elif given is not df:
                assert found.count() == 0
