"""The clause grammar: composition against the transducers run one after the other, and accuracy."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import clause_grammar as grammar
from tests.conftest import SF

HAND = grammar.Grammar((("idiot", 3.0), ("scum*", 2.0)), tuple(1.0 for _ in range(grammar.FEATURES)), -4.0)


def in_turn(kinds):
    """The three transducers over the whole clause, each on what the one before wrote."""
    state, denied = 0, []
    for kind in kinds:
        state, _, no = grammar._negate(state, kind)
        denied.append(no)
    state, reported = 0, []
    for kind in kinds:
        state, told = grammar._report(state, kind)
        reported.append(told)
    state = grammar._START[2]
    for kind, no, told in zip(kinds, denied, reported):
        state = grammar._clause(state, kind, no, told)
    plain, no, told, directed, threat = state
    if plain or threat:
        return plain, directed, threat, "plain"
    if no or told:
        return (no, directed, 0, "denied") if no else (told, directed, 0, "reported")
    return None


def test_composed_automaton_equals_the_transducers_in_turn():
    automaton = grammar.Automaton()
    rng = random.Random(4)
    clauses = [list(c) for n in range(5) for c in itertools.product(range(7), repeat=n)]
    clauses += [[rng.randrange(7) for _ in range(rng.randint(5, 30))] for _ in range(3000)]
    for kinds in clauses:
        found = automaton.run(kinds)
        assert (None if found is None else grammar.PATTERNS[found]) == in_turn(kinds)
    assert len(automaton.states) < 4 * 4 * 4**3 * 4


def pattern_of(text):
    reader = grammar.Reader(HAND)
    return [grammar.PATTERNS[i] for i, v in enumerate(reader.features(text)[:-1]) if v]


@pytest.mark.parametrize(
    "text, pattern",
    [
        ("You are an idiot.", [(1, 1, 0, "plain")]),
        ("he is an idiot, a scumbag", [(2, 0, 0, "plain")]),
        ("He is not an idiot.", [(1, 0, 0, "denied")]),
        ("Not here. He is an idiot", [(1, 0, 0, "plain")]),
        ("She said he was an idiot; fine", [(1, 0, 0, "reported")]),
        ("the word \"idiot\" is old", [(1, 0, 0, "reported")]),
        ("I will kill you.", [(0, 1, 1, "plain")]),
        ("nothing here. idiots are idiotic", []),
        ("discumber", []),
        ("", []),
        (None, []),
    ],
)
def test_clauses_not_words(text, pattern):
    assert pattern_of(text) == pattern


def test_denied_and_reported_insults_can_weigh_less():
    weights = [0.0] * grammar.FEATURES
    weights[grammar._PLACE[1, 0, 0, "plain"]] = 6.0
    reader = grammar.Reader(grammar.Grammar((("idiot", 1.0),), tuple(weights), -3.0))
    assert reader.score("an idiot") > 0.5 > reader.score("not an idiot") == reader.score("none at all")


def test_long_texts_are_read_once():
    reader = grammar.Reader(HAND)
    text = "word idiot here, " * 20_000
    assert reader.features(text)[grammar._PLACE[3, 0, 0, "plain"]] > 0
    assert reader.score("word. " * 50_000 + "idiot") == reader.score("idiot")


def test_held_out_accuracy(spark):
    sf = SF.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = grammar.predict(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out")
    n = {(r.toxic, r.predicted): r["count"] for r in found.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] >= 0.9 * (n[1, 1] + n[1, 0]) and n[0, 1] <= 0.02 * (n[0, 0] + n[0, 1])


def test_predictions_look_at_the_text_alone(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    learned = grammar.learn(docs, labels)
    one = grammar.scored(docs, learned).select("doc_id", "score")
    other = grammar.scored(
        docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)).withColumn("doc_id", -F.col("doc_id")), learned
    ).select((-F.col("doc_id")).alias("doc_id"), "score")
    assert one.exceptAll(other).count() == 0
    flipped = labels.withColumn("toxic", F.when(grammar.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert grammar.learn(docs, flipped) == learned


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(0, None), (1, ""), (None, "you idiot"), (3, "a " * 100_000), (3, "a " * 100_000), (5, "fine words")], "doc_id long, text string"
    ).withColumn("toxic", F.lit(9)).withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(0, 1), (None, 1), (3, None), (5, 0), (77, 1)], "doc_id long, toxic int")
    found = grammar.predict(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == 6
    assert found.filter("score is null or score < 0 or score > 1 or predicted is null or held_out is null").count() == 0
    assert grammar.predict(docs.limit(0), labels.limit(0)).count() == 0
    assert grammar.predict(docs, labels.limit(0)).filter("predicted = 1").count() == 0
