"""Toxicity by a weighted finite-state grammar over clauses.

Four transducers run one after the other. The first reads letters and writes word classes: insults
and their weights are learned (whole words and stems with any ending), threats, targets, negations,
reporting verbs and quotation marks are closed lists. The second marks insults and threats that a
negation stands before. The third marks what is reported or quoted. The fourth reads the marked
classes of a clause and ends in a pattern: how many insults, whether a target or a threat stands
with them, whether they were denied or reported. The last three are composed into one automaton,
whose states are worked out once. A text's score is a logistic function of the weights of its
clauses' patterns and of their insults; clauses without an insult or a threat weigh nothing.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.shared import col, settle

#: labelled documents that the insults and the weights are learned from, at most
LABELLED = 20_000
#: insults learned at most, those found in the most toxic texts first
INSULTS = 4000
#: an insult stands in so many toxic texts, behind as many kinds of words (of 64) as half of them, up to a
#: bound: the words of near copies stand behind the same words again and again
TEXTS, KINDS = 4, 24
#: so large a share of the texts that hold it are toxic, and so much (in nats) does it tell
SURE, TELLING = 0.5, 9.0
#: stems are looked for up to so many letters
STEM = 3, 8
THRESHOLD = 0.3

THREATS = "kill hurt destroy murder beat shoot stab burn töten umbringen schlagen zerstören tuer frapper détruire brûler matar destruir golpear quemar"
TARGETS = "you your yours yourself u du dich dir dein deine ihr euch euer tu toi vous ton ta tes votre vos tú ti usted ustedes tus vosotros"
NEGATIONS = "not no never isn't aren't wasn't don't doesn't nicht kein keine nie niemals pas jamais aucun aucune nunca jamás tampoco"
REPORTS = "said says wrote writes called claimed quoted reported sagte sagt schrieb nannte dit écrit déclaré appelé dijo escribió llamó afirmó"
QUOTES = '"“”„«»'
#: words over which a negation reaches
REACH = 3

NEGATION, REPORT, TARGET, THREAT, INSULT, QUOTE, OTHER = range(7)
_CLOSED = {
    word: kind
    for kind, words in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS))
    for word in words.split()
}
#: a clause ends at these marks and at the end of a line
_CLAUSE_END = re.compile(r"[.!?;:\n]+")
_TOKEN = re.compile(rf"[^\W\d_]+(?:'[^\W\d_]+)?|[{QUOTES}]")
_WORD = re.compile(r"[^\W\d_]+")

# what a clause's pattern says, beside the number of insults
PATTERNS = [
    (insults, directed, threat, said)
    for insults in (0, 1, 2, 3)
    for directed in (0, 1)
    for threat in (0, 1)
    for said in ("plain", "denied", "reported")
    if insults or threat
]
_PLACE = {pattern: i for i, pattern in enumerate(PATTERNS)}
#: features of a text: patterns of its clauses, sum of the weights of its insults
FEATURES = len(PATTERNS) + 1


def _negate(state: int, kind: int) -> tuple[int, int, bool]:
    """(next state, class, denied): the state counts down from a negation."""
    if kind == NEGATION:
        return REACH, kind, False
    return max(0, state - 1), kind, bool(state) and kind in (INSULT, THREAT)


def _report(state: int, kind: int) -> tuple[int, bool]:
    """(next state, reported): 1 behind a reporting verb up to the clause's end, 2 inside quotation marks."""
    if kind == QUOTE:
        return (state ^ 2), False
    return (state | 1 if kind == REPORT else state), bool(state)


def _clause(state: tuple[int, int, int, int, int], kind: int, denied: bool, reported: bool):
    """Counts up to three of plain, denied and reported insults, and marks a target and a threat."""
    plain, no, told, directed, threat = state
    if kind == INSULT:
        if reported:
            told = min(3, told + 1)
        elif denied:
            no = min(3, no + 1)
        else:
            plain = min(3, plain + 1)
    elif kind == TARGET:
        directed = 1
    elif kind == THREAT and not denied and not reported:
        threat = 1
    return plain, no, told, directed, threat


def _step(state: tuple, kind: int) -> tuple:
    negated, said, clause = state
    negated, kind, denied = _negate(negated, kind)
    said, reported = _report(said, kind)
    return negated, said, _clause(clause, kind, denied, reported)


_START = (0, 0, (0, 0, 0, 0, 0))


class Automaton:
    """The composed transducers as one table of states, filled in as states are met."""

    def __init__(self):
        self.states = [_START]
        self.number = {_START: 0}
        self.next: dict[int, int] = {}

    def run(self, kinds: list[int]) -> int | None:
        """Pattern of a clause's word classes; None if nothing in it matches."""
        at, known = 0, self.next
        for kind in kinds:
            to = known.get(at * 8 + kind)
            if to is None:
                made = _step(self.states[at], kind)
                to = self.number.setdefault(made, len(self.states))
                if to == len(self.states):
                    self.states.append(made)
                known[at * 8 + kind] = to
            at = to
        plain, no, told, directed, threat = self.states[at][2]
        if plain or threat:
            return _PLACE[plain, directed, threat, "plain"]
        if no:
            return _PLACE[no, directed, 0, "denied"]
        if told:
            return _PLACE[told, directed, 0, "reported"]
        return None


@dataclass(frozen=True)
class Grammar:
    """Insults with their weights (a stem ends in *), weights of the features, and the constant."""

    insults: tuple[tuple[str, float], ...] = ()
    weights: tuple[float, ...] = (0.0,) * FEATURES
    constant: float = 0.0


class Reader:
    """Features and scores of texts under a grammar."""

    def __init__(self, grammar: Grammar):
        import ahocorasick

        self.grammar = grammar
        self.weights = np.array(grammar.weights)
        self.exact = {w: v for w, v in grammar.insults if not w.endswith("*")}
        self.stems = {w[:-1]: v for w, v in grammar.insults if w.endswith("*")}
        self.found = ahocorasick.Automaton()
        for word in {*self.exact, *self.stems, *(w for w, k in _CLOSED.items() if k == THREAT)}:
            self.found.add_word(word, len(word))
        self.found.make_automaton()
        self.automaton = Automaton()

    def _read(self, word: str) -> tuple[int, float]:
        weight = self.exact.get(word)
        if weight is None and self.stems:
            for size in range(min(len(word), STEM[1]), STEM[0] - 1, -1):
                weight = self.stems.get(word[:size])
                if weight is not None:
                    break
        if weight is not None:
            return INSULT, weight
        return _CLOSED.get(word, OTHER), 0.0

    def features(self, text: str | None) -> np.ndarray:
        out = np.zeros(FEATURES)
        low = (text or "").lower()
        start, end = 0, -1
        mark = _CLAUSE_END.search(low)
        for last, size in self.found.iter(low):
            first = last - size + 1
            # only where a word begins, and in a clause that is not read yet
            if last < end or (first and low[first - 1].isalpha()):
                continue
            while mark and mark.end() <= first:
                start = mark.end()
                mark = _CLAUSE_END.search(low, start)
            end = mark.start() if mark else len(low)
            kinds = []
            for token in _TOKEN.finditer(low, start, end):
                word = token[0]
                if word in QUOTES:
                    kinds.append(QUOTE)
                    continue
                kind, weight = self._read(word)
                kinds.append(kind)
                out[-1] += weight
            pattern = self.automaton.run(kinds)
            if pattern is not None:
                out[pattern] += 1
        return np.log1p(out)

    def score(self, text: str | None) -> float:
        total = float(self.features(text) @ self.weights) + self.grammar.constant
        return float(1 / (1 + np.exp(-np.clip(total, -40, 40))))


@functools.lru_cache(maxsize=2)
def _reader(grammar: Grammar) -> Reader:
    return Reader(grammar)


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, on which nothing is learned."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _labels(labels: DataFrame, doc_id: str, toxic: str, bound: int) -> dict[int, int]:
    """Label of at most ``bound`` documents that are not held out, those of smallest hash; the mean decides."""
    each = (
        labels.select(col(doc_id).cast("long").alias("doc_id"), col(toxic).cast("double").alias("toxic"))
        .filter("doc_id is not null and toxic is not null")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    )
    return {r[0]: r[1] for r in each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound).collect()}


def _terms(text: str) -> dict[str, int]:
    """Words and stems of a text, each with the kinds of words before it as bits."""
    found: dict[str, int] = defaultdict(int)
    before = ""
    for word in _WORD.findall(text.lower()):
        kind = 1 << (zlib.crc32(before.encode("utf-8", "surrogatepass")) & 63)
        found[word] |= kind
        for size in range(STEM[0], min(STEM[1], len(word) - 1) + 1):
            found[word[:size] + "*"] |= kind
        before = word
    return found


def _counted(texts: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    """term, kind and number of texts that hold it; each task sends one row a term and kind."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        kinds: dict[str, int] = defaultdict(int)
        for batch in batches:
            for text in batch.column(0):
                for term, kind in _terms(text.as_py()).items():
                    if wanted is None or term in wanted:
                        held[term] += 1
                        kinds[term] |= kind
        terms = list(held)
        signed = np.array([kinds[t] for t in terms], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([held[t] for t in terms], pa.int64()), pa.array(signed)],
            names=["term", "texts", "kinds"],
        )

    each = texts.select("text").mapInArrow(count, "term string, texts long, kinds long")
    return each.groupBy("term").agg(F.sum("texts").alias("texts"), F.bit_count(F.bit_or("kinds")).alias("kinds"))


def _insults(toxic: DataFrame, clean: DataFrame) -> tuple[tuple[str, float], ...]:
    """Words and stems that stand in toxic texts and hardly in others, with the log odds they carry."""
    often = (
        _counted(toxic, None)
        .filter((F.col("texts") >= TEXTS) & (F.col("kinds") >= F.least(F.col("texts") / 2 + 2, F.lit(KINDS))))
        .orderBy(F.desc("texts"), F.length("term"), "term")
        .limit(8 * INSULTS)
        .collect()
    )
    bad = {r[0]: r[1] for r in often}
    good = {r[0]: r[1] for r in _counted(clean, frozenset(bad)).select("term", "texts").collect()}
    n_bad, n_good = toxic.count(), clean.count()
    gain = {t: _gain(n, good.get(t, 0), n_bad / max(1, n_bad + n_good)) for t, n in bad.items()}
    # the term that tells most comes first, and rules out its own stems and longer forms; of equals the longest
    chosen: list[str] = []
    ruled_out: set[str] = set()
    for term in sorted(gain, key=lambda t: (-gain[t], -len(t.rstrip("*")), t)):
        if gain[term] < TELLING or len(chosen) == INSULTS:
            break
        stem = term.rstrip("*")
        stems = [stem[:k] + "*" for k in range(STEM[0], len(stem) + 1)]
        if bad[term] < SURE * (bad[term] + good.get(term, 0)) or term in ruled_out or any(s in chosen for s in stems):
            continue
        chosen.append(term)
        ruled_out.update(stems)
    odds = np.log((n_good + 1) / (n_bad + 1))
    return tuple((t, float(odds + np.log((bad[t] + 0.5) / (good.get(t, 0) + 0.5)))) for t in sorted(chosen))


def _gain(bad: int, good: int, share: float) -> float:
    """Log likelihood ratio of a term's labels under its own share of toxic texts and under that of all."""
    own = bad / (bad + good)
    return bad * np.log(own / share) + (good * np.log((1 - own) / (1 - share)) if good else 0.0)


def _logistic(x: np.ndarray, y: np.ndarray, weight: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and constant of a ridge logistic regression, by Newton's method."""
    rows = np.hstack([x, np.ones((len(x), 1))])
    at = np.zeros(rows.shape[1])
    penalty = np.full(rows.shape[1], weight)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ at, -40, 40)))
        slope = rows.T @ (p - y) + penalty * at
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        at -= step
        if np.abs(step).max() < 1e-8:
            break
    return at[:-1], float(at[-1])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    bound: int = LABELLED,
) -> Grammar:
    """Insults and weights from the documents of at most ``bound`` labels that are not held out.

    Copies of a text count once. Without labels of both kinds the grammar knows no insult, and its
    constant is the share of toxic labels.
    """
    known = _labels(labels, doc_id, toxic, bound)
    share = float(np.clip(sum(known.values()) / max(1, len(known)), 0.001, 0.999)) if known else 0.001
    prior = Grammar(constant=float(np.log(share / (1 - share))))
    if not known:
        return prior
    spark = docs.sparkSession
    named = spark.createDataFrame(list(known.items()), "doc_id long, toxic int")
    texts = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    texts = texts.filter("doc_id is not null and text is not null").join(F.broadcast(named), "doc_id")  # ``bound`` pairs
    texts = settle(texts.groupBy(F.xxhash64("text").alias("mark")).agg(
        F.min("text").alias("text"), F.max("toxic").alias("toxic")
    ).select("text", "toxic"), "labelled")
    insults = _insults(texts.filter("toxic = 1"), texts.filter("toxic = 0"))
    reader_of = Grammar(insults)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(reader_of)
        for batch in batches:
            held = Counter()
            for body, label in zip(batch.column(0), batch.column(1).to_pylist()):
                held[label, reader.features(body.as_py()).astype(np.float64).tobytes()] += 1
            keys = list(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.binary()),
                 pa.array([held[k] for k in keys], pa.int64())],
                names=["toxic", "features", "texts"],
            )

    # at most ``bound`` rows, most of which are alike
    rows = texts.mapInArrow(read, "toxic int, features binary, texts long").groupBy("toxic", "features").agg(F.sum("texts")).collect()
    if not rows:
        return prior
    x = np.array([np.frombuffer(r[1], dtype=np.float64) for r in rows for _ in range(r[2])])
    y = np.array([r[0] for r in rows for _ in range(r[2])], dtype=np.float64)
    if y.min() == y.max():
        return prior
    weights, constant = _logistic(x, y)
    return Grammar(insults, tuple(weights.tolist()), constant)


def scored(docs: DataFrame, grammar: Grammar, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted; columns of these names are replaced, all others stay."""

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        read = _reader(grammar).score
        return pd.Series([read(t) for t in texts], dtype="float64")

    names = [c for c in docs.columns if c not in ("score", "predicted")]
    found = docs.select(*[col(c) for c in names], score(col(text).cast("string")).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def predict(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic"
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, learned from those not held out.

    Null and empty texts have no clause and score the constant. Rows without a doc_id are not
    held out, and no label is theirs. Repeated rows stay repeated; an empty table gives none.
    """
    grammar = learn(docs, labels, doc_id, text, toxic)
    kept = docs.select(col(doc_id).alias("doc_id"), col(text).cast("string").alias("text"))
    kept = kept.withColumn("held_out", held_out(F.col("doc_id")))
    return scored(kept, grammar).select("doc_id", "held_out", "score", "predicted")
