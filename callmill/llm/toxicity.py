"""Toxicity by a weighted finite-state grammar over clauses.

A text is read as clauses of classed words: insults, threats, targets, negation, reported speech. Five small transducers, one for
each class, are composed into one machine that reads a clause and gives its weight: an insult that is negated or reported
weighs less, one aimed at somebody more, a threat counts only where it has a target, and words of one phrase ("stupid idiot")
not in full each. A target may stand before or behind what is aimed at it: the target transducer guesses at the start whether one will
come, and a path that guessed wrong is not accepted. Single words are never scored outside their clause.

The insult lexicon has stated words and, for other languages and slang, words learned from labelled documents: those whose
share of toxic documents is far above their share of others. A logistic curve over clause features, fitted
on the same labels, gives the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmill.llm.common import prepare, saved, text_of

# Documented bound: so many labelled documents, chosen by the hash of their ids, are learned from.
SAMPLE = 20_000
# A word is learned as an insult if so many toxic documents have it, and its odds are so much higher there.
MIN_TOXIC_DOCS = 5
MIN_LOG_ODDS = 3.0
STATED_WEIGHT = 5.0

# The stated lexicon of the grammar.
INSULTS = "idiot idiots moron morons stupid scum trash loser losers clown pathetic worthless disgusting imbecile filth vermin".split()
THREATS = "kill hurt destroy beat burn stab shoot punch töten umbringen tuer frapper matar golpear".split()
TARGETS = (
    "you your yours yourself he him his she her they them their these those everyone "
    "du dich dir sie ihr ihn tu te toi vous il elle ils elles tú usted él ella ellos"
).split()
NEGATIONS = "not no never isn aren don doesn won nicht kein keine nie pas jamais nunca ni".split()
REPORTS = (
    "said says say told wrote writes called quoted claims claimed reported "
    "sagte sagt schrieb dit disait écrit dijo dice escribió"
).split()

NEGATION_SCOPE = 3
NEGATED, REPORTED, TARGETED, UNTARGETED_THREAT, SAME_PHRASE, THREAT_WEIGHT = 0.1, 0.4, 1.25, 0.0, 0.5, 4.0
FEATURES = ("bias", "strongest", "log_total", "share")

TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")
CLAUSE_END = frozenset(".!?;:\n")


class Transducer:
    """Weighted transducer: (state, symbol) -> the (state, factor) that may follow. A clause is read along all paths from a
    start state, and counts on those that end in an accepted one."""

    def __init__(self, starts, arcs, accepts=lambda state: True):
        self.starts, self._arcs, self._accepts = tuple(starts), arcs, accepts
        self._known: dict = {}

    def step(self, state, symbol) -> list:
        """The arcs, made when first needed."""
        key = (state, symbol)
        if key not in self._known:
            self._known[key] = list(self._arcs(state, symbol))
        return self._known[key]

    def accepts(self, state) -> bool:
        return self._accepts(state)

    def compose(self, other: Transducer) -> Transducer:
        """Both read the same symbols; the factors are multiplied."""

        def arcs(state, symbol):
            for a, x in self.step(state[0], symbol):
                for b, y in other.step(state[1], symbol):
                    yield (a, b), x * y

        starts = [(a, b) for a in self.starts for b in other.starts]
        return Transducer(starts, arcs, lambda state: self.accepts(state[0]) and other.accepts(state[1]))

    def weigh(self, clause: list[tuple[str, float]]) -> float:
        """The largest weight that a path gives to (symbol, weight) words: the sum of weights times factors."""
        reached = {state: 0.0 for state in self.starts}
        for symbol, weight in clause:
            after: dict = {}
            for state, total in reached.items():
                for state_, factor in self.step(state, symbol):
                    value = total + weight * factor
                    if value > after.get(state_, -1.0):
                        after[state_] = value
            reached = after
        return max((total for state, total in reached.items() if self.accepts(state)), default=0.0)


def _phrase_of(own: str):
    """The state says whether the word before was of the class: the second word of a phrase adds less."""

    def arcs(state: int, symbol: str):
        yield int(symbol == own), SAME_PHRASE if state and symbol == own else 1.0

    return arcs


def _negation(state: int, symbol: str):
    """The state counts the words for which a negation still holds."""
    if symbol == "N":
        yield NEGATION_SCOPE, 1.0
    else:
        yield max(state - 1, 0), NEGATED if state and symbol in "IT" else 1.0


def _reported(state: int, symbol: str):
    """Reported speech lasts until the clause ends."""
    yield (1 if symbol == "R" or state else 0), REPORTED if state and symbol in "IT" else 1.0


# What the target transducer holds: there is no target in the clause, one is to come, there was one.
NONE, TO_COME, SEEN = range(3)


def _target(state: int, symbol: str):
    if symbol == "Y":
        if state != NONE:
            yield SEEN, 1.0
    elif symbol in "IT":
        yield state, TARGETED if state != NONE else UNTARGETED_THREAT if symbol == "T" else 1.0
    else:
        yield state, 1.0


INSULT = Transducer([0], _phrase_of("I"))
THREAT = Transducer([0], _phrase_of("T"))
TARGET = Transducer([NONE, TO_COME], _target, lambda state: state != TO_COME)
NEGATION = Transducer([0], _negation)
REPORT = Transducer([0], _reported)
GRAMMAR = INSULT.compose(THREAT).compose(TARGET).compose(NEGATION).compose(REPORT)


@dataclass
class Model:
    """Lexicon and curve. `words` gives class and weight of a word."""

    learned: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, ...] = (-4.0, 1.0, 1.0, 0.0)

    def __post_init__(self):
        self.words = {w: ("I", x) for w, x in self.learned.items()}
        for symbol, listed, weight in (
            ("T", THREATS, THREAT_WEIGHT), ("Y", TARGETS, 0.0), ("N", NEGATIONS, 0.0), ("R", REPORTS, 0.0),
        ):
            self.words.update({w: (symbol, weight) for w in listed})
        self.words.update({w: ("I", max(STATED_WEIGHT, self.learned.get(w, 0.0))) for w in INSULTS})

    def clause(self, tokens: list[str]) -> float:
        """Weight of a clause."""
        return GRAMMAR.weigh([self.words.get(token, ("o", 0.0)) for token in tokens])

    def features(self, text: str) -> tuple[float, float, float, int]:
        """(strongest clause, log of the sum over matched clauses, matched share of clauses, matched clauses)."""
        tokens = TOKEN.findall(text.lower())
        weights, clauses, start, bad, words = [], 0, 0, False, self.words
        for i, token in enumerate(tokens):
            if token in CLAUSE_END:
                clauses += i > start
                if bad:
                    weights.append(self.clause(tokens[start:i]))
                start, bad = i + 1, False
            elif token in words and words[token][0] in "IT":
                bad = True
        clauses += len(tokens) > start
        if bad:
            weights.append(self.clause(tokens[start:]))
        matched = [w for w in weights if w > 0]
        return max(matched, default=0.0), math.log1p(sum(matched)), len(matched) / max(clauses, 1), len(matched)

    def score(self, features: tuple[float, ...]) -> float:
        x = self.curve[0] + sum(c * f for c, f in zip(self.curve[1:], features))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, x))))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Logistic regression by Newton's method; no rows or one class gives a curve that the ridge holds finite."""
    x = np.column_stack([np.ones(len(x)), x]) if len(x) else np.zeros((0, len(FEATURES)))
    w = np.zeros(len(FEATURES))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def in_test_fold(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id's digits divisible by 5. A null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def _features(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.features(t) for t in batch.column("_text").to_pylist()]
            scores = [model.score(f[:3]) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("toxic"),
                    *[pa.array([f[k] for f in found], pa.float64()) for k in range(3)],
                    pa.array([f[3] for f in found], pa.int64()),
                    pa.array(scores, pa.float64()),
                ],
                names=["doc_id", "toxic", *FEATURES[1:], "n_clauses", "score"],
            )

    return run


SCORED = "doc_id long, toxic int, strongest double, log_total double, share double, n_clauses long, score double"


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Lexicon and curve from at most `sample` labelled rows outside the test fold.

    Null labels and ids are left out; an id labelled more than once counts once, with its highest label.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~in_test_fold(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text"))
    # At most `sample` rows of two numbers: half a megabyte.
    texts = saved(rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "_text"), "labelled")

    totals = {r.toxic: r.n for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, other = totals.get(1, 0), totals.get(0, 0)
    per_word = (
        texts.select("toxic", F.explode(F.array_distinct(F.split(F.lower("_text"), r"[^\p{L}]+"))).alias("word"))
        .filter("word != ''")
        .groupBy("word")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
        .filter(F.col("bad") >= MIN_TOXIC_DOCS)
    )
    odds = F.log((F.col("bad") + 0.5) / (toxic + 1)) - F.log((F.col("good") + 0.5) / (other + 1))
    # Words of the bounded sample.
    learned = {r.word: min(r.odds, 8.0) for r in per_word.select("word", odds.alias("odds")).filter(
        F.col("odds") >= MIN_LOG_ODDS).collect()}
    model = Model(learned)
    seen = texts.mapInArrow(_features(model), SCORED).select("toxic", *FEATURES[1:]).collect()
    x = np.array([[r.strongest, r.log_total, r.share] for r in seen]).reshape(-1, 3)
    return Model(learned, fit_curve(x, np.array([float(r.toxic) for r in seen])))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, score, predicted, n_clauses (matched clauses).

    Null and empty texts get the score of a text without matches. Texts are read whole, whatever their length. Repeated rows
    each keep their row, an empty table gives none, other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("int").alias("toxic"), text_of().alias("_text")
    )
    return rows.mapInArrow(_features(model), SCORED).select(
        "doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_clauses"
    )
