"""Toxicity by a weighted finite-state grammar over the clauses of a text.

Words become labels (insult, threat, target, negation, report, end of clause, other). Four
small transducers read the labels, each passing on a label that may carry an event: insults
that hit a target, threats that hit a target, negated ones, reported ones. Their composition
is one deterministic machine; its path through a clause counts the events, and a logistic
weight for each event scores the matched clauses. Insults beyond the fixed words are learned:
words and word beginnings that labelled toxic texts have and others lack.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_texts
from .labelled import SAMPLE_ROWS, held_out, training_labels
from .words import small_batches

INSULT, THREAT, TARGET, NEGATION, REPORT, END, OTHER = range(7)

# Small word lists of four languages.
WORDS = {
    INSULT: "idiot idiots moron morons scum trash worthless pathetic stupid loser losers clown "
    "disgusting dumb filthy vermin imbecile cretin dummkopf abschaum arschloch connard "
    "ordure imbécile basura imbécil escoria",
    THREAT: "kill hurt destroy shoot stab strangle hang töten umbringen tuer matar",
    TARGET: "you your yours yourself he she they them him her his their these those people all "
    "du dich dir ihr sie euch tu te vous toi votre ils elles usted ustedes tú ti ellos",
    NEGATION: "not no never nobody none isn aren wasn don doesn nicht kein keine nie ne pas "
    "jamais nunca jamás",
    REPORT: "said says say called calls wrote writes quoted claimed claims according reported "
    "sagte sagt laut schrieb dit écrit selon dijo dice según escribió",
}
SCOPE = 3  # words that a negation or the gap between a threat and its target may span
BEGINNINGS = (4, 5, 6, 7)
MIN_LINES, MIN_SHARE, MIN_PURITY, MAX_LEARNED = 4, 0.01, 0.97, 20_000

# The events of the composed machine, in the order of their weights.
EVENTS = ("insult", "aimed", "threat", "threat_aimed", "negated", "reported")
PRIOR_WEIGHTS = np.array([2.0, 1.0, 0.2, 3.0, -1.5, -1.0])
PRIOR_INTERCEPT = -3.0

_token = regex.compile(r"\p{L}+|[.!?;\n]").findall


@dataclass
class Transducer:
    """A deterministic machine: (state, label) to (next state, label passed on, events)."""

    start: int = 0
    arcs: dict[tuple[int, int], tuple[int, int, tuple[int, ...]]] = field(default_factory=dict)

    def step(self, state: int, label: int) -> tuple[int, int, tuple[int, ...]]:
        """Labels without an arc are passed on and leave the state as it is."""
        return self.arcs.get((state, label), (state, label, ()))


def reported_speech() -> Transducer:
    """Behind a word of reporting, insults and threats of the clause count as reported."""
    event = EVENTS.index("reported")
    arcs = {(0, REPORT): (1, OTHER, ()), (1, END): (0, END, ())}
    for label in (INSULT, THREAT):
        arcs[1, label] = (1, label, (event,))
    return Transducer(0, arcs)


def negation() -> Transducer:
    """Insults and threats within ``SCOPE`` words behind a negation count as negated."""
    event = EVENTS.index("negated")
    arcs = {(state, NEGATION): (SCOPE, OTHER, ()) for state in range(SCOPE + 1)}
    for state in range(1, SCOPE + 1):
        for label in (TARGET, OTHER, REPORT):
            arcs[state, label] = (state - 1, label, ())
        for label in (INSULT, THREAT):
            arcs[state, label] = (state - 1, label, (event,))
        arcs[state, END] = (0, END, ())
    return Transducer(0, arcs)


def insult_and_target() -> Transducer:
    """States: nothing yet, target seen, insult seen without one, both."""
    insult, aimed = EVENTS.index("insult"), EVENTS.index("aimed")
    arcs = {(state, END): (0, END, ()) for state in range(4)}
    arcs |= {
        (0, TARGET): (1, TARGET, ()),
        (0, INSULT): (2, OTHER, (insult,)),
        (1, INSULT): (3, OTHER, (insult, aimed)),
        (2, TARGET): (3, TARGET, (aimed,)),
        (2, INSULT): (2, OTHER, (insult,)),
        (3, INSULT): (3, OTHER, (insult,)),
    }
    return Transducer(0, arcs)


def threat_and_target() -> Transducer:
    """A threat counts as aimed when a target follows within ``SCOPE`` words."""
    threat, aimed = EVENTS.index("threat"), EVENTS.index("threat_aimed")
    arcs = {(state, THREAT): (SCOPE, OTHER, (threat,)) for state in range(SCOPE + 1)}
    for state in range(1, SCOPE + 1):
        arcs[state, TARGET] = (0, OTHER, (aimed,))
        arcs[state, OTHER] = (state - 1, OTHER, ())
        arcs[state, END] = (0, END, ())
    return Transducer(0, arcs)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that feeds what ``first`` passes on to ``second``; reachable states only."""
    numbers = {(first.start, second.start): 0}
    todo = deque(numbers)
    arcs = {}
    while todo:
        a, b = pair = todo.popleft()
        for label in range(OTHER + 1):
            next_a, passed, events = first.step(a, label)
            next_b, out, more = second.step(b, passed)
            target = (next_a, next_b)
            if target not in numbers:
                numbers[target] = len(numbers)
                todo.append(target)
            arcs[numbers[pair], label] = (numbers[target], out, (*events, *more))
    return Transducer(0, arcs)


def grammar() -> Transducer:
    machine = compose(reported_speech(), negation())
    return compose(compose(machine, insult_and_target()), threat_and_target())


class Lexicon:
    """Labels of words: fixed words, learned words and learned beginnings."""

    def __init__(self, words: set[str] = frozenset(), beginnings: set[str] = frozenset()):
        self.fixed = {word: label for label, text in WORDS.items() for word in text.split()}
        self.fixed |= {word: INSULT for word in words if word not in self.fixed}
        self.fixed |= dict.fromkeys(".!?;\n", END)
        self.beginnings = beginnings
        self.known: dict[str, int] = {}

    def label(self, token: str) -> int:
        found = self.known.get(token)
        if found is None:
            word = token.lower()
            found = self.fixed.get(word, OTHER)
            if found == OTHER and any(word[:n] in self.beginnings for n in BEGINNINGS if len(word) > n):
                found = INSULT
            if len(self.known) > 300_000:
                self.known.clear()
            self.known[token] = found
        return found


class Scorer:
    """Event counts of texts."""

    def __init__(self, lexicon: Lexicon):
        self.label = lexicon.label
        machine = grammar()
        n_states = 1 + max(state for state, _ in machine.arcs)
        self.next = [[machine.arcs[s, k][0] for k in range(OTHER + 1)] for s in range(n_states)]
        self.events = [[machine.arcs[s, k][2] for k in range(OTHER + 1)] for s in range(n_states)]

    def counts(self, text: str | None) -> list[int]:
        found = [0] * len(EVENTS)
        if not text:
            return found
        label = self.label
        labels = [label(token) for token in _token(text)]
        if INSULT not in labels and THREAT not in labels:
            return found
        state = 0
        for k in labels:
            for event in self.events[state][k]:
                found[event] += 1
            state = self.next[state][k]
        return found


def _features(counts: np.ndarray) -> np.ndarray:
    return np.log1p(np.asarray(counts, float).reshape(-1, len(EVENTS)))


@dataclass
class ToxicModel:
    words: set[str]
    beginnings: set[str]
    intercept: float
    weights: np.ndarray

    def scores(self, counts: np.ndarray) -> np.ndarray:
        total = self.intercept + _features(counts) @ self.weights
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def fit_weights(counts: np.ndarray, labels: np.ndarray, pull: float = 5.0) -> tuple[float, np.ndarray]:
    """Newton steps on the logistic loss, pulled towards the prior weights."""
    x = np.column_stack([np.ones(len(labels)), _features(counts)])
    prior = np.concatenate(([PRIOR_INTERCEPT], PRIOR_WEIGHTS))
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (labels - p) - pull * (w - prior)
        bend = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        change = np.linalg.solve(bend, slope)
        w += np.clip(change, -2, 2)
        if np.abs(change).max() < 1e-8:
            break
    return float(w[0]), w[1:]


def candidates(text: str) -> set[str]:
    """The words of a text, and the beginnings of its longer words, marked with a dash."""
    words = {token.lower() for token in _token(text) if len(token) > 2}
    return words | {f"{w[:n]}-" for w in words for n in BEGINNINGS if len(w) > n}


def _learned(sample: DataFrame, n_toxic: int) -> tuple[set[str], set[str]]:
    """Words and beginnings that nearly only lines of toxic texts in the sample have.

    Counted over distinct lines, so a passage in many copies does not make a chance word
    look telling; a line that any clean text has is clean. At least ``MIN_LINES`` lines must have an item, and a
    hundredth of the number of toxic texts. Spark adds the counts up after a
    first sum in each batch.
    """

    def start():
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                seen: dict[str, list[int]] = {}
                for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    for item in candidates(text or ""):
                        seen.setdefault(item, [0, 0])[label > 0] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(seen), pa.string()),
                        pa.array([n[0] for n in seen.values()], pa.int64()),
                        pa.array([n[1] for n in seen.values()], pa.int64()),
                    ],
                    names=["item", "clean", "toxic"],
                )

        return count

    counted = (
        sample.select(F.explode(F.split("_text", "\n")).alias("_text"), "_label")
        .groupBy("_text")
        .agg(F.min("_label").alias("_label"))
        .mapInArrow(start(), "item string, clean long, toxic long")
        .groupBy("item")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") >= max(MIN_LINES, MIN_SHARE * n_toxic))
        .where(F.col("toxic") >= MIN_PURITY * (F.col("toxic") + F.col("clean")))
        .orderBy(F.desc("toxic"), "item")
        .limit(MAX_LEARNED)
    )
    items = [row["item"] for row in counted.collect()]
    return {i for i in items if not i.endswith("-")}, {i[:-1] for i in items if i.endswith("-")}


def fit(
    docs: DataFrame,
    labels: DataFrame,
    target: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> ToxicModel:
    """Learn words, beginnings and weights from at most ``sample_rows`` labelled ids.

    Without labels the fixed words and prior weights remain.
    """
    small_batches(docs.sparkSession)
    labelled = training_labels(labels, target, id_col, sample_rows)
    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    # the sample has ``sample_rows`` ids at most, so it can be broadcast
    sample = named.join(F.broadcast(labelled), "_id").select("_text", "_label")
    n_toxic = labelled.where("_label > 0").count()
    words, beginnings = _learned(sample, n_toxic)

    def start():
        scorer = Scorer(Lexicon(words, beginnings))

        def make(column: pa.Array) -> list[pa.Array]:
            counts = [scorer.counts(text) for text in column.to_pylist()]
            return [pa.array(counts, pa.list_(pa.int32()))]

        return make

    counted = map_texts(sample, "_text", "counts array<int>", start, ["_label"])
    rows = counted.groupBy("_label", "counts").count().collect()  # few distinct counts of a bounded sample
    if not rows:
        return ToxicModel(words, beginnings, PRIOR_INTERCEPT, PRIOR_WEIGHTS)
    repeat = [row["count"] for row in rows]
    counts = np.repeat(np.array([row["counts"] for row in rows]), repeat, axis=0)
    truth = np.repeat(np.array([float(row["_label"] > 0) for row in rows]), repeat)
    return ToxicModel(words, beginnings, *fit_weights(counts, truth))


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    target: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    threshold: float = 0.5,
) -> DataFrame:
    """``id_col``, held_out, score (0 to 1), predicted (0 or 1) and the number of each event.

    Every whole text is read. Null and empty texts have no clause, so the lowest score. One
    row for each input row; repeated rows and null ids stay.
    """
    model = fit(docs, labels, target, id_col, text_col, sample_rows)

    def start():
        scorer = Scorer(Lexicon(model.words, model.beginnings))

        def make(column: pa.Array) -> list[pa.Array]:
            counts = np.array([scorer.counts(t) for t in column.to_pylist()], np.int64)
            counts = counts.reshape(-1, len(EVENTS))
            columns = [pa.array(np.ascontiguousarray(counts[:, i])) for i in range(len(EVENTS))]
            return [pa.array(model.scores(counts)), *columns]

        return make

    events = ", ".join(f"n_{name} long" for name in EVENTS)
    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    scored = map_texts(named, "_text", f"score double, {events}", start, ["_id"])
    return scored.select(
        F.col("_id").alias(id_col),
        held_out(F.col("_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        *[f"n_{name}" for name in EVENTS],
    )
