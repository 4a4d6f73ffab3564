"""Quality rules, quality classifier and toxicity: counts, fits and odd inputs."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listenlytics.llm import gam, toxicity, weakrules
from listenlytics.llm.labelled import held_out
from listenlytics.llm.textstats import COUNTS, count_table

DOCS = "doc_id long, text string, score double, _text string, pattern string, n_words int"


def odd_docs(spark):
    """Nulls, empty, long, repeated rows, and columns whose names the operators use."""
    fine = "The house of the man is in the old town. It was good to see all of them by day and at night."
    rows = [
        (1, fine), (1, fine), (2, None), (3, ""), (None, fine), (4, " \n\t"),
        (5, "spam spam spam spam spam spam spam spam spam spam spam spam"), (6, "word " * 200_000),
        (7, "### a &&& b %%% c $$$ d *** e ### f &&& g %%% h"), (8, "é ü 漢字 " * 5),
    ]
    return spark.createDataFrame([(i, t, 0.5, "x", "y", 1) for i, t in rows], DOCS)


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return [len(words), sum(map(len, words)), symbols, again, len(covered), len(text)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab é漢\n\t\x0b\x1c#<|.", max_size=60), max_size=5))
def test_counts_match_brute_force(texts):
    got = count_table(pa.array(texts, pa.string()))[:, :6].tolist()
    assert got == [brute(text) for text in texts]


def test_rules_on_odd_rows(spark):
    rows = weakrules.quality_verdicts(odd_docs(spark)).collect()
    assert len(rows) == 10
    by_id = {row["doc_id"]: row for row in rows}
    assert by_id[1]["kept"] and by_id[None]["kept"]
    for empty in (2, 3, 4):
        assert by_id[empty]["n_words"] == 0 and by_id[empty]["base_failed"] and not by_id[empty]["kept"]
    assert by_id[6]["n_words"] == 200_000 and by_id[6]["n_repeat_words"] == 200_000
    assert not by_id[6]["kept"] and not by_id[5]["kept"]


def test_rules_keep_own_columns_and_empty_tables(spark):
    docs = odd_docs(spark)
    kept = weakrules.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() >= 3
    assert weakrules.keep_good(docs.limit(0)).count() == 0
    assert weakrules.quality_verdicts(docs.limit(0)).count() == 0


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.9, 0.75, 0.7, 0.9])
    votes = np.where(rng.random((20_000, 8)) < right, good[:, None], ~good[:, None]) * 2 - 1
    votes[rng.random(votes.shape) < 0.3] = 0
    numbers, weights = np.unique(weakrules.pattern_numbers(votes), return_counts=True)
    model = weakrules.fit_votes(weakrules.pattern_votes(numbers, 8), weights.astype(float))
    assert abs(model.good_share - 0.8) < 0.03
    assert np.abs(model.shares[1, :, 2] - 0.7 * right).max() < 0.05
    assert ((model.posterior(votes) > 0.5) == good).mean() > 0.95


ALL_GOOD, SILENT, SHORT_TEXT = [0, 0, 0, 0, 1, 1, 1, 1], [0] * 8, [0] * 4 + [2] * 4


def fitted(mix):
    one_sided = np.array([rule.good is None for rule in weakrules.RULES])
    rows = np.array([votes for votes, _ in mix], np.int8)
    model = weakrules.fit_votes(rows, np.array([share * 1000 for _, share in mix], float), one_sided)
    return model, model.posterior(rows)


def test_silent_texts_are_kept_where_no_rule_votes_bad():
    assert (fitted([(ALL_GOOD, 60), (SILENT, 30), (SHORT_TEXT, 10)])[1] > 0.9).all()


@pytest.mark.parametrize("place", range(8))
def test_classes_never_change_places(place):
    """Few texts with one bad vote beside many silent ones, which once became the good class."""
    mixed = [-1 if i == place else vote for i, vote in enumerate(ALL_GOOD)]
    model, posterior = fitted([(ALL_GOOD, 60), (SILENT, 33), (SHORT_TEXT, 2), (mixed, 5)])
    assert (posterior[:3] > 0.9).all() and posterior[3] < posterior[:3].min()
    assert (model.shares[1, :, 0] <= model.shares[0, :, 0] + 1e-12).all()


def test_most_texts_may_be_bad():
    junk = [-1, -1, 0, 0, -1, -1, 0, 0]
    _, posterior = fitted([(ALL_GOOD, 20), (SILENT, 5), (junk, 60), ([0, -1, 0, 0, 0, -1, 0, -1], 15)])
    assert posterior[0] > 0.9 and (posterior[2:] < 0.1).all()


def test_posterior_is_bayes_over_the_votes():
    """Text by text, without patterns and arrays."""
    model, _ = fitted([(ALL_GOOD, 60), (SILENT, 20), ([-1, 0, -1, 0, 1, -1, 0, 1], 20)])
    rows = np.random.default_rng(4).integers(-1, 3, (200, 8))
    for row, got in zip(rows, model.posterior(rows), strict=True):
        chance = [1 - model.good_share, model.good_share]
        for k in (0, 1):
            for rule, vote in enumerate(row):
                chance[k] *= 1.0 if vote == weakrules.SHORT else model.shares[k, rule, vote + 1]
        assert abs(got - chance[1] / sum(chance)) < 1e-9


def test_patterns_are_reversible():
    votes = np.random.default_rng(2).integers(-1, 3, (500, 8))
    assert (weakrules.pattern_votes(weakrules.pattern_numbers(votes), 8) == votes).all()


def test_verdicts_follow_the_labels(spark, sf_dir):
    tables = sf_dir.replace("sf0.001", "sf0.01")
    verdicts = weakrules.quality_verdicts(spark.read.parquet(f"{tables}/documents.parquet"))
    rows = verdicts.join(spark.read.parquet(f"{tables}/labels.parquet"), "doc_id").collect()
    fair = [row for row in rows if not row["base_failed"]]
    assert sum(row["kept"] == (row["quality"] == 1) for row in fair) / len(fair) > 0.97


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit_additive(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert ((model.scores(x[3000:]) > 0.5) == (y[3000:] > 0)).mean() > 0.95


def test_additive_model_without_rows_or_with_one_kind():
    empty = gam.fit_additive(np.zeros((0, 4)), np.zeros(0))
    assert empty.scores(np.ones((2, 4))).tolist() == [0.5, 0.5]
    assert (gam.fit_additive(np.ones((9, 2)), np.ones(9)).scores(np.ones((1, 2))) > 0.9).all()


def accuracy(rows, target):
    tested = [row for row in rows if row["held_out"] and row[target] is not None]
    return sum(row["predicted"] == row[target] for row in tested) / len(tested)


@pytest.mark.parametrize(
    ("score", "target"), [(gam.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")]
)
def test_held_out_accuracy(spark, sf_dir, score, target):
    tables = sf_dir.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "labels"))
    rows = score(docs, labels).join(labels, "doc_id").collect()
    assert accuracy(rows, target) > 0.98


@pytest.mark.parametrize(
    ("score", "target"), [(gam.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")]
)
def test_scores_on_odd_rows(spark, score, target):
    docs = odd_docs(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (5, 0, 1), (None, 1, 1), (7, None, None), (99, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    for known in (labels, labels.limit(0)):
        rows = score(docs, known, target=target).collect()
        assert len(rows) == 10
        assert all(0 <= row["score"] <= 1 and row["held_out"] is not None for row in rows)
        one, again = (row["score"] for row in rows if row["doc_id"] == 1)
        assert one == again
    assert score(docs.limit(0), labels, target=target).count() == 0


def test_held_out_fold(spark):
    import zlib

    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(row["h"] == (zlib.crc32(str(row["id"]).encode()) % 5 == 0) for row in rows)
    assert spark.sql("SELECT CAST(NULL AS BIGINT) id").select(held_out(F.col("id"))).first()[0] is False


def events(text):
    scorer = toxicity.Scorer(toxicity.Lexicon())
    return dict(zip(toxicity.EVENTS, scorer.counts(text), strict=True))


def test_grammar_on_clauses():
    assert events("You are an idiot.") == {
        "insult": 1, "aimed": 1, "threat": 0, "threat_aimed": 0, "negated": 0, "reported": 0
    }
    assert events("I will kill you.")["threat_aimed"] == 1
    assert events("To kill time. You know")["threat_aimed"] == 0
    assert events("He is not a moron.")["negated"] == 1
    assert events("They said he is a moron.")["reported"] == 1
    assert events("They said it. He is a moron.")["reported"] == 0
    assert events(None) == events("") == dict.fromkeys(toxicity.EVENTS, 0)


def test_composition_equals_the_cascade():
    parts = [
        toxicity.reported_speech(), toxicity.negation(),
        toxicity.insult_and_target(), toxicity.threat_and_target(),
    ]
    whole = toxicity.grammar()
    rng = np.random.default_rng(4)
    for _ in range(200):
        state, states, one, other = 0, [0] * 4, [], []
        for label in rng.integers(0, 7, 12).tolist():
            state, _, found = whole.step(state, label)
            one += sorted(found)
            passed, now = label, []
            for i, part in enumerate(parts):
                states[i], passed, found = part.step(states[i], passed)
                now += found
            other += sorted(now)
        assert one == other
