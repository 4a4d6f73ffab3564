"""Quality by weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Every rule says good (1), bad (-1) or nothing (0) about a text, or does not apply to it
because it is too short. Spark counts the vote patterns of all texts, at most 4 ** 8 of
them; EM over these counts estimates for each rule how it votes on good and on bad texts
that it applies to, and so the posterior of each pattern.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import new_work_folder
from ..staging import written
from .frames import map_texts, new_name
from .textstats import COUNT_FIELDS, COUNTS, count_table

SHORT = 2  # the vote of a rule that does not apply

# The base check.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

PRIOR_SHARE = 0.0005


@dataclass(frozen=True)
class Rule:
    """Votes on ``numerator / denominator``; it applies from ``least`` of the denominator on.

    ``good`` and ``bad`` are closed ranges of the ratio; elsewhere the rule abstains. A rule
    that only knows one kind of junk has no ``good`` range: its silence is no praise.
    """

    name: str
    numerator: str
    denominator: str
    bad: tuple[tuple[float, float], ...]
    good: tuple[float, float] | None = None
    least: int = 5


ANY = float("inf")
RULES = (
    Rule("symbols", "n_symbols", "n_words", ((0.1, ANY),)),
    Rule("repeats", "n_repeat_words", "n_words", ((0.2, ANY),)),
    Rule("capitals", "n_upper", "word_chars", ((0.25, ANY),), least=40),
    Rule("exclaims", "n_exclaims", "n_words", ((0.2, ANY),)),
    Rule("distinct", "n_distinct", "n_words", ((0, 0.2),), (0.5, 1), least=20),
    Rule("stop_words", "n_stop_words", "n_words", ((0, 0.02),), (0.1, 0.5), least=20),
    Rule("word_length", "word_chars", "n_words", ((0, 2.5), (11, ANY)), (3.5, 7), least=20),
    Rule("line_ends", "n_ended_lines", "n_lines", ((0, 0.2),), (0.9, 1), least=3),
)


def votes(counts: np.ndarray, rules: tuple[Rule, ...] = RULES) -> np.ndarray:
    """One row of votes for each row of ``COUNTS``."""
    out = np.zeros((len(counts), len(rules)), np.int8)
    for place, rule in enumerate(rules):
        below = counts[:, COUNTS.index(rule.denominator)]
        ratio = counts[:, COUNTS.index(rule.numerator)] / np.maximum(below, 1)
        enough = below >= rule.least
        out[~enough, place] = SHORT
        if rule.good:
            out[enough & (ratio >= rule.good[0]) & (ratio <= rule.good[1]), place] = 1
        for low, high in rule.bad:
            out[enough & (ratio >= low) & (ratio <= high), place] = -1
    return out


def pattern_numbers(vote_rows: np.ndarray) -> np.ndarray:
    """Each row of votes as one number with a base-4 digit for each rule."""
    return (vote_rows.astype(np.int64) + 1) @ 4 ** np.arange(vote_rows.shape[1])


def pattern_votes(numbers: np.ndarray, n_rules: int) -> np.ndarray:
    return (numbers[:, None] // 4 ** np.arange(n_rules) % 4 - 1).astype(np.int8)


@dataclass(frozen=True)
class VoteModel:
    """Share of good texts, and for each class and rule the shares of the votes bad, none, good."""

    good_share: float
    shares: np.ndarray  # class (0 bad, 1 good), rule, vote + 1; 1 where a rule does not apply

    def posterior(self, vote_rows: np.ndarray) -> np.ndarray:
        logs = [np.log([1 - self.good_share, self.good_share])[k] for k in (0, 1)]
        rules = np.arange(vote_rows.shape[1])
        score = [
            logs[k] + np.log(self.shares[k])[rules, vote_rows.astype(int) + 1].sum(axis=1)
            for k in (0, 1)
        ]
        return 1 / (1 + np.exp(np.clip(score[0] - score[1], -700, 700)))


def _bad_shares(bad: np.ndarray, fine: np.ndarray, prior: float) -> np.ndarray:
    """For each class and rule the share of bad votes, never greater among good texts.

    Where the counts would have it otherwise, both classes get their common share, which
    is what fits the counts best under that order.
    """
    bad, fine = bad + prior, fine + prior
    shares = bad / (bad + fine)
    common = bad.sum(axis=0) / (bad + fine).sum(axis=0)
    return np.where(shares[1] > shares[0], common, shares)


def fit_votes(
    vote_rows: np.ndarray, weights: np.ndarray, one_sided: np.ndarray | None = None, rounds: int = 200
) -> VoteModel:
    """EM for two classes in which the rules vote independently.

    A bad vote is never likelier on a good text than on a bad one, and a rule that can vote
    both ways is as often silent on either: so the classes cannot change places, and silence
    says nothing of a text. Rules that know no good vote (``one_sided``) say less of a bad
    text by silence only as far as they vote on the bad texts. It starts from the belief that
    a text with any bad vote is rather bad; texts that no vote tells apart keep the share of
    good texts, which starts there too. As much as ``PRIOR_SHARE`` of the texts, spread evenly
    over the votes that a rule can cast, is added to each class and rule, so no share gets to 0
    and the fit is the same at every size of corpus. Without texts all votes are equally likely.
    """
    n_rules = vote_rows.shape[1]
    one_sided = np.zeros(n_rules, bool) if one_sided is None else np.asarray(one_sided, bool)
    is_bad = vote_rows == -1
    is_silent = vote_rows == 0
    is_fine = (vote_rows == 1) | (is_silent & one_sided)
    total = max(float(weights.sum()), 1.0)
    prior = PRIOR_SHARE * total / 3
    voted = weights @ (is_bad | is_fine) + 2 * prior
    silent = np.where(one_sided, 0, weights @ is_silent + prior)
    votes_at_all = voted / (voted + silent)
    good = np.where(is_bad.any(axis=1), 0.1, 0.9)
    for _ in range(rounds):
        of_class = weights * np.stack([1 - good, good])
        bad = votes_at_all * _bad_shares(of_class @ is_bad, of_class @ is_fine, prior)
        fine = votes_at_all - bad
        none = np.where(one_sided, fine, 1 - votes_at_all)
        shares = np.stack([bad, none, np.where(one_sided, prior / total, fine), np.ones_like(bad)], axis=2)
        good_share = (weights @ good + PRIOR_SHARE * total) / (total + 2 * PRIOR_SHARE * total)
        model = VoteModel(float(good_share), shares)
        again = model.posterior(vote_rows)
        if len(again) == 0 or np.abs(again - good).max() < 1e-9:
            break
        good = again
    return model


def fit_patterns(patterns: DataFrame, rules: tuple[Rule, ...] = RULES) -> VoteModel:
    """The model for a column ``pattern``; at most 4 ** rules counts come to the driver."""
    counted = patterns.groupBy("pattern").count().collect()
    numbers = np.array([row["pattern"] for row in counted], np.int64)
    weights = np.array([row["count"] for row in counted], float)
    one_sided = np.array([rule.good is None for rule in rules])
    return fit_votes(pattern_votes(numbers, len(rules)), weights, one_sided)


def _patterns(column: pa.Array) -> list[pa.Array]:
    return [pa.array(pattern_numbers(votes(count_table(column))))]


def _base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def quality_verdicts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """Counts, votes' pattern, posterior and verdict of each text.

    Null texts count as empty: no words, so the base check fails. One row for each input
    row; repeated rows and null ids stay. The counts are written once to the shared folder.
    """
    fields = f"{COUNT_FIELDS}, pattern long"

    def start():
        def make(column: pa.Array) -> list[pa.Array]:
            table = count_table(column)
            columns = [pa.array(np.ascontiguousarray(table[:, i])) for i in range(len(COUNTS))]
            return [*columns, pa.array(pattern_numbers(votes(table)))]

        return make

    spark = docs.sparkSession
    renamed = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    counted = map_texts(renamed, "_text", fields, start, ["_id"])
    counted = written(counted, new_work_folder(spark, "votes"))
    model = fit_patterns(counted)
    known = [row["pattern"] for row in counted.select("pattern").distinct().collect()]
    posterior = model.posterior(pattern_votes(np.array(known, np.int64), len(RULES)))
    table = spark.createDataFrame(
        [(int(k), float(p)) for k, p in zip(known, posterior, strict=True)],
        "pattern long, posterior double",
    )
    failed = _base_failed(F.col("n_words"), F.col("n_repeat_words"))
    # 4 ** rules rows at most, so it can be broadcast
    return counted.join(F.broadcast(table), "pattern", "left").select(
        F.col("_id").alias(id_col),
        *COUNTS[:5],
        failed.alias("base_failed"),
        (~failed & (F.col("posterior") >= threshold)).alias("kept"),
        "posterior",
        "pattern",
    )


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose text passes the base check and the model, with their own columns only.

    Null and empty texts have no words, fail the base check and go; repeated rows and rows with
    null ids are judged each for itself; an empty table gives one. Other columns may have any
    name. The texts are read twice, once for the patterns and once to decide, so that nothing but
    the patterns' counts is written in between.
    """
    pattern = map_texts(docs, text_col, "pattern long", lambda: _patterns, [])
    model = fit_patterns(pattern)
    verdict = new_name(docs.columns, "_keep")

    def start():
        def make(column: pa.Array) -> list[pa.Array]:
            table = count_table(column)
            words, repeats = table[:, 0], table[:, COUNTS.index("n_repeat_words")]
            fine = (words >= MIN_WORDS) & (100 * repeats <= MAX_REPEAT_PERCENT * words)
            return [pa.array(fine & (model.posterior(votes(table)) >= threshold))]

        return make

    judged = map_texts(docs, text_col, f"`{verdict}` boolean", start, docs.columns)
    return judged.where(F.col(verdict)).drop(verdict)
