"""Quality classifier: an additive model with pairwise interactions, boosted in cycles.

Each feature owns a lookup table over its bins. Training goes round the features again and
again; each visit fits a shallow tree on that feature's bins to the current gradient and
adds it, scaled down, to the table. Then the pairs with the largest gain left get a table
over two features each, trained the same way. A text's score is the logistic of the sum of
its bins' entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_work_folder
from ..staging import written
from .frames import map_texts
from .labelled import SAMPLE_ROWS, held_out, training_labels
from .textstats import COUNT_FIELDS, COUNTS, count_columns

RATIOS = (
    ("word_chars", "n_words"),
    ("n_symbols", "n_words"),
    ("n_repeat_words", "n_words"),
    ("n_same_neighbours", "n_words"),
    ("n_distinct", "n_words"),
    ("n_stop_words", "n_words"),
    ("n_short_words", "n_words"),
    ("n_long_words", "n_words"),
    ("n_exclaims", "n_words"),
    ("n_stops", "n_words"),
    ("n_words", "n_lines"),
    ("n_upper", "word_chars"),
    ("n_digits", "word_chars"),
    ("n_dup_lines", "n_lines"),
    ("n_ended_lines", "n_lines"),
)


def feature_rows(counts: np.ndarray) -> np.ndarray:
    """The logarithm of the length and the ratios; 0 where a denominator is 0."""
    column = {name: counts[:, i].astype(float) for i, name in enumerate(COUNTS)}
    ratios = [column[a] / np.maximum(column[b], 1) for a, b in RATIOS]
    return np.column_stack([np.log1p(column["n_words"]), *ratios])


def _tree_on_bins(gradient: np.ndarray, hessian: np.ndarray, leaves: int, damping: float) -> np.ndarray:
    """Values of a tree with up to ``leaves`` leaves over ordered bins, grown best split first."""
    sums = np.concatenate(([0.0], np.cumsum(gradient)))
    weights = np.concatenate(([0.0], np.cumsum(hessian)))

    def worth(a: int, b: int) -> float:
        return (sums[b] - sums[a]) ** 2 / (weights[b] - weights[a] + damping)

    parts = [(0, len(gradient))]
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for a, b in parts:
            if b - a > 1:
                cuts = np.arange(a + 1, b)
                left = (sums[cuts] - sums[a]) ** 2 / (weights[cuts] - weights[a] + damping)
                right = (sums[b] - sums[cuts]) ** 2 / (weights[b] - weights[cuts] + damping)
                gains = left + right - worth(a, b)
                place = int(gains.argmax())
                if gains[place] > best[0]:
                    best = (float(gains[place]), (a, b), int(cuts[place]))
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    values = np.zeros(len(gradient))
    for a, b in parts:
        values[a:b] = (sums[b] - sums[a]) / (weights[b] - weights[a] + damping)
    return values


def _quadrants(gradient: np.ndarray, hessian: np.ndarray, damping: float) -> tuple[float, np.ndarray]:
    """The best cut of a grid into four quadrants: its gain and the values of the cells."""
    g = np.pad(gradient.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    h = np.pad(hessian.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    rows, columns = gradient.shape

    def corners(t: np.ndarray) -> list[np.ndarray]:
        inner = t[1:rows, 1:columns]
        up, left = t[1:rows, columns][:, None], t[rows, 1:columns][None, :]
        return [inner, up - inner, left - inner, t[rows, columns] - up - left + inner]

    if rows < 2 or columns < 2:
        return 0.0, np.zeros_like(gradient)
    gs, hs = corners(g), corners(h)
    gain = sum(a * a / (b + damping) for a, b in zip(gs, hs, strict=True))
    r, c = np.unravel_index(gain.argmax(), gain.shape)
    a, b, c_, d = (float(x[r, c] / (y[r, c] + damping)) for x, y in zip(gs, hs, strict=True))
    values = np.empty_like(gradient)
    values[: r + 1, : c + 1], values[: r + 1, c + 1 :] = a, b
    values[r + 1 :, : c + 1], values[r + 1 :, c + 1 :] = c_, d
    return float(gain[r, c] - g[-1, -1] ** 2 / (h[-1, -1] + damping)), values


@dataclass
class AdditiveModel:
    """Cut points of each feature, a table for each feature and tables for some pairs."""

    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]  # bin of a feature -> its bin in the pair tables
    pairs: dict[tuple[int, int], np.ndarray]

    def bins(self, features: np.ndarray) -> np.ndarray:
        found = [np.searchsorted(c, features[:, i], "right") for i, c in enumerate(self.cuts)]
        return np.column_stack(found)

    def scores(self, features: np.ndarray) -> np.ndarray:
        bins = self.bins(features)
        total = np.full(len(features), self.intercept)
        for i, table in enumerate(self.tables):
            total += table[bins[:, i]]
        for (i, j), table in self.pairs.items():
            total += table[self.coarse[i][bins[:, i]], self.coarse[j][bins[:, j]]]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def fit_additive(
    features: np.ndarray,
    labels: np.ndarray,
    rounds: int = 150,
    pair_rounds: int = 40,
    n_pairs: int = 8,
    rate: float = 0.1,
    max_bins: int = 32,
    leaves: int = 3,
    damping: float = 1.0,
) -> AdditiveModel:
    """Cyclic boosting on the logistic loss; without rows every score is 1/2."""
    n, width = features.shape
    quantiles = np.linspace(0, 1, max_bins + 1)[1:-1]
    cuts = [
        np.unique(np.quantile(features[:, i], quantiles)) if n else np.zeros(0)
        for i in range(width)
    ]
    start = float(np.log((labels.sum() + 0.5) / (n - labels.sum() + 0.5)))
    tables = [np.zeros(len(c) + 1) for c in cuts]
    coarse = [np.arange(len(c) + 1) * min(8, len(c) + 1) // (len(c) + 1) for c in cuts]
    model = AdditiveModel(start, cuts, tables, coarse, {})
    if n == 0 or labels.min() == labels.max():
        return model
    bins = model.bins(features)
    total = np.full(n, start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -500, 500)))
        return labels - p, p * (1 - p)

    for _ in range(rounds):
        for i, table in enumerate(tables):
            g, h = slopes()
            size = len(table)
            step = rate * _tree_on_bins(
                np.bincount(bins[:, i], g, size), np.bincount(bins[:, i], h, size), leaves, damping
            )
            table += step
            total += step[bins[:, i]]

    small = np.column_stack([coarse[i][bins[:, i]] for i in range(width)])
    shape = [int(c[-1]) + 1 for c in coarse]

    def grids(pair: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        i, j = pair
        g, h = slopes()
        cell, size = small[:, i] * shape[j] + small[:, j], shape[i] * shape[j]
        grid = (shape[i], shape[j])
        return np.bincount(cell, g, size).reshape(grid), np.bincount(cell, h, size).reshape(grid)

    gains = {p: _quadrants(*grids(p), damping)[0] for p in combinations(range(width), 2)}
    chosen = sorted(gains, key=lambda p: (-gains[p], p))[:n_pairs]
    model.pairs = {p: np.zeros((shape[p[0]], shape[p[1]])) for p in chosen}
    for _ in range(pair_rounds):
        for (i, j), table in model.pairs.items():
            step = rate * _quadrants(*grids((i, j)), damping)[1]
            table += step
            total += step[small[:, i], small[:, j]]
    return model


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    target: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    threshold: float = 0.3,
) -> DataFrame:
    """``id_col``, held_out, score (0 to 1, higher: label 1 likelier) and predicted (0 or 1).

    The model learns from at most ``sample_rows`` labelled rows outside the held-out fold,
    and sees counts over whole texts only. Null texts count as empty; one row for each input
    row. Without labels of both kinds every text gets the labels' share (1/2 without any).
    The counts of all texts are written once to the shared folder.
    """
    spark = docs.sparkSession
    renamed = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    counted = map_texts(renamed, "_text", COUNT_FIELDS, lambda: count_columns, ["_id"])
    counted = written(counted, new_work_folder(spark, "counts"))
    labelled = training_labels(labels, target, id_col, sample_rows)
    # the sample has ``sample_rows`` ids at most, so it can be broadcast
    sample = counted.join(F.broadcast(labelled), "_id").select("_label", *COUNTS)
    sample = sample.orderBy(F.xxhash64(*COUNTS), *COUNTS, "_label").limit(sample_rows).toPandas()
    model = fit_additive(
        feature_rows(sample[list(COUNTS)].to_numpy()), sample["_label"].to_numpy(float)
    )
    schema = counted.select("_id").schema.add("score", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.column_stack([batch.column(name).to_numpy() for name in COUNTS])
            found = pa.array(model.scores(feature_rows(table)))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), found], names=["_id", "score"])

    return counted.mapInArrow(score, schema).select(
        F.col("_id").alias(id_col),
        held_out(F.col("_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
