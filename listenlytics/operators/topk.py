"""The first rows of each group, planned so that no task holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FIRST_LEVEL_SPLITS = 512


def top_k_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[str], k: int, ties: str = "break"
) -> DataFrame:
    """Rows of ``df`` whose ``rank`` in their group, highest ``order`` first, is at most ``k``.

    ``ties='break'``: ``order`` is expected to be (nearly) total. Spark turns the rank
    filter into a group limit before the shuffle, which passes on about ``k`` rows of
    each group and task.

    ``ties='keep'``: any number of rows may tie, and a limit on ``rank`` keeps all of them.
    So a limit on the row number finds ``k`` rows of each group. They hold every order
    value that ranks at most ``k``, with its rank, and these values are joined back; the
    tied rows themselves are never brought together.
    """
    if ties not in ("break", "keep"):
        raise ValueError(f"ties must be 'break' or 'keep', not {ties!r}")
    window = Window.partitionBy(*by).orderBy(*[F.desc(c) for c in order])
    if ties == "break":
        return df.withColumn("rank", F.rank().over(window)).where(F.col("rank") <= k)

    keys = [*by, *order]
    ranks = (
        df.select(*keys)
        .withColumns({"place": F.row_number().over(window), "rank": F.rank().over(window)})
        .where(F.col("place") <= k)
        .select(*keys, "rank")
        .distinct()
    )
    same = reduce(and_, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in keys])
    return (
        df.alias("l")
        .join(ranks.alias("r"), same, "inner")
        .select(*[F.col(f"l.{c}") for c in df.columns], F.col("r.rank"))
    )


def first_n_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[str], n: int
) -> DataFrame:
    """The first ``n`` rows of each group in ascending ``order``.

    Two levels: the first ``n`` of each group and split, then the first ``n`` of those.
    A group that spans many scan tasks is thus never gathered, not even its candidates:
    a split takes the tasks' survivors of every 512th task, the last level n rows a split.
    """
    split = df.withColumn("split", F.spark_partition_id() % FIRST_LEVEL_SPLITS)
    for keys in ([*by, "split"], list(by)):
        window = Window.partitionBy(*keys).orderBy(*order)
        split = split.withColumn("place", F.row_number().over(window)).where(F.col("place") <= n)
    return split.drop("split", "place")


def latest_per_key(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """For each key the row(s) of the latest arrival, as if arrivals were put one by one."""
    window = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in arrival])
    return (
        df.withColumn("age", F.rank().over(window)).where(F.col("age") == 1).drop("age")
    )
