"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_work_folder
from ..staging import in_few_files, written

BROADCAST_EDGES = 1 << 19  # two ids each


def _kept(df: DataFrame, rows: int | None) -> DataFrame:
    df = df if rows is None else in_few_files(df, rows)
    return written(df, new_work_folder(df.sparkSession, "links"))


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of its neighbourhood.

    ``few``: the edges are counted and few, so a row for each node can be broadcast.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    linked = both.where("b > a").join(F.broadcast(least) if few else least, "a")
    return linked.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b")


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of them; a > b in all edges."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    linked = edges.join(F.broadcast(least) if few else least, "a")
    linked = linked.select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return linked.unionByName(own).where("a != b").distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("bigint")).alias("s")).first()
    return row["n"], row["s"]


def components(links: DataFrame, a: str = "a", b: str = "b", n_links: int | None = None) -> DataFrame:
    """(node, component) of every linked node; a component is named by its least node.

    ``n_links``: the number of links, if it is known; few are kept in few files. Self-links and
    nulls are left out. Only counts come to the driver; each round is written to the shared
    folder, so lineage stays short.
    """
    x, y = F.col(a), F.col(b)
    edges = links.where(x.isNotNull() & y.isNotNull() & (x != y))
    edges = _kept(edges.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct(), n_links)
    before = _state(edges)
    while True:
        few = before[0] <= BROADCAST_EDGES
        edges = _kept(_small_star(_large_star(edges, few), few), before[0])
        after = _state(edges)
        if after == before:
            break
        before = after
    # every edge now joins a node to the centre of its component
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(centres)
