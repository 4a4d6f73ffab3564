"""Tables written between two steps, so that the first is not worked out again."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

ROWS_A_FILE, FEW_ROWS = 1 << 17, 1 << 21


def in_few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, to be written as few files if it has few rows; ``rows``: about how many at most.

    What works the rows out keeps its partitions, and only the result is moved once more. On a
    local file system each file costs an executor several processes that set its mode. A table
    of more than ``FEW_ROWS`` rows is left as it is.
    """
    return df.repartition(max(1, -(-rows // ROWS_A_FILE))) if rows <= FEW_ROWS else df


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it from there; the known schema saves a look at the files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, steps: Sequence[Callable[[], None]]) -> None:
    """Run independent jobs at the same time, so that one's last tasks do not idle the rest."""
    in_session = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(in_session(step)) for step in steps]:
            done.result()
