"""Keyed upsert into parquet tables that are partitioned by one column.

Plain parquet has no MERGE, and a table cannot be overwritten while it is read. So the
new state of the touched partitions is written beside the table first, marked as whole,
and then swapped in with a dynamic partition overwrite. A run that dies while swapping
leaves the marked state in the side folder: readers see it in place of those partitions,
and the next upsert swaps it in before it starts. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import any_match, delete, exists, move_folder, touch
from ..staging import written
from .snapshots import version_of


class DuplicateKeyError(ValueError):
    """The new rows hold the same key twice."""


def _beside(target: str, name: str) -> str:
    return f"{target.rstrip('/')}__{name}"


def _pending(target: str) -> tuple[str, str]:
    """The folder of a state that is not swapped in yet, and the mark of a whole one.

    The mark is our own: a cluster may be set up to write no ``_SUCCESS`` files.
    """
    folder = _beside(target, "pending")
    return folder, f"{folder}/_whole"


def _swap_in(state: DataFrame, target: str, partition: str) -> None:
    """Replace the partitions of ``target`` that ``state`` has rows for."""
    (
        state.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(target)
    )


def finish_pending(spark: SparkSession, target: str, partition: str = "date") -> None:
    """Swap in a staged state that is marked as whole; drop one that is not."""
    pending, mark = _pending(target)
    if exists(spark, mark):
        _swap_in(spark.read.parquet(pending), target, partition)
    delete(spark, pending)


def read_keyed(
    spark: SparkSession, target: str, schema: str | None = None, partition: str = "date"
) -> DataFrame:
    """The table at ``target``; ``schema`` names its columns, and an absent table is empty then.

    Where a writer died between its two writes, the whole state it left beside the table
    stands in for the partitions it would have replaced. A table that a version holds is
    read as the latest version has it.
    """
    if versioned := version_of(spark, target):
        found, name = versioned
        table = found.read(spark, name)
        return table.select(*T.StructType.fromDDL(schema).names) if schema else table
    pending, mark = _pending(target)
    reader = spark.read.schema(schema) if schema else spark.read
    if exists(spark, mark):
        state = reader.parquet(pending)
        if not any_match(spark, f"{target}/*=*"):
            return state
        table = reader.parquet(target)
        kept = table.join(state.select(partition).distinct(), partition, "left_anti")
        return kept.select(*state.columns).unionByName(state)
    if schema is None or any_match(spark, f"{target}/*=*"):
        return reader.parquet(target)
    return spark.createDataFrame([], schema)


def one_row_per_key(
    rows: DataFrame, keys: Sequence[str], on_duplicate: str, newest_by: Sequence[str]
) -> DataFrame:
    if on_duplicate == "last":
        window = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in newest_by])
        return rows.withColumn("age", F.row_number().over(window)).where("age = 1").drop("age")
    twice = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").head(1)
    if twice:
        raise DuplicateKeyError(f"key {twice[0].asDict()} occurs more than once")
    return rows


def stage_upsert(
    target: str,
    rows: DataFrame,
    keys: Sequence[str],
    partition: str = "date",
    mode: str = "replace",
    group: Sequence[str] | None = None,
    on_duplicate: str = "error",
    newest_by: Sequence[str] = (),
) -> None:
    """The first half of ``upsert_by_key``: write the new state beside the table, unmarked."""
    if mode not in ("replace", "replace_group"):
        raise ValueError(f"mode must be 'replace' or 'replace_group', not {mode!r}")
    if on_duplicate == "last" and not newest_by:
        raise ValueError("on_duplicate='last' needs newest_by")
    spark = rows.sparkSession
    if version_of(spark, target):
        raise ValueError(f"{target} belongs to a version of several tables and changes with it")
    finish_pending(spark, target, partition)
    arrived, (pending, _) = _beside(target, "arrived"), _pending(target)
    try:
        new = one_row_per_key(written(rows, arrived), keys, on_duplicate, newest_by)
        if any_match(spark, f"{target}/*=*"):
            replaced = list(group or [partition]) if mode == "replace_group" else list(keys)
            # As values, so that the scan opens these folders only; they are no more than the folders.
            touched = [row[0] for row in new.select(partition).distinct().collect()]
            kept = (
                spark.read.schema(new.schema)
                .parquet(target)
                .where(F.col(partition).isin(touched))
                .join(new.select(*replaced).distinct(), replaced, "left_anti")
            )
            written(kept.select(*rows.columns).unionByName(new), pending)
        elif on_duplicate == "last":
            written(new, pending)
        else:
            move_folder(spark, arrived, pending)
    finally:
        delete(spark, arrived)


def mark_staged(spark: SparkSession, target: str) -> None:
    """From here on the staged state counts: ``finish_pending`` and readers take it."""
    touch(spark, _pending(target)[1])


def upsert_by_key(
    target: str,
    rows: DataFrame,
    keys: Sequence[str],
    partition: str = "date",
    mode: str = "replace",
    group: Sequence[str] | None = None,
    on_duplicate: str = "error",
    newest_by: Sequence[str] = (),
) -> None:
    """Put ``rows`` into the table at ``target``: a row replaces the one with its key.

    Nothing is deleted in mode ``replace``; doing it twice is the same as once. Mode
    ``replace_group`` also drops the old rows of every touched ``group`` (key columns).
    ``on_duplicate='last'`` keeps the first row by descending ``newest_by`` where new
    rows share a key; by default that is an error. The partition column must follow
    from the key: rows of one key always lie in the same partition. Each of its values is a
    folder, and the touched ones come to the driver, so it should be coarse, like a date.

    ``rows`` is worked out once, into a folder beside the table. Only the partitions
    with new rows are read and written.
    """
    spark = rows.sparkSession
    stage_upsert(target, rows, keys, partition, mode, group, on_duplicate, newest_by)
    mark_staged(spark, target)
    finish_pending(spark, target, partition)
